"""Mirroring a change feed into documents.

A change is ``(type, id, seq, op, payload…)`` with an optional ``tx_id``. Each micro-batch is folded to
one change per key and written to its own directory of an append-only log, so the cost of a batch
depends on the batch alone and not on how much is stored. A directory is named by the run, as its
checkpoint knows it, and the batch: writing the same batch again replaces the same directory, and
another run never does. A reader takes, per key, the last change by the full order: a replayed or
late change can therefore never undo a newer one. Changes of transactions that are still undecided
wait beside the log until ``settle`` finds their status. ``compact`` turns a log into a new base.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docsearch.operators.documents import build_documents
from docsearch.operators.maintain import DELETE, committed, fold_delete_wins, fold_last, put_documents
from docsearch.plans.mapping import DocumentMapping, Registry

KEY = ("type", "id")
ORDER = ("seq",)
RUN, BATCH = "run", "batch"
#: beside the log: changes whose transaction has no final status yet
WAITING = "-waiting"
FINAL = ("committed", "rolled_back")

Fold = Callable[[DataFrame, Sequence[str], Sequence[str]], DataFrame]
FOLDS: dict[str, Fold] = {"last_wins": fold_last, "delete_wins": fold_delete_wins}


def fold_batch(
    changes: DataFrame,
    registry: Registry | None = None,
    transactions: DataFrame | None = None,
    fold: str = "last_wins",
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """What one commit does: committed changes of root entities, one per key, the last by ``order``."""
    if fold not in FOLDS:
        raise ValueError(f"fold is one of {sorted(FOLDS)}")
    if registry is not None:
        changes = changes.where(F.col("type").isin([m.type_name for m in registry.roots()]))
    if transactions is not None:
        changes = committed(changes, transactions)
    return FOLDS[fold](changes, KEY, order)


def mirror(
    changes: DataFrame,
    log: str,
    checkpoint: str,
    registry: Registry | None = None,
    transactions: DataFrame | None = None,
    fold: str = "last_wins",
    available_now: bool = True,
    order: Sequence[str] = ORDER,
) -> StreamingQuery | None:
    """Start mirroring a streaming DataFrame of changes into ``log``. None when the registry's
    settings switch automatic indexing off.

    ``order`` is the full order of changes of one key; where changes can share a ``seq``, name
    what tells them apart. With ``transactions``, changes without a final status are kept in
    ``log`` + WAITING; call :func:`settle` when more is known.
    """
    if registry is not None and registry.settings.disable_auto_index:
        return None

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        place = f"{RUN}={_run_of(batch.sparkSession, checkpoint)}/{BATCH}={batch_id}"
        if transactions is not None:
            undecided = batch.join(_final(transactions), "tx_id", "left_anti")
            undecided.select(*batch.columns).write.mode("overwrite").parquet(f"{log}{WAITING}/{place}")
        folded = fold_batch(batch, registry, transactions, fold, order)
        folded.select(*batch.columns).write.mode("overwrite").parquet(f"{log}/{place}")

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps over restarts and no other checkpoint has."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _final(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("status").isin(*FINAL)).select("tx_id").distinct()


def settle(
    spark: SparkSession,
    log: str,
    schema: T.StructType,
    transactions: DataFrame,
    target: str,
    registry: Registry | None = None,
    fold: str = "last_wins",
    order: Sequence[str] = ORDER,
) -> None:
    """Put the waiting changes of ``log`` that have since been committed into it, and write those
    still undecided to ``target`` + WAITING, from where the next call goes on.

    What was put in once may be put in again: the same change never counts twice.
    """
    waiting = _read(spark, f"{log}{WAITING}", schema).select(*[f.name for f in schema.fields])
    decided = fold_batch(waiting, registry, transactions, fold, order)
    run = f"settled-{uuid.uuid4().hex}"
    decided.select(*waiting.columns).write.parquet(f"{log}/{RUN}={run}/{BATCH}=0")
    left = waiting.join(_final(transactions), "tx_id", "left_anti").select(*waiting.columns)
    left.write.parquet(f"{target}{WAITING}/{RUN}={run}/{BATCH}=0")


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    wanted = T.StructType(
        [*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())]
    )
    try:
        return spark.read.schema(wanted).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], wanted)


def read_log(spark: SparkSession, log: str, schema: T.StructType) -> DataFrame:
    """Every folded change, with the ``run`` and ``batch`` that brought it. ``schema`` is that of a
    change; declaring it keeps ids that look like numbers as text. A log that has had no change yet is empty."""
    return _read(spark, log, schema)


def current_changes(changes: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """The change that counts for each key, as ``version`` its ``seq``; deletes included. The run
    and batch only tell apart changes that ``order`` leaves equal."""
    latest = fold_last(changes, KEY, (*order, BATCH, RUN))
    return latest.withColumnRenamed("seq", "version").drop(BATCH, RUN)


def current_documents(changes: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """The documents that exist: the last change of each key, unless it is a delete."""
    return current_changes(changes, order).where(F.col("op") != DELETE)


def index_log(
    registry: Registry,
    changes: DataFrame,
    entity: str | DocumentMapping,
    path: str,
    target: str,
    order: Sequence[str] = ORDER,
) -> str:
    """Bring a written index up to a log: what was deleted goes, what was changed goes in anew.

    ``changes`` is what :func:`read_log` gives, with the columns of the entity's table as payload.
    Gives the path that holds the result. Doing it again with the same log changes nothing.
    """
    mapping = registry.require(entity)
    latest = current_changes(changes, order).where(F.col("type") == mapping.type_name)
    rows = latest.where(F.col("op") != DELETE).drop("type", "op", "version", *(["tx_id"] if "tx_id" in latest.columns else []))
    if "id" not in mapping.keys:
        rows = rows.drop("id")
    loaded = {mapping.full_name: rows}
    named = latest.select(
        F.lit(registry.index_of(mapping)).alias("index"), F.lit(mapping.type_name).alias("type"), "id"
    )
    typed = build_documents(registry, loaded, mapping)
    return put_documents(registry, loaded, mapping, typed, named, path, target)


def compact(
    spark: SparkSession, log: str, schema: T.StructType, target: str, order: Sequence[str] = ORDER
) -> None:
    """Write a log with one change per key. Deletes are kept, so that a late change of a deleted
    key is still recognised as late. A mirror that is then started on ``target`` goes on from it."""
    latest = fold_last(read_log(spark, log, schema), KEY, (*order, BATCH, RUN))
    latest.drop(BATCH, RUN).write.parquet(f"{target}/{RUN}=base/{BATCH}=0")
