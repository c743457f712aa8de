"""A Merkle manifest of a table: digests upwards and proofs downwards by time-forward processing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm.tables import field_of, written
from docsearch.operators.sizes import broadcast_if_small

#: children of a node
FAN = 8
#: levels that one task raises or lowers at a time, and the nodes below them: no group is larger
HEIGHT = 3
BLOCK = FAN**HEIGHT


def digest_of(parts) -> str:
    """Lower-case hexadecimal SHA-256 of texts put together."""
    return sha256("".join(parts).encode("ascii")).hexdigest()


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*(encoded(v) for v in values)), 256)


def forward(leaves: list[str], height: int | None) -> list[list[str]]:
    """The digests of all levels above ``leaves``, the leaves first.

    A node's label is its level and place. Every node sends its digest to its parent by a queue
    ordered by label, so a node finds its children's digests, from left to right, when its turn
    comes. With no ``height`` the levels end at a single node.
    """
    levels, queue, level = [leaves], [], 0
    while (height is None and len(levels[level]) > 1) or (height is not None and level < height):
        for place, digest in enumerate(levels[level]):
            heapq.heappush(queue, ((level + 1, place // FAN), place % FAN, digest))
        level += 1
        levels.append([])
        while queue:
            label, run = queue[0][0], []
            while queue and queue[0][0] == label:
                run.append(heapq.heappop(queue)[2])
            levels[level].append(digest_of(run))
    return levels


def reversed_sweep(levels: list[list[str]], suffix: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """The proof of every leaf: for each level the digests left of its node and right of it.

    Nodes take their turns in the opposite order; each adds its own step to what its parent has
    sent and sends that to its children. ``suffix`` is the proof of the last level's nodes.
    """
    queue, held = [], {}
    top = len(levels) - 1
    for place in range(len(levels[top])):
        heapq.heappush(queue, (-top, -place))
        held[top, place] = suffix
    while queue:
        level, place = (-x for x in heapq.heappop(queue))
        if not level:
            continue
        proof = held.pop((level, place))
        run = levels[level - 1][place * FAN : (place + 1) * FAN]
        for slot in range(len(run)):
            child = (level - 1, place * FAN + slot)
            held[child] = [("".join(run[:slot]), "".join(run[slot + 1 :])), *proof]
            heapq.heappush(queue, (-child[0], -child[1]))
    return [held[0, place] for place in range(len(levels[0]))]


def _levels(group: pa.Table) -> tuple[pa.Table, list[list[str]]]:
    """A block's rows in order, and its levels: all of HEIGHT, or up to the root of a small tree."""
    group = group.sort_by("index")
    height = HEIGHT if group.column("total")[0].as_py() > BLOCK else None
    return group, forward(group.column("digest").to_pylist(), height)


def _numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with ``index``, their place in their ``tree`` from 0, and ``total``, its size.

    A global sort puts a tree's nodes into consecutive tasks. Each numbers its own; how many came
    before is a sum over one row for each tree and task. ``tie`` deals equal rows out.
    """
    names = nodes.columns
    schema = T.StructType(
        [*nodes.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType())]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for tree in batch.column("tree").to_pylist():
                place = place + 1 if tree == last else 0
                last = tree
                places.append(place)
            columns = [batch.column(name) for name in names]
            parts = pa.array([part] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*columns, parts, pa.array(places, pa.int64())], schema.names)

    rows = nodes.withColumn("tie", F.monotonically_increasing_id()).orderBy("tree", *order, "tie").drop("tie")
    placed = written(rows.mapInArrow(each, schema), "merkle-placed")
    counts = placed.groupBy(F.col("tree").alias("counted"), F.col("part").alias("task")).agg(F.count("*").alias("n"))
    tree = Window.partitionBy("counted")
    before = tree.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "counted",
        "task",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(tree).alias("total"),
    )
    counts = broadcast_if_small(written(counts, "merkle-counts"))
    found = placed.join(counts, (F.col("tree") == F.col("counted")) & (F.col("part") == F.col("task")))
    return found.select(*names, (F.col("before") + F.col("place")).alias("index"), "total")


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"index DIV {BLOCK}"))


def _raised(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, and ``tree, digest`` of every root.

    A round raises blocks of up to BLOCK nodes; there are as many as the logarithm of the largest tree
    to the base BLOCK. The digests of blocks go to the next round in a sorted shuffle, which
    is the part of the queue that lies outside one task.
    """

    def up(group: pa.Table) -> pa.Table:
        group, levels = _levels(group)
        first = {name: [group.column(name)[0].as_py()] for name in ("tree", "block", "total")}
        return pa.table(
            {
                "tree": pa.array(first["tree"], pa.string()),
                "index": pa.array(first["block"], pa.int64()),
                "total": pa.array([-(-first["total"][0] // BLOCK)], pa.int64()),
                "digest": pa.array(levels[-1], pa.string()),
            }
        )

    rounds = [written(_blocks(nodes), "merkle-nodes")]
    while True:
        raised = rounds[-1].select("tree", "block", "index", "total", "digest").groupBy("tree", "block")
        roots = written(
            raised.applyInArrow(up, "tree string, index long, total long, digest string"), "merkle-raised"
        )
        if not roots.where("total > 1").take(1):
            return rounds, roots.select("tree", "digest")
        rounds.append(written(_blocks(roots), "merkle-nodes"))


_PROOF = "lefts array<string>, rights array<string>, subroot string, root string"


def _lowered(rounds: list[DataFrame], proofs: DataFrame) -> DataFrame:
    """The proof of each node of the first round, from the ``proofs`` of the roots of its trees:
    ``tree, index`` and the columns of _PROOF."""

    def down(group: pa.Table, above: pa.Table) -> pa.Table:
        group, levels = _levels(group)
        above = above.to_pylist()[0]
        steps = reversed_sweep(levels, list(zip(above["lefts"], above["rights"], strict=True)))
        n = len(steps)
        return pa.table(
            {
                "tree": group.column("tree").cast(pa.string()),
                "index": group.column("index"),
                "lefts": pa.array([[s[0] for s in x] for x in steps], pa.list_(pa.string())),
                "rights": pa.array([[s[1] for s in x] for x in steps], pa.list_(pa.string())),
                "subroot": pa.array([above["subroot"]] * n, pa.string()),
                "root": pa.array([above["root"]] * n, pa.string()),
            }
        )

    proofs = proofs.withColumn("index", F.lit(0).cast("long"))
    for nodes in reversed(rounds):
        blocks = nodes.select("tree", "block", "index", "total", "digest").groupBy("tree", "block")
        above = proofs.withColumnRenamed("index", "block").groupBy("tree", "block")
        proofs = written(
            blocks.cogroup(above).applyInArrow(down, f"tree string, index long, {_PROOF}"), "merkle-proofs"
        )
    return proofs


def _leaf_proofs(rounds: list[DataFrame], proofs: DataFrame, key: T.StructField) -> DataFrame:
    """What every leaf gets: the digest of its proof, and the root its presented digest leads to."""
    schema = T.StructType(
        [key]
        + [
            T.StructField(name, T.StringType())
            for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root")
        ]
    )

    def down(group: pa.Table, above: pa.Table) -> pa.Table:
        group, levels = _levels(group)
        above = above.to_pylist()[0]
        steps = reversed_sweep(levels, list(zip(above["lefts"], above["rights"], strict=True)))
        folded = []
        for digest, proof in zip(group.column("presented").to_pylist(), steps, strict=True):
            for left, right in proof:
                digest = digest_of((left, digest, right))
            folded.append(digest)
        n = len(steps)
        return pa.table(
            {
                key.name: group.column("key"),
                "leaf": group.column("digest").cast(pa.string()),
                "subroot": pa.array([above["subroot"]] * n, pa.string()),
                "root": pa.array([above["root"]] * n, pa.string()),
                "proof_sha256": pa.array([digest_of(x for s in p for x in s) for p in steps], pa.string()),
                "folded_root": pa.array(folded, pa.string()),
            }
        )

    if rounds[1:]:
        proofs = _lowered(rounds[1:], proofs)
    else:
        proofs = proofs.withColumn("index", F.lit(0).cast("long"))
    above = proofs.withColumnRenamed("index", "block").groupBy("tree", "block")
    return rounds[0].groupBy("tree", "block").cogroup(above).applyInArrow(down, schema)


def merkle_manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    presented: dict[str, Column] | None = None,
) -> DataFrame:
    """``order, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``.

    A leaf is the digest of ``fields``, each ``-`` if null, else its UTF-8 byte count, ``:`` and value. The leaves of
    each value of ``group`` ascend by ``order``; every FAN consecutive digests of a level, the
    last ones being fewer, become their digest until one remains, the subroot. Subroots, ordered
    by ``group``, null first, give the root in the same way. ``proof_sha256`` is the digest of a leaf's
    siblings, level by level up to the root, and ``folded_root`` what the siblings make of the leaf
    of the row with the columns of ``presented`` in place of its own; ``verified`` says whether
    that is the root.

    Null values of ``group`` are one tree; null ids come first; equal ids ascend by leaf; repeated
    rows are leaves of their own. An empty table gives an empty result.

    Leaves are made where the rows are read and no text is shuffled. A task gets the BLOCK leaves
    below one node and sweeps them with its own queue; between tasks digests and proof suffixes
    travel in sorted shuffles, a logarithm of rounds up and as many down.
    """
    changed = presented or {}
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = docs.select(
        tree.alias("tree"),
        F.col(order).alias("key"),
        leaf_digest(*(F.col(f) for f in fields)).alias("digest"),
        leaf_digest(*(changed.get(f, F.col(f)) for f in fields)).alias("presented"),
    )
    rounds, subroots = _raised(_numbered(written(leaves, "merkle-leaves"), "key", "digest"))
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    top_rounds, roots = _raised(_numbered(tops, "of"))
    root = roots.select(
        "tree",
        F.array().cast("array<string>").alias("lefts"),
        F.array().cast("array<string>").alias("rights"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    proofs = _lowered(top_rounds, root).select("index", "lefts", "rights", "root")
    named = top_rounds[0].select(F.col("index").alias("at"), F.col("of").alias("tree"), F.col("digest").alias("subroot"))
    below = proofs.join(named, F.col("index") == F.col("at")).select("tree", "lefts", "rights", "subroot", "root")
    found = _leaf_proofs(rounds, written(below, "merkle-proofs"), field_of(docs, order, order))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
