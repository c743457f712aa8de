"""Value conversions between entity columns and document text."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsearch.settings import DATE_IN_FORMATS, DATE_OUT_FORMAT


@dataclass(frozen=True)
class Converter:
    """A pair of column functions: entity value -> text, and text -> entity value."""

    out: Callable[[Column], Column]
    into: Callable[[Column], Column]


#: enum-like text stored in lower case
lower_case = Converter(out=F.lower, into=F.upper)


def date_out(value: Column, zoned: bool = False) -> Column:
    """Any date or timestamp as one ISO text with milliseconds, in UTC. Only a ``zoned`` one, which
    Spark would show in the session's time zone, has to be moved there."""
    if zoned:
        value = F.convert_timezone(F.current_timezone(), F.lit("UTC"), value.cast("timestamp_ntz"))
    return F.date_format(value, DATE_OUT_FORMAT)


def date_in(text: Column, formats: Sequence[str] = DATE_IN_FORMATS) -> Column:
    """Text to timestamp by the first pattern that fits; null when none does."""
    tries = [F.try_to_timestamp(text, F.lit(pattern)) for pattern in formats]
    return F.coalesce(*tries).cast("timestamp_ntz")


def json_map(text: Column) -> Column:
    """A JSON object held as text, as a map of texts."""
    return F.from_json(text, "map<string,string>")
