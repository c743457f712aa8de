"""Index and type names, as Python strings and as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_name(full_name: str) -> tuple[str, str]:
    """``"shop.sales.Order"`` -> ``("shop.sales", "Order")``."""
    package, _, simple = full_name.rpartition(".")
    return package, simple


def property_name(full_name: str) -> str:
    simple = split_name(full_name)[1]
    return simple[:1].lower() + simple[1:]


def index_name(full_name: str, override: str | None = None) -> str:
    return (override or split_name(full_name)[0] or property_name(full_name)).lower()


def type_name(full_name: str) -> str:
    return full_name.lower().replace(".", "_")


def index_name_column(override: Column, package: Column, prop: Column) -> Column:
    """Row-wise form of :func:`index_name`, for rows that carry their own routing."""
    blank = F.lit("")
    return F.lower(F.coalesce(F.nullif(override, blank), F.nullif(package, blank), prop))


def type_name_column(full_name: Column) -> Column:
    return F.replace(F.lower(full_name), F.lit("."), F.lit("_"))
