"""Tables that are emptied rather than rewritten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_prefixes(tables: DataFrame, prefixes: tuple[str, ...], exclusions: DataFrame | None = None) -> DataFrame:
    """Base tables whose name starts with a prefix (case and underscore count), less excluded ones."""
    match = F.lit(False)
    for p in prefixes:
        match = match | F.startswith("table_name", F.lit(p))
    out = tables.filter((F.col("table_kind") == "BASE TABLE") & match).select("table_name")
    return out if exclusions is None else out.join(exclusions.select("table_name"), "table_name", "left_anti")


def emptied(table: DataFrame) -> DataFrame:
    return table.limit(0)
