"""References that match no known person: report and policy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import norm
from .common import empty, sized

REPORT = "table_name string, column_name string, orphan_action string, orphan_value string, rows_with_value bigint"


def strays(table: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Values that are neither original nor obfuscated ids, with the rows that hold them.

    Values are counted before the anti joins, so a hot value crosses the shuffle once a task."""
    counted = table.filter(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`").cast("string").alias("orphan_value")).agg(F.count(F.lit(1)).alias("rows_with_value"))
    counted = counted.withColumn("__k", norm(F.col("orphan_value")))
    counted = counted.join(sized(mapping.select(F.col("original_user_id").alias("__k"))), "__k", "left_anti")
    return counted.join(sized(mapping.select(norm(F.col("obfuscated_user_id")).alias("__k"))), "__k", "left_anti").drop("__k")


def report(tables: dict[str, DataFrame], references: list[tuple[str, str, str]], mapping: DataFrame) -> DataFrame:
    """One row per stray value of each reference (table, column, action)."""
    parts = [
        strays(tables[t], c, mapping).select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.lit(a).alias("orphan_action"), "orphan_value", "rows_with_value")
        for t, c, a in references if t in tables
    ]
    if not parts:
        return empty(mapping.sparkSession, REPORT)
    return reduce(DataFrame.unionByName, parts)


def summary(found: DataFrame) -> DataFrame:
    """actionable rows and columns: those whose action is not IGNORE."""
    act = F.col("orphan_action") != "IGNORE"
    return found.agg(
        F.coalesce(F.sum(F.when(act, F.col("rows_with_value"))), F.lit(0)).cast("bigint").alias("actionable_rows"),
        F.countDistinct(F.when(act, F.concat("table_name", F.lit("."), "column_name"))).alias("actionable_columns"),
    )
