"""Proof after a run: references, row counts, leftover personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import EMAIL_DOMAIN, norm
from .common import sized


def unknown_references(table: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Rows whose reference is not null and no obfuscated id."""
    ids = mapping.select(norm(F.col("obfuscated_user_id")).alias("__k")).distinct()
    return table.filter(F.col(f"`{column}`").isNotNull()).join(sized(ids), norm(F.col(f"`{column}`")) == F.col("__k"), "left_anti")


def reconcile(snapshots: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Tables whose AFTER count differs from BEFORE; `excluded` ones are expected to."""
    before = snapshots.filter("phase = 'BEFORE'").select("table_name", F.col("rows_counted").alias("before"))
    after = snapshots.filter("phase = 'AFTER'").select("table_name", F.col("rows_counted").alias("after"))
    out = before.join(after, "table_name").filter(F.col("before") != F.col("after"))
    return out.join(exclusions.select("table_name").distinct().withColumn("excluded", F.lit(True)), "table_name", "left").withColumn("excluded", F.coalesce("excluded", F.lit(False)))


def residual(kind: str, column: Column, pools: dict[str, list[str]]) -> Column | None:
    """Whether a value is not what a kind writes; None for kinds that are not checked."""
    if kind == "EMAIL":
        return ~column.endswith(EMAIL_DOMAIN)
    if kind in ("FIRST_NAME", "LAST_NAME"):
        return ~F.lower(column).isin([v.lower() for v in pools[kind]])
    if kind == "ADDRESS":
        starts = F.lit(False)
        for v in pools[kind]:  # equal to a value, or the part of it that fits
            starts = starts | F.startswith(F.lit(v.lower()), F.lower(column))
        return ~starts
    if kind == "PHONE":
        return ~column.rlike("^04[0-9]{1,8}$")
    return None


def residuals(table: DataFrame, columns: dict[str, str], pools: dict[str, list[str]]) -> DataFrame:
    """One row: for each configured column the rows that still hold something else; one pass over the table."""
    made = []
    for name, kind in columns.items():
        bad = residual(kind, F.col(f"`{name}`").cast("string"), pools)
        if bad is not None:
            made.append(F.count_if(F.col(f"`{name}`").isNotNull() & bad).alias(name))
    return table.agg(*made) if made else table.sparkSession.range(0)
