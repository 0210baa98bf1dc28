"""Which columns refer to users: foreign keys, naming convention, manual rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REGISTRY = "table_name string, column_name string, discovery_method string, constraint_name string, enabled boolean, orphan_action string"


def foreign_key_columns(foreign_keys: DataFrame, user_table: str, user_key: str) -> DataFrame:
    """(table_name, column_name, constraint_name) of keys to the user key."""
    found = foreign_keys.filter((F.col("ref_table") == user_table) & (F.col("ref_column") == user_key))
    return found.groupBy("table_name", "column_name").agg(F.min("constraint_name").alias("constraint_name"))


def naming_columns(columns: DataFrame, tables: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Columns of base tables with a conventional name."""
    base = tables.filter(F.col("table_kind") == "BASE TABLE").select("table_name")
    return columns.filter(F.col("column_name").isin(*names)).join(base, "table_name").select("table_name", "column_name")


def discover(frames: dict[str, DataFrame], registry: DataFrame, user_table: str, user_key: str, names: tuple[str, ...]) -> DataFrame:
    """The registry after discovery.

    Foreign keys are entered or brought up to date and enabled; names are entered only where
    nothing is registered yet; rows whose column is gone are disabled."""
    fk = foreign_key_columns(frames["foreign_keys"], user_table, user_key).withColumnRenamed("constraint_name", "fk").withColumn("is_fk", F.lit(True))
    kept = registry.join(fk, ["table_name", "column_name"], "full_outer").select(
        "table_name",
        "column_name",
        F.when(F.col("is_fk"), "FOREIGN_KEY").otherwise(F.col("discovery_method")).alias("discovery_method"),
        F.when(F.col("is_fk"), F.col("fk")).otherwise(F.col("constraint_name")).alias("constraint_name"),
        F.when(F.col("is_fk"), True).otherwise(F.col("enabled")).alias("enabled"),
        F.coalesce("orphan_action", F.lit("OBFUSCATE")).alias("orphan_action"),
    )
    named = naming_columns(frames["columns"], frames["tables"], names).join(kept, ["table_name", "column_name"], "left_anti")
    named = named.select(
        "table_name", "column_name", F.lit("NAMING_CONVENTION").alias("discovery_method"), F.lit(None).cast("string").alias("constraint_name"),
        F.lit(True).alias("enabled"), F.lit("OBFUSCATE").alias("orphan_action"),
    )
    return disable_stale(kept.unionByName(named), frames)


def stale(registry: DataFrame, frames: dict[str, DataFrame]) -> DataFrame:
    """Enabled rows whose column is no column of a base table."""
    base = frames["tables"].filter(F.col("table_kind") == "BASE TABLE").select("table_name")
    live = frames["columns"].join(base, "table_name").select("table_name", "column_name")
    return registry.filter("enabled").join(live, ["table_name", "column_name"], "left_anti")


def disable_stale(registry: DataFrame, frames: dict[str, DataFrame]) -> DataFrame:
    gone = stale(registry, frames).select("table_name", "column_name").withColumn("gone", F.lit(True))
    out = registry.join(gone, ["table_name", "column_name"], "left")
    return out.withColumn("enabled", F.col("enabled") & F.col("gone").isNull()).drop("gone")


def type_check(registry: DataFrame, columns: DataFrame, string_like: tuple[str, ...]) -> DataFrame:
    """The registry with each column's type and whether it can hold an id."""
    return registry.join(columns.select("table_name", "column_name", "data_type"), ["table_name", "column_name"], "left").withColumn(
        "type_looks_compatible", F.coalesce(F.lower("data_type").isin(*string_like), F.lit(False)).cast("int")
    )
