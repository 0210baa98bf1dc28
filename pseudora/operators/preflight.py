"""Checks before any table is changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import EMAIL_DOMAIN, LEAST_ID, MOST_ID

#: The narrowest columns whose replacement still passes the checks afterwards.
LEAST_WIDTH = {"EMAIL": len("user_") + 16 + len(EMAIL_DOMAIN), "PHONE": 3}


def missing_columns(config: DataFrame, columns: DataFrame) -> DataFrame:
    """Enabled config rows whose column does not exist."""
    return config.filter("enabled").join(columns, ["table_name", "column_name"], "left_anti").select("table_name", "column_name")


def unique_columns(config: DataFrame, unique_keys: DataFrame) -> DataFrame:
    """Enabled config rows inside a unique index, with its number of columns."""
    return config.filter("enabled").join(unique_keys, ["table_name", "column_name"]).select("table_name", "column_name", "obfuscation_type", "index_name", "index_columns")


def static_unique(config: DataFrame, unique_keys: DataFrame) -> DataFrame:
    """STATIC columns that are a unique index of their own: fatal with two rows or more."""
    return unique_columns(config, unique_keys).filter((F.col("obfuscation_type") == "STATIC") & (F.col("index_columns") == 1))


def required_width(user_width: int) -> int:
    """Characters that a reference to a user key of this width needs."""
    return min(max(user_width - 1, LEAST_ID), MOST_ID) + 1


def narrow_references(registry: DataFrame, columns: DataFrame, user_width: int) -> DataFrame:
    """Enabled references too narrow for an obfuscated id."""
    need = required_width(user_width)
    found = registry.filter("enabled").join(columns.select("table_name", "column_name", "width"), ["table_name", "column_name"])
    return found.filter(F.col("width") < need).select("table_name", "column_name", "width", F.lit(need).alias("required_width"))


def narrow_values(config: DataFrame, columns: DataFrame) -> DataFrame:
    """Enabled columns too narrow for any replacement of their kind."""
    need = F.lit(None).cast("int")
    for kind, least in LEAST_WIDTH.items():
        need = F.when(F.col("obfuscation_type") == kind, least).otherwise(need)
    found = config.filter("enabled").join(columns.select("table_name", "column_name", "width"), ["table_name", "column_name"]).withColumn("required_width", need)
    return found.filter(F.col("width") < F.col("required_width")).select("table_name", "column_name", "obfuscation_type", "width", "required_width")
