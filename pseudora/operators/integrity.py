"""Foreign keys as logical state: definitions, and rows that break them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import norm
from .rewrite import is_string


def definitions(foreign_keys: DataFrame, user_table: str) -> DataFrame:
    """One row per key to the user table, columns listed in order."""
    found = foreign_keys.filter(F.col("ref_table") == user_table)
    listed = lambda c: F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("ordinal", c))), lambda x: x[c]))
    return found.groupBy("constraint_name", "table_name", "ref_table", "update_rule", "delete_rule").agg(
        listed("column_name").alias("column_list"), listed("ref_column").alias("ref_column_list")
    )


def violations(child: DataFrame, columns: list[str], parent: DataFrame, ref_columns: list[str]) -> DataFrame:
    """Child rows without a parent; a row with a null in the key passes."""
    names = [f"__p{i}" for i in range(len(columns))]
    keys = parent.select(*[F.col(f"`{r}`").alias(n) for r, n in zip(ref_columns, names, strict=True)]).distinct()
    on, whole = F.lit(True), F.lit(True)
    for c, n in zip(columns, names, strict=True):
        same = F.col(f"`{c}`") == F.col(n)
        if is_string(child, c) and is_string(keys, n):  # ids compare by case and trailing blanks, numbers as they are
            same = norm(F.col(f"`{c}`")) == norm(F.col(n))
        elif is_string(child, c) != is_string(keys, n):
            same = F.col(f"`{c}`").cast("string") == F.col(n).cast("string")
        on = on & same
        whole = whole & F.col(f"`{c}`").isNotNull()
    return child.filter(whole).join(keys, on, "left_anti")
