"""The one-to-one map from original to obfuscated ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import norm, user_id
from ..plans.model import ObfuscationError
from .common import kept, sized

MAPPING = "original_user_id string, obfuscated_user_id string"


def case_duplicates(users: DataFrame, id_col: str) -> DataFrame:
    """Ids that differ only by case or trailing blanks: (id_key, n)."""
    return users.filter(F.col(id_col).isNotNull()).groupBy(norm(F.col(id_col)).alias("id_key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unmapped(values: DataFrame, col: str, mapping: DataFrame) -> DataFrame:
    """Distinct keys of values that are neither original nor obfuscated ids: one column `original_user_id`."""
    keys = values.filter(F.col(col).isNotNull()).select(norm(F.col(col)).alias("original_user_id")).distinct()
    keys = keys.join(sized(mapping.select("original_user_id")), "original_user_id", "left_anti")
    taken = mapping.select(norm(F.col("obfuscated_user_id")).alias("original_user_id"))
    return keys.join(sized(taken), "original_user_id", "left_anti")


def extend(new: DataFrame, mapping: DataFrame, salt: str, max_len: int, attempts: int = 5) -> DataFrame:
    """Mapping rows for the keys in `new`, one obfuscated id each.

    A generated id that is taken, in the mapping or by a smaller key of the same attempt, is
    tried again with the next attempt. Every attempt is materialised, so ids never change by
    being computed again; collisions are rare, so the first attempt is usually the only one."""
    pending, taken, parts = new, mapping.select("obfuscated_user_id"), []
    for attempt in range(attempts + 1):
        tried = pending.select("original_user_id", user_id(F.col("original_user_id"), salt, attempt, max_len).alias("obfuscated_user_id"))
        first = F.row_number().over(Window.partitionBy("obfuscated_user_id").orderBy("original_user_id")) == 1
        won = tried.join(sized(taken), "obfuscated_user_id", "left_anti").withColumn("first", first).filter("first").drop("first")
        won = kept(won.select("original_user_id", "obfuscated_user_id"))
        parts.append(won)
        pending = pending.join(sized(won.select("original_user_id")), "original_user_id", "left_anti")
        if pending.isEmpty():
            break
        taken = taken.union(won.select("obfuscated_user_id"))
    else:
        raise ObfuscationError(f"{pending.count()} user id(s) collide after {attempts} retries")
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def fresh(users: DataFrame, id_col: str, mapping: DataFrame, salt: str, width: int, attempts: int = 5) -> DataFrame:
    """Rows for all users that the mapping lacks. Ids that are obfuscated already need none."""
    if not case_duplicates(users, id_col).isEmpty():
        raise ObfuscationError("user ids that differ only by case cannot be mapped one to one")
    return extend(unmapped(users, id_col, mapping), mapping, salt, max(width - 1, 8), attempts)


def build(users: DataFrame, id_col: str, mapping: DataFrame, salt: str, width: int, attempts: int = 5) -> DataFrame:
    """The mapping with rows for all users that it lacks."""
    return mapping.select("original_user_id", "obfuscated_user_id").union(fresh(users, id_col, mapping, salt, width, attempts))


def purge(mapping: DataFrame) -> DataFrame:
    """The mapping without originals: each becomes 'purged-' and its obfuscated id."""
    original = F.col("original_user_id")
    return mapping.withColumn("original_user_id", F.when(original.startswith("purged-"), original).otherwise(F.concat(F.lit("purged-"), "obfuscated_user_id")))
