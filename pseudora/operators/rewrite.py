"""Rewriting tables: ids through the mapping, personal columns from the owner's id.

Each table is read once and written once: reference columns, the user key and all
configured columns are one projection over joins with the mapping."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import MOST_ID, norm, replacement, user_id
from .common import fits, kept, sized
from .mapping import unmapped


@dataclass(frozen=True)
class Configured:
    """A configured personal column."""

    column: str
    kind: str
    width: int | None = None
    value: str | None = None


def exceptions(values: DataFrame, column: str, mapping: DataFrame, salt: str, max_len: int) -> DataFrame:
    """Keys of a column whose first generated id is not what the mapping gives: (key, becomes).

    These are values that the mapping lacks, which stay (`becomes` is null), and originals whose
    id was taken, or came with another salt. Reads one column; repeats go before the shuffle."""
    keys = values.select(norm(F.col(f"`{column}`").cast("string")).alias("key")).filter("key IS NOT NULL").distinct()
    found = keys.join(mapping.select("original_user_id", F.col("obfuscated_user_id").alias("becomes")), F.col("key") == F.col("original_user_id"), "left")
    return found.filter(~F.col("becomes").eqNullSafe(user_id(F.col("key"), salt, 0, max_len))).select("key", "becomes")


def rewrite_ids(table: DataFrame, columns: list[str], mapping: DataFrame, salt: str | None = None, max_len: int = MOST_ID, values: DataFrame | None = None) -> DataFrame:
    """Every id in `columns` that is an original becomes its obfuscated id; others stay.

    A mapping within the broadcast limit is joined. Beyond it, if the salt and length of its
    ids are given, ids are computed in their rows and only the exceptions are joined, so a wide
    table is not shuffled; results are the same. `values` has the same columns (or more values
    of them) from a cheaper plan, to look for exceptions in."""
    out, inplace = table, salt is not None and not fits(mapping.select("original_user_id", "obfuscated_user_id"))
    for i, name in enumerate(columns):
        old = F.col(f"`{name}`")
        key = norm(old.cast("string"))
        if inplace:
            side = kept(exceptions(table if values is None else values, name, mapping, salt, max_len)).withColumn("found", F.lit(True))
            new = F.when(F.col(f"__f{i}"), F.coalesce(F.col(f"__x{i}"), old)).otherwise(user_id(key, salt, 0, max_len))
        else:
            side = mapping.select(F.col("original_user_id").alias("key"), F.col("obfuscated_user_id").alias("becomes"), F.lit(True).alias("found"))
            new = F.coalesce(F.col(f"__x{i}"), old)
        side = side.select(F.col("key").alias(f"__o{i}"), F.col("becomes").alias(f"__x{i}"), F.col("found").alias(f"__f{i}"))
        out = out.join(sized(side), key == F.col(f"__o{i}"), "left").withColumn(name, new).drop(f"__o{i}", f"__x{i}", f"__f{i}")
    return out.select(*[F.col(f"`{c}`") for c in table.columns])


def nullify(table: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Values of a reference column that no known person has become null.

    Beyond the broadcast limit the distinct strays are joined, which are few, not all known ids."""
    if not fits(mapping.select("original_user_id", "obfuscated_user_id")):
        strays = kept(unmapped(table.select(F.col(f"`{column}`").cast("string").alias("v")), "v", mapping))
        strays = strays.select(F.col("original_user_id").alias("__k"), F.lit(True).alias("__stray"))
        out = table.join(sized(strays), norm(F.col(f"`{column}`").cast("string")) == F.col("__k"), "left")
        return out.withColumn(column, F.when(F.col("__stray").isNull(), F.col(f"`{column}`"))).select(*[F.col(f"`{c}`") for c in table.columns])
    known = mapping.select(F.col("original_user_id").alias("__k")).union(mapping.select(norm(F.col("obfuscated_user_id")))).distinct().withColumn("__known", F.lit(True))
    out = table.join(sized(known), norm(F.col(f"`{column}`").cast("string")) == F.col("__k"), "left")
    return out.withColumn(column, F.when(F.col("__known"), F.col(f"`{column}`"))).select(*[F.col(f"`{c}`") for c in table.columns])


def guarded(old: Column, new: Column) -> Column:
    """The new value where there is an old one; nulls stay null."""
    return F.when(old.isNotNull(), F.coalesce(new, old))


def configured(table: DataFrame, columns: list[Configured], seed: Column, salt: str, pools: dict[str, list[str]]) -> DataFrame:
    """All configured columns replaced in one projection, from a seed that reads rewritten ids."""
    key = seed.cast("string")
    made = {}
    for c in columns:
        new = replacement(c.kind, key, salt, pools, c.width, c.value)
        if new is not None:
            made[c.column] = guarded(F.col(f"`{c.column}`").cast("string"), new)
    return table.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in table.columns])


def seed_column(references: list[tuple[str, str]], primary_key: tuple[str, ...], override: str | None) -> tuple[str, ...] | None:
    """The columns whose first non-null value seeds a table, or None.

    An enabled reference column comes first (foreign keys before others, then by name), with
    the primary key for rows where it is null; else the primary key; else an override."""
    pk = primary_key[0] if primary_key else None
    if references:
        ref = min(references, key=lambda r: (r[1] != "FOREIGN_KEY", r[0]))[0]
        return (ref, pk) if pk and pk != ref else (ref,)
    chosen = pk or override
    return (chosen,) if chosen else None


def seed_of(columns: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.col(f"`{c}`").cast("string") for c in columns])


def is_string(table: DataFrame, column: str) -> bool:
    return isinstance(table.schema[column].dataType, T.StringType | T.VarcharType | T.CharType)
