"""Deterministic replacement values as Column expressions: no UDFs, all inside codegen.

Every value depends only on a key (the owner's obfuscated id, or another seed) and, for
ids, e-mails and hashes, on the salt."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An obfuscated id has at most this many hex digits, and at least LEAST_ID.
MOST_ID, LEAST_ID = 33, 9

# The default pools, in order of their seed ids.
FIRST_NAMES = (
    "David", "Sarah", "Michael", "Emma", "James", "Olivia", "Daniel", "Sophie", "Ryan", "Grace",
    "Thomas", "Chloe", "Andrew", "Hannah", "Matthew", "Ella", "Joshua", "Lily", "Nathan", "Zoe",
)
LAST_NAMES = (
    "Williams", "Brown", "Taylor", "Anderson", "Clark", "Mitchell", "Campbell", "Stewart", "Morris", "Rogers",
    "Reed", "Cook", "Bell", "Murphy", "Bailey", "Cooper", "Richardson", "Foster", "Hughes", "Price",
)
ADDRESSES = (
    "12 Wattle Street", "45 Banksia Road", "8 Coral Avenue", "21 Marigold Lane", "67 Grevillea Court",
    "3 Boronia Place", "19 Acacia Drive", "55 Hakea Crescent", "27 Melaleuca Way", "14 Bottlebrush Street",
)
#: Tag and default (for an empty pool) by kind.
POOLED = {"FIRST_NAME": ("fname", "Person"), "LAST_NAME": ("lname", "Surname"), "ADDRESS": ("addr", "1 Example Street")}
EMAIL_DOMAIN = "@example.invalid"
#: Widths where a column has none of its own.
WIDTHS = {"PHONE": 20, "ADDRESS": 255, "EMAIL": 254, "HASH": 64, "STATIC": 255}
TYPES = ("FIRST_NAME", "LAST_NAME", "PHONE", "ADDRESS", "EMAIL", "STATIC", "HASH")


def norm(value: Column) -> Column:
    """The binary key on which ids are compared: case and trailing blanks do not count."""
    return F.rtrim(F.lower(value))


def quote_identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quote_qualified(schema: str, table: str) -> str:
    return f"{quote_identifier(schema)}.{quote_identifier(table)}"


def id_length(max_len: int) -> int:
    """Hex digits of an id in a column that leaves max_len characters besides the dot."""
    return min(max(max_len, LEAST_ID), MOST_ID)


def user_id(original: Column, salt: str, attempt: int | Column = 0, max_len: int = MOST_ID) -> Column:
    """The obfuscated id: salted digest of the lower-case original, with a dot in its middle."""
    attempt = F.lit(str(attempt)) if isinstance(attempt, int) else attempt.cast("string")
    digest = F.sha2(F.concat(F.lit(salt), F.lit("|"), F.lower(original), F.lit("|"), attempt), 256)
    n = id_length(max_len)
    half = -(-n // 2)
    return F.concat(F.substring(digest, 1, half), F.lit("."), F.substring(digest, half + 1, n - half))


def pooled(kind: str, key: Column, pool: list[str]) -> Column:
    """A pool value picked by position, so that gaps in seed ids do not matter."""
    tag, default = POOLED[kind]
    if not pool:
        return F.when(key.isNotNull(), F.lit(default))
    place = F.crc32(F.sha2(F.concat(F.lit(tag + "|"), key), 256).cast("binary")) % len(pool)
    # element_at gives a value for a null place here, so a null key is told apart
    return F.when(key.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in pool]), (place + 1).cast("int")))


def phone(key: Column, width: int | None = None) -> Column:
    number = F.conv(F.substring(F.sha2(F.concat(F.lit("phone|"), key), 256), 1, 8), 16, 10).cast("bigint") % 100_000_000
    value = F.concat(F.lit("04"), F.lpad(number.cast("string"), 8, "0"))
    return F.left(value, F.lit(width)) if width and width > 0 else value


def email(key: Column, salt: str, width: int = WIDTHS["EMAIL"]) -> Column:
    mark = F.substring(F.sha2(F.concat(F.lit(salt + "|"), key), 256), 1, 16)
    return F.left(F.concat(F.lit("user_"), mark, F.lit(EMAIL_DOMAIN)), F.lit(width))


def hashed(key: Column, salt: str, width: int = WIDTHS["HASH"]) -> Column:
    return F.left(F.sha2(F.concat(F.lit(salt + "|"), key), 256), F.lit(width))


def static(value: str | None, width: int = WIDTHS["STATIC"]) -> Column:
    return F.lit((value or "")[:width])


def replacement(kind: str, key: Column, salt: str, pools: dict[str, list[str]], width: int | None = None, value: str | None = None) -> Column | None:
    """The new value of a column of a kind; None for a kind that is not known."""
    width = width or WIDTHS.get(kind)
    if kind in ("FIRST_NAME", "LAST_NAME"):
        return pooled(kind, key, pools[kind])
    if kind == "ADDRESS":
        return F.left(pooled(kind, key, pools[kind]), F.lit(width))
    if kind == "PHONE":
        return phone(key, width)
    if kind == "EMAIL":
        return email(key, salt, width)
    if kind == "HASH":
        return hashed(key, salt, width)
    if kind == "STATIC":
        return static(value, width)
    return None


def default_pools() -> dict[str, list[str]]:
    return {"FIRST_NAME": list(FIRST_NAMES), "LAST_NAME": list(LAST_NAMES), "ADDRESS": list(ADDRESSES)}


def register(spark, salt: str) -> None:
    """SQL functions of the same values, callable from spark.sql as temporary functions."""
    pools = default_pools()
    array = lambda kind: "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in pools[kind]) + ")"
    for name, kind in (("synthetic_first_name", "FIRST_NAME"), ("synthetic_last_name", "LAST_NAME"), ("synthetic_address", "ADDRESS")):
        tag = POOLED[kind][0]
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(k STRING) RETURNS STRING "
            f"RETURN element_at({array(kind)}, CAST(crc32(CAST(sha2(concat('{tag}|', k), 256) AS BINARY)) % {len(pools[kind])} + 1 AS INT))"
        )
    safe = salt.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION synthetic_phone(k STRING) RETURNS STRING "
        "RETURN concat('04', lpad(CAST(CAST(conv(substring(sha2(concat('phone|', k), 256), 1, 8), 16, 10) AS BIGINT) % 100000000 AS STRING), 8, '0'))"
    )
    digest = f"sha2(concat('{safe}|', lower(o), '|', attempt), 256)"
    n = f"least(greatest(max_len, {LEAST_ID}), {MOST_ID})"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION obfuscated_user_id(o STRING, attempt INT, max_len INT DEFAULT {MOST_ID}) RETURNS STRING "
        f"RETURN concat(substring({digest}, 1, ({n} + 1) div 2), '.', substring({digest}, ({n} + 1) div 2 + 1, {n} div 2))"
    )
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION quote_identifier(s STRING) RETURNS STRING RETURN concat('`', replace(s, '`', '``'), '`')")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION quote_qualified(s STRING, t STRING) RETURNS STRING "
        "RETURN concat('`', replace(s, '`', '``'), '`.`', replace(t, '`', '``'), '`')"
    )
