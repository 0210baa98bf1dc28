"""The engine's registered queries, and the SQL they are held against.

Users, actors and audit rows are views over the star tables that hold the cases the
operators are for: departed users, case variants, nulls, a system account. Each query
applies its operator to whole tables; metadata operators run over a model given below."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import discovery, integrity, mapping, orphans, preflight, rewrite, truncation, validation
from ..operators.common import empty, local_rows, shared_dir
from ..sources.store import Store, Target
from .engine import ASSESSMENTS, Engine
from .model import STRING_LIKE, ColumnInfo, EngineConfig, ForeignKey, ObfuscationError, SchemaModel, Table

SALT, WIDTH = "test-salt-001", 255
POOLS = C.default_pools()
QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# -- views ------------------------------------------------------------------------------


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def uid_of(key: str):
    return F.concat(F.lit("User."), F.lpad(F.col(key).cast("string"), 6, "0"))


def users(spark, sf) -> DataFrame:
    """Customers but every tenth, who has left."""
    c = read(spark, sf, "customer").filter(F.col("c_custkey") % 10 != 9)
    k = F.col("c_custkey")
    return c.select(
        k.alias("user_no"),
        uid_of("c_custkey").alias("user_id"),
        F.col("c_name").alias("first_name"),
        F.when(k % 12 != 5, F.col("c_mktsegment")).alias("last_name"),
        F.when(k % 9 == 4, F.lit(None)).when(k % 7 == 3, F.concat(F.lit("+61 "), k.cast("string"))).otherwise(F.concat(F.lit("04"), F.lpad(k.cast("string"), 8, "0"))).alias("phone"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(" Real Street")).alias("address"),
        F.concat(F.lower("c_name"), F.lit("@corp.example")).alias("email"),
    )


def actors(spark, sf) -> DataFrame:
    """Orders: an owner, and a creator who may be the system, nobody, or a case variant."""
    o = read(spark, sf, "orders")
    k, owner = F.col("o_orderkey"), uid_of("o_custkey")
    return o.select(
        k.alias("actor_id"),
        owner.alias("user_id"),
        F.when(k % 13 == 0, "SYSTEM").when(k % 11 == 0, F.lit(None)).when(k % 7 == 0, F.upper(owner)).otherwise(owner).alias("created_by"),
        F.col("o_orderpriority").alias("first_name"),
        F.col("o_orderstatus").alias("last_name"),
    )


def audits(spark, sf) -> DataFrame:
    return read(spark, sf, "events").select("event_id", uid_of("user_id").alias("user_id"), "event_type")


U = """u AS (
  SELECT c_custkey AS user_no, 'User.' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS user_id, c_name AS first_name,
         CASE WHEN c_custkey % 12 <> 5 THEN c_mktsegment END AS last_name,
         CASE WHEN c_custkey % 9 = 4 THEN NULL WHEN c_custkey % 7 = 3 THEN '+61 ' || c_custkey ELSE '04' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS phone,
         c_nationkey || ' Real Street' AS address, lower(c_name) || '@corp.example' AS email
  FROM customer WHERE c_custkey % 10 <> 9)"""
A = """a AS (
  SELECT o_orderkey AS actor_id, user_id, CASE WHEN o_orderkey % 13 = 0 THEN 'SYSTEM' WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN upper(user_id) ELSE user_id END AS created_by,
         o_orderpriority AS first_name, o_orderstatus AS last_name
  FROM (SELECT *, 'User.' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS user_id FROM orders))"""
E = """e AS (SELECT event_id, 'User.' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS user_id, event_type FROM events)"""


def sql_id(original: str, salt: str = SALT, attempt: str = "'0'", max_len: int = WIDTH - 1) -> str:
    n = C.id_length(max_len)
    half = -(-n // 2)
    digest = f"sha256('{salt}|' || lower({original}) || '|' || {attempt})"
    return f"(substr({digest}, 1, {half}) || '.' || substr({digest}, {half + 1}, {n - half}))"


def sql_crc(text: str) -> str:
    """The CRC-32 of a hex string, bit by bit."""
    bits = "list_reduce([xor(a, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, y: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)), lambda a, b: {bits}), 4294967295::BIGINT)"


def sql_pool(kind: str, key: str, pool=None) -> str:
    values = POOLS[kind] if pool is None else pool
    listed = "[" + ", ".join(f"'{v}'" for v in values) + "]"
    tag = C.POOLED[kind][0]
    return f"{listed}[CAST({sql_crc(f'''sha256('{tag}|' || {key})''')} % {len(values)} AS INT) + 1]"


def sql_phone(key: str) -> str:
    return f"('04' || lpad(CAST((('0x' || substr(sha256('phone|' || {key}), 1, 8))::BIGINT % 100000000) AS VARCHAR), 8, '0'))"


def sql_email(key: str) -> str:
    return f"('user_' || substr(sha256('{SALT}|' || {key}), 1, 16) || '@example.invalid')"


M = f"m AS (SELECT lower(user_id) AS original_user_id, {sql_id('user_id')} AS obfuscated_user_id FROM u)"
#: The mapping with the orphans of created_by and user_id of the actors.
MO = f"""o AS (SELECT DISTINCT rtrim(lower(v)) AS k FROM (SELECT user_id AS v FROM a UNION ALL SELECT created_by FROM a) WHERE v IS NOT NULL),
mo AS (SELECT * FROM m UNION ALL SELECT k, {sql_id("k")} FROM o WHERE k NOT IN (SELECT original_user_id FROM m))"""


def no_mapping(spark) -> DataFrame:
    return empty(spark, mapping.MAPPING)


def base_mapping(spark, sf, salt=SALT) -> DataFrame:
    return mapping.build(users(spark, sf), "user_id", no_mapping(spark), salt, WIDTH)


def whole_mapping(spark, sf) -> DataFrame:
    """With orphans of the actors' references, as their policy OBFUSCATE has it."""
    m, a = base_mapping(spark, sf), actors(spark, sf)
    values = a.select(F.col("user_id").alias("v")).union(a.select("created_by"))
    return m.union(mapping.extend(mapping.unmapped(values, "v", m), m, SALT, WIDTH - 1))


# -- R3 to R7: values -------------------------------------------------------------------


@query("user_id_generate", f"WITH {U} SELECT user_id, {sql_id('user_id')} AS obfuscated FROM u")
def _(spark, sf):
    return users(spark, sf).select("user_id", C.user_id(F.col("user_id"), SALT, 0, WIDTH - 1).alias("obfuscated"))


@query("user_id_attempts", f"WITH {U} SELECT user_id, CAST(n AS INT) AS attempt, {sql_id('user_id', attempt='n')} AS obfuscated FROM u, (SELECT unnest(range(0, 6)) AS n)")
def _(spark, sf):
    each = users(spark, sf).select("user_id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("attempt"))
    return each.select("user_id", "attempt", C.user_id(F.col("user_id"), SALT, F.col("attempt"), WIDTH - 1).alias("obfuscated"))


_WIDTHS = (5, 8, 9, 20, 33, 254)


@query("user_id_width_cap", f"WITH {U} SELECT user_id, " + ", ".join(f"{sql_id('user_id', max_len=w)} AS w{w}" for w in _WIDTHS) + " FROM u")
def _(spark, sf):
    return users(spark, sf).select("user_id", *[C.user_id(F.col("user_id"), SALT, 0, w).alias(f"w{w}") for w in _WIDTHS])


def _pool_query(kind, pool=None):
    def run(spark, sf):
        return users(spark, sf).select("user_id", C.pooled(kind, F.col("user_id"), POOLS[kind] if pool is None else pool).alias("value"))

    return run


for _kind in ("FIRST_NAME", "LAST_NAME", "ADDRESS"):
    query(f"synthetic_{_kind.lower()}", f"WITH {U} SELECT user_id, {sql_pool(_kind, 'user_id')} AS value FROM u")(_pool_query(_kind))
#: Seed ids with gaps: only their order counts.
GAPPY = {10: "Ann", 25: "Ben", 500: "Cid", 9999: "Dot"}
query("synthetic_first_name_gappy_pool", f"WITH {U} SELECT user_id, {sql_pool('FIRST_NAME', 'user_id', [GAPPY[k] for k in sorted(GAPPY)])} AS value FROM u")(
    _pool_query("FIRST_NAME", [GAPPY[k] for k in sorted(GAPPY)])
)


@query("synthetic_empty_pool_default", f"WITH {U} SELECT user_id, 'Person' AS first_name, 'Surname' AS last_name, '1 Example Street' AS address FROM u")
def _(spark, sf):
    return users(spark, sf).select("user_id", *[C.pooled(k, F.col("user_id"), []).alias(k.lower()) for k in ("FIRST_NAME", "LAST_NAME", "ADDRESS")])


@query("synthetic_phone", f"WITH {U} SELECT user_id, {sql_phone('user_id')} AS value FROM u")
def _(spark, sf):
    return users(spark, sf).select("user_id", C.phone(F.col("user_id")).alias("value"))


@query("synthetic_phone_truncated", f"WITH {U} SELECT user_id, substr({sql_phone('user_id')}, 1, 6) AS w6, {sql_phone('user_id')} AS w0 FROM u")
def _(spark, sf):
    return users(spark, sf).select("user_id", C.phone(F.col("user_id"), 6).alias("w6"), C.phone(F.col("user_id"), 0).alias("w0"))


@query("email_obfuscate", f"WITH {U} SELECT user_id, {sql_email('user_id')} AS value, substr({sql_email('user_id')}, 1, 20) AS w20 FROM u")
def _(spark, sf):
    return users(spark, sf).select("user_id", C.email(F.col("user_id"), SALT).alias("value"), C.email(F.col("user_id"), SALT, 20).alias("w20"))


@query("hash_obfuscate", f"WITH {U} SELECT user_id, sha256('{SALT}|' || user_id) AS value, substr(sha256('{SALT}|' || user_id), 1, 16) AS w16 FROM u")
def _(spark, sf):
    return users(spark, sf).select("user_id", C.hashed(F.col("user_id"), SALT).alias("value"), C.hashed(F.col("user_id"), SALT, 16).alias("w16"))


@query("static_obfuscate", f"WITH {U} SELECT user_id, 'REDACTED' AS value, 'REDA' AS w4, '' AS empty FROM u")
def _(spark, sf):
    return users(spark, sf).select("user_id", C.static("REDACTED").alias("value"), C.static("REDACTED", 4).alias("w4"), C.static(None).alias("empty"))


# -- R14, R24: the mapping --------------------------------------------------------------


@query("mapping_build", f"WITH {U}, {M} SELECT * FROM m")
def _(spark, sf):
    return base_mapping(spark, sf)


@query("mapping_idempotent", f"WITH {U}, {M} SELECT * FROM m")
def _(spark, sf):
    m = base_mapping(spark, sf)
    done = rewrite.rewrite_ids(users(spark, sf), ["user_id"], m)
    return mapping.build(done, "user_id", m, SALT, WIDTH)


_SEEDED = "SELECT 'earlier-' || user_no AS original_user_id, " + sql_id("user_id") + " AS obfuscated_user_id FROM u WHERE user_no % 50 = 1"


@query("mapping_collision", f"WITH {U} SELECT lower(user_id) AS original_user_id, CASE WHEN user_no % 50 = 1 THEN {sql_id('user_id', attempt=chr(39) + '1' + chr(39))} ELSE {sql_id('user_id')} END AS obfuscated_user_id FROM u UNION ALL {_SEEDED}")
def _(spark, sf):
    """Ids of every fiftieth user are taken already: these users get their next attempt."""
    u = users(spark, sf)
    held = u.filter("user_no % 50 = 1").select(
        F.concat(F.lit("earlier-"), F.col("user_no").cast("string")).alias("original_user_id"), C.user_id(F.col("user_id"), SALT, 0, WIDTH - 1).alias("obfuscated_user_id")
    )
    return mapping.build(u, "user_id", held, SALT, WIDTH)


@query("mapping_case_duplicates", f"WITH {U}, {A} SELECT rtrim(lower(v)) AS id_key, count(*) AS n FROM (SELECT DISTINCT created_by AS v FROM a WHERE created_by IS NOT NULL) GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    return mapping.case_duplicates(actors(spark, sf).select("created_by").distinct(), "created_by")


@query("mapping_multi_target", f"WITH {U} SELECT lower(user_id) AS original_user_id, {sql_id('user_id')} AS one, {sql_id('user_id', salt='other-salt')} AS two, {sql_id('user_id')} = {sql_id('user_id', salt='other-salt')} AS same FROM u")
def _(spark, sf):
    one = base_mapping(spark, sf).withColumnRenamed("obfuscated_user_id", "one")
    two = base_mapping(spark, sf, "other-salt").withColumnRenamed("obfuscated_user_id", "two")
    return one.join(two, "original_user_id").withColumn("same", F.col("one") == F.col("two"))


@query("purge_mapping", f"WITH {U}, {M} SELECT 'purged-' || obfuscated_user_id AS original_user_id, obfuscated_user_id FROM m")
def _(spark, sf):
    return mapping.purge(mapping.purge(base_mapping(spark, sf)))


# -- R16, R19, R20: rewriting ids --------------------------------------------------------


@query("reference_rewrite", f"WITH {U}, {E}, {M} SELECT event_id, coalesce(obfuscated_user_id, user_id) AS user_id, event_type FROM e LEFT JOIN m ON lower(user_id) = original_user_id")
def _(spark, sf):
    return rewrite.rewrite_ids(audits(spark, sf), ["user_id"], base_mapping(spark, sf))


_REWRITE_A = "SELECT actor_id, coalesce(x.obfuscated_user_id, user_id) AS user_id, coalesce(y.obfuscated_user_id, created_by) AS created_by, first_name, last_name FROM a LEFT JOIN {m} x ON lower(user_id) = x.original_user_id LEFT JOIN {m} y ON lower(created_by) = y.original_user_id"


@query("reference_rewrite_case_variant", f"WITH {U}, {A}, {M} {_REWRITE_A.format(m='m')}")
def _(spark, sf):
    return rewrite.rewrite_ids(actors(spark, sf), ["user_id", "created_by"], base_mapping(spark, sf))


@query("lineitem_reference_rewrite", f"WITH {U}, {M}, l AS (SELECT l_orderkey, l_linenumber, l_partkey, 'User.' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS handler FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, coalesce(obfuscated_user_id, handler) AS handler FROM l LEFT JOIN m ON lower(handler) = original_user_id")
def _(spark, sf):
    l = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", uid_of("l_suppkey").alias("handler"))
    return rewrite.rewrite_ids(l, ["handler"], base_mapping(spark, sf))


@query("user_table_rewrite", f"WITH {U} SELECT user_no, {sql_id('user_id')} AS user_id, first_name, last_name, phone, address, email FROM u")
def _(spark, sf):
    return rewrite.rewrite_ids(users(spark, sf), ["user_id"], base_mapping(spark, sf))


@query("orphan_nullify", f"WITH {U}, {A}, {M} SELECT actor_id, user_id, CASE WHEN lower(created_by) IN (SELECT original_user_id FROM m) THEN created_by END AS created_by, first_name, last_name FROM a")
def _(spark, sf):
    return rewrite.nullify(actors(spark, sf), "created_by", base_mapping(spark, sf))


@query("orphan_ignore", f"WITH {U}, {A}, {M} SELECT actor_id, coalesce(obfuscated_user_id, created_by) AS created_by, created_by IS NOT NULL AND obfuscated_user_id IS NULL AS left_alone FROM a LEFT JOIN m ON lower(created_by) = original_user_id")
def _(spark, sf):
    a = actors(spark, sf).select("actor_id", "created_by")
    out = rewrite.rewrite_ids(a.withColumn("old", F.col("created_by")), ["created_by"], base_mapping(spark, sf))
    return out.select("actor_id", "created_by", F.coalesce(F.col("created_by") == F.col("old"), F.lit(False)).alias("left_alone"))


@query("orphan_obfuscate", f"WITH {U}, {A}, {M}, {MO} {_REWRITE_A.format(m='mo')}")
def _(spark, sf):
    return rewrite.rewrite_ids(actors(spark, sf), ["user_id", "created_by"], whole_mapping(spark, sf))


# -- R15: orphans -----------------------------------------------------------------------

_STRAYS = f"""WITH {U}, {A}, {E}, {M}, r AS (
  SELECT 'actor' AS table_name, 'user_id' AS column_name, 'OBFUSCATE' AS orphan_action, user_id AS v FROM a
  UNION ALL SELECT 'actor', 'created_by', 'NULLIFY', created_by FROM a
  UNION ALL SELECT 'audit', 'user_id', 'IGNORE', user_id FROM e),
s AS (
  SELECT table_name, column_name, orphan_action, v AS orphan_value, count(*) AS rows_with_value FROM r
  WHERE v IS NOT NULL AND lower(v) NOT IN (SELECT original_user_id FROM m) AND lower(v) NOT IN (SELECT obfuscated_user_id FROM m) GROUP BY ALL)"""


def _strays(spark, sf):
    refs = [("actor", "user_id", "OBFUSCATE"), ("actor", "created_by", "NULLIFY"), ("audit", "user_id", "IGNORE")]
    return orphans.report({"actor": actors(spark, sf), "audit": audits(spark, sf)}, refs, base_mapping(spark, sf))


query("orphan_report", _STRAYS + " SELECT * FROM s")(_strays)


@query("orphan_summary", _STRAYS + " SELECT CAST(coalesce(sum(rows_with_value) FILTER (orphan_action <> 'IGNORE'), 0) AS BIGINT) AS actionable_rows, count(DISTINCT table_name || '.' || column_name) FILTER (orphan_action <> 'IGNORE') AS actionable_columns FROM s")
def _(spark, sf):
    return orphans.summary(_strays(spark, sf))


# -- R21: configured columns -------------------------------------------------------------

_U_SQL = {
    "FIRST_NAME": ("first_name", sql_pool("FIRST_NAME", "k")),
    "LAST_NAME": ("last_name", sql_pool("LAST_NAME", "k")),
    "PHONE": ("phone", sql_phone("k")),
    "ADDRESS": ("address", f"substr({sql_pool('ADDRESS', 'k')}, 1, 12)"),
    "EMAIL": ("email", sql_email("k")),
    "HASH": ("email", f"sha256('{SALT}|' || k)"),
    "STATIC": ("address", "'REDACTED'"),
}
_U_WIDTH = {"ADDRESS": 12}


def _configured(kind):
    def run(spark, sf):
        column = _U_SQL[kind][0]
        done = rewrite.rewrite_ids(users(spark, sf).select("user_id", column), ["user_id"], base_mapping(spark, sf))
        part = rewrite.Configured(column, kind, _U_WIDTH.get(kind), "REDACTED" if kind == "STATIC" else None)
        return rewrite.configured(done, [part], rewrite.seed_of(("user_id",)), SALT, POOLS)

    return run


for _kind, (_column, _value) in _U_SQL.items():
    query(f"configured_{_kind.lower()}", f"WITH {U} SELECT k AS user_id, CASE WHEN {_column} IS NOT NULL THEN {_value} END AS {_column} FROM (SELECT *, {sql_id('user_id')} AS k FROM u)")(_configured(_kind))


@query("seed_null_fallback", f"WITH {U}, {A}, {M}, {MO}, d AS ({_REWRITE_A.format(m='mo')}) SELECT actor_id, {sql_pool('FIRST_NAME', 'coalesce(created_by, CAST(actor_id AS VARCHAR))')} AS first_name FROM d")
def _(spark, sf):
    """A null reference falls back to the primary key of its row."""
    done = rewrite.rewrite_ids(actors(spark, sf).select("actor_id", "created_by", "first_name"), ["created_by"], whole_mapping(spark, sf))
    seed = rewrite.seed_column([("created_by", "NAMING_CONVENTION")], ("actor_id",), None)
    return rewrite.configured(done, [rewrite.Configured("first_name", "FIRST_NAME")], rewrite.seed_of(seed), SALT, POOLS).select("actor_id", "first_name")


@query("seed_non_unique", f"SELECT l_orderkey, l_linenumber, {sql_pool('LAST_NAME', 'CAST(l_orderkey AS VARCHAR)')} AS l_returnflag FROM lineitem")
def _(spark, sf):
    l = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return rewrite.configured(l, [rewrite.Configured("l_returnflag", "LAST_NAME")], rewrite.seed_of(("l_orderkey",)), SALT, POOLS)


# -- a model for the metadata operators ---------------------------------------------------

TABLES = [("dap_User", "BASE TABLE"), ("dap_Actor", "BASE TABLE"), ("dap_Note", "BASE TABLE"), ("dap_View", "VIEW"), ("dapDel_Note", "BASE TABLE"), ("dapDeleteMeNot", "BASE TABLE"),
          ("casDel_Other", "BASE TABLE"), ("payDel_Refund", "VIEW"), ("dap_rpt_Summary", "BASE TABLE"), ("dap_mv_Rollup", "BASE TABLE"), ("dap_mv_Live", "BASE TABLE"), ("dapXrptX", "BASE TABLE"),
          ("dap_Memo", "BASE TABLE")]
COLUMNS = [("dap_User", "UserID", "varchar", 255), ("dap_User", "Phone", "varchar", 20), ("dap_User", "Code", "varchar", 64), ("dap_Actor", "ActorID", "bigint", None), ("dap_Actor", "UserID", "varchar", 255),
           ("dap_Actor", "CreatedBy", "varchar", 20), ("dap_Note", "CreatedBy", "bigint", None), ("dap_Note", "ModifiedBy", "varchar", 34), ("dap_Note", "Email", "varchar", 30), ("dap_View", "CreatedBy", "varchar", 255),
           ("dap_Memo", "CreatedBy", "varchar", 20), ("dap_Memo", "UpdatedBy", "varchar", 33), ("dap_Memo", "ModifiedBy", "varchar", 34)]
UNIQUE = [("dap_User", "PRIMARY", "UserID", 1), ("dap_User", "uq_phone", "Phone", 1), ("dap_User", "uq_code", "Code", 1), ("dap_Note", "uq_two", "Email", 2), ("dap_Note", "uq_two", "ModifiedBy", 2)]
FKS = [("FK_Actor_User", "dap_Actor", "UserID", 0, "dap_User", "UserID", "CASCADE", "RESTRICT"), ("FK_Note", "dap_Note", "ModifiedBy", 1, "dap_User", "UserID", "RESTRICT", "SET NULL"),
       ("FK_Note", "dap_Note", "Email", 0, "dap_User", "Phone", "RESTRICT", "SET NULL"), ("FK_Other", "dap_Note", "CreatedBy", 0, "dap_Actor", "ActorID", "RESTRICT", "RESTRICT")]
REGISTRY = [("dap_Actor", "UserID", "FOREIGN_KEY", "FK_old", False, "IGNORE"), ("dap_Actor", "CreatedBy", "NAMING_CONVENTION", None, False, "NULLIFY"), ("dap_Gone", "UserID", "MANUAL", None, True, "OBFUSCATE"),
            ("dap_User", "Code", "MANUAL", None, True, "OBFUSCATE")]
CONFIG = [("dap_User", "Phone", "PHONE", True), ("dap_User", "Code", "STATIC", True), ("dap_User", "NoSuch", "HASH", True), ("dap_Note", "Email", "EMAIL", True), ("dap_Gone", "X", "HASH", False)]
EXCLUDED = [("dap_mv_Live",)]
RUNS = [("r1", "t", "COMPLETED", 1), ("r2", "t", "FAILED", 2), ("r3", "t", "SUPERSEDED", 3), ("r4", "t", "RUNNING", 3), ("r5", "t", "FAILED", 5), ("s1", "other", "RUNNING", 1), ("w1", "third", "COMPLETED", 9), ("x1", "fourth", "RUNNING", 4)]
KEYS = [("t", "FK_Actor_User", False), ("other", "FK_Actor_User", True)]
COUNTS = [("dap_User", "BEFORE", 3), ("dap_User", "AFTER", 3), ("dap_Actor", "BEFORE", 2), ("dap_Actor", "AFTER", 1), ("dap_mv_Live", "BEFORE", 5), ("dap_mv_Live", "AFTER", 9), ("dap_Note", "BEFORE", 1)]

_SCHEMAS = {
    "tables": (TABLES, "table_name string, table_kind string"),
    "columns": (COLUMNS, "table_name string, column_name string, data_type string, width int"),
    "unique_keys": (UNIQUE, "table_name string, index_name string, column_name string, index_columns int"),
    "foreign_keys": (FKS, "constraint_name string, table_name string, column_name string, ordinal int, ref_table string, ref_column string, update_rule string, delete_rule string"),
    "registry": (REGISTRY, discovery.REGISTRY),
    "config": (CONFIG, "table_name string, column_name string, obfuscation_type string, enabled boolean"),
    "exclusions": (EXCLUDED, "table_name string"),
    "runs": (RUNS, "run_id string, target_schema string, status string, started_at int"),
    "fk_state": (KEYS, "target_schema string, constraint_name string, restored boolean"),
    "counts": (COUNTS, "table_name string, phase string, rows_counted bigint"),
}


def meta(spark) -> dict[str, DataFrame]:
    return {k: local_rows(spark, rows, schema) for k, (rows, schema) in _SCHEMAS.items()}


def _values(name: str) -> str:
    """The same rows as a common table expression."""
    rows, schema = _SCHEMAS[name]
    names, kinds = zip(*[c.split() for c in schema.split(", ")], strict=True)
    lit = lambda v: "NULL" if v is None else str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, int) else f"'{v}'"
    sql_kind = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}
    listed = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)
    cast = ", ".join(f"CAST({n} AS {sql_kind[k]}) AS {n}" for n, k in zip(names, kinds, strict=True))
    return f"{name} AS (SELECT {cast} FROM (VALUES {listed}) v({', '.join(names)}))"


def _with(*names: str) -> str:
    return "WITH " + ", ".join(_values(n) for n in names) + " "


_NAMES = "(" + ", ".join(f"'{n}'" for n in EngineConfig().reference_names) + ")"


@query("discover_foreign_keys", _with("foreign_keys") + "SELECT table_name, column_name, min(constraint_name) AS constraint_name FROM foreign_keys WHERE ref_table = 'dap_User' AND ref_column = 'UserID' GROUP BY 1, 2")
def _(spark, sf):
    return discovery.foreign_key_columns(meta(spark)["foreign_keys"], "dap_User", "UserID")


@query("discover_naming", _with("tables", "columns") + f"SELECT table_name, column_name FROM columns JOIN tables USING (table_name) WHERE table_kind = 'BASE TABLE' AND column_name IN {_NAMES}")
def _(spark, sf):
    m = meta(spark)
    return discovery.naming_columns(m["columns"], m["tables"], EngineConfig().reference_names)


_DISCOVERED = _with("tables", "columns", "foreign_keys", "registry") + f""", f AS (
  SELECT table_name, column_name, min(constraint_name) AS fk FROM foreign_keys WHERE ref_table = 'dap_User' AND ref_column = 'UserID' GROUP BY 1, 2),
k AS (
  SELECT table_name, column_name, CASE WHEN fk IS NOT NULL THEN 'FOREIGN_KEY' ELSE discovery_method END AS discovery_method,
         CASE WHEN fk IS NOT NULL THEN fk ELSE constraint_name END AS constraint_name, fk IS NOT NULL OR coalesce(enabled, FALSE) AS enabled, coalesce(orphan_action, 'OBFUSCATE') AS orphan_action
  FROM registry FULL JOIN f USING (table_name, column_name)),
live AS (SELECT table_name, column_name FROM columns JOIN tables USING (table_name) WHERE table_kind = 'BASE TABLE'),
n AS (
  SELECT table_name, column_name, 'NAMING_CONVENTION' AS discovery_method, CAST(NULL AS VARCHAR) AS constraint_name, TRUE AS enabled, 'OBFUSCATE' AS orphan_action
  FROM live WHERE column_name IN {_NAMES} AND NOT EXISTS (SELECT 1 FROM k WHERE k.table_name = live.table_name AND k.column_name = live.column_name)),
z AS (
  SELECT table_name, column_name, discovery_method, constraint_name, enabled AND EXISTS (SELECT 1 FROM live WHERE live.table_name = x.table_name AND live.column_name = x.column_name) AS enabled, orphan_action
  FROM (SELECT * FROM k UNION ALL SELECT * FROM n) x) """


def _discovered(spark):
    m, c = meta(spark), EngineConfig()
    return discovery.discover(m, m["registry"], c.user_table, c.user_key, c.reference_names)


@query("discover_registry", _DISCOVERED + "SELECT * FROM z")
def _(spark, sf):
    return _discovered(spark)


@query("discover_stale", _with("tables", "columns", "registry") + "SELECT table_name, column_name FROM registry r WHERE enabled AND NOT EXISTS (SELECT 1 FROM columns c JOIN tables t USING (table_name) WHERE t.table_kind = 'BASE TABLE' AND c.table_name = r.table_name AND c.column_name = r.column_name)")
def _(spark, sf):
    m = meta(spark)
    return discovery.stale(m["registry"], m).select("table_name", "column_name")


@query("discover_type_check", _DISCOVERED + "SELECT table_name, column_name, data_type, CAST(coalesce(lower(data_type) IN (" + ", ".join(f"'{s}'" for s in STRING_LIKE) + "), FALSE) AS INT) AS type_looks_compatible FROM z LEFT JOIN columns USING (table_name, column_name)")
def _(spark, sf):
    return discovery.type_check(_discovered(spark), meta(spark)["columns"], STRING_LIKE).select("table_name", "column_name", "data_type", "type_looks_compatible")


@query("seed_column_choice", _DISCOVERED + "SELECT table_name, arg_min(column_name, (CASE WHEN discovery_method = 'FOREIGN_KEY' THEN '0' ELSE '1' END) || column_name) AS seed_column FROM z WHERE enabled GROUP BY 1")
def _(spark, sf):
    found: dict[str, list[tuple[str, str]]] = {}
    for r in _discovered(spark).filter("enabled").collect():  # a row a reference column
        found.setdefault(r["table_name"], []).append((r["column_name"], r["discovery_method"]))
    return local_rows(spark, [(t, rewrite.seed_column(refs, (), None)[0]) for t, refs in found.items()], "table_name string, seed_column string")


# -- R11, R13: preflight -------------------------------------------------------------------


@query("config_missing_columns", _with("config", "columns") + "SELECT c.table_name, c.column_name FROM config c LEFT JOIN columns k ON c.table_name = k.table_name AND c.column_name = k.column_name WHERE c.enabled AND k.column_name IS NULL")
def _(spark, sf):
    m = meta(spark)
    return preflight.missing_columns(m["config"], m["columns"])


@query("config_unique_columns", _with("config", "unique_keys") + "SELECT table_name, column_name, obfuscation_type, index_name, index_columns FROM config JOIN unique_keys USING (table_name, column_name) WHERE enabled")
def _(spark, sf):
    m = meta(spark)
    return preflight.unique_columns(m["config"], m["unique_keys"])


@query("config_static_unique_fatal", _with("config", "unique_keys") + f", {U} SELECT table_name, column_name, index_name, (SELECT count(*) FROM (SELECT 1 FROM u LIMIT 2)) >= 2 AS fatal FROM config JOIN unique_keys USING (table_name, column_name) WHERE enabled AND obfuscation_type = 'STATIC' AND index_columns = 1")
def _(spark, sf):
    m = meta(spark)
    two = users(spark, sf).limit(2).count() >= 2
    return preflight.static_unique(m["config"], m["unique_keys"]).select("table_name", "column_name", "index_name", F.lit(two).alias("fatal"))


@query("config_narrow_values", _with("config", "columns") + "SELECT table_name, column_name, obfuscation_type, width, CAST(37 AS INT) AS required_width FROM config JOIN columns USING (table_name, column_name) WHERE enabled AND obfuscation_type = 'EMAIL' AND width < 37")
def _(spark, sf):
    m = meta(spark)
    return preflight.narrow_values(m["config"], m["columns"])


@query("reference_width_check", _DISCOVERED + "SELECT table_name, column_name, width, CAST(34 AS INT) AS required_width FROM z JOIN columns USING (table_name, column_name) WHERE enabled AND width < 34")
def _(spark, sf):
    return preflight.narrow_references(_discovered(spark), meta(spark)["columns"], WIDTH)


# -- R17, R18: foreign keys ------------------------------------------------------------------


@query("fk_backup_definitions", _with("foreign_keys") + "SELECT constraint_name, table_name, ref_table, update_rule, delete_rule, string_agg(column_name, ',' ORDER BY ordinal) AS column_list, string_agg(ref_column, ',' ORDER BY ordinal) AS ref_column_list FROM foreign_keys WHERE ref_table = 'dap_User' GROUP BY ALL")
def _(spark, sf):
    return integrity.definitions(meta(spark)["foreign_keys"], "dap_User")


@query("fk_violations", f"WITH {U}, {A} SELECT actor_id, created_by FROM a WHERE created_by IS NOT NULL AND lower(created_by) NOT IN (SELECT lower(user_id) FROM u)")
def _(spark, sf):
    return integrity.violations(actors(spark, sf), ["created_by"], users(spark, sf), ["user_id"]).select("actor_id", "created_by")


@query("fk_violations_composite", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem p WHERE p.l_linenumber = 1 AND p.l_partkey = l.l_partkey AND p.l_suppkey = l.l_suppkey)")
def _(spark, sf):
    l = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    parents = l.filter("l_linenumber = 1")
    return integrity.violations(l, ["l_partkey", "l_suppkey"], parents, ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_partkey", "l_suppkey")


# -- R22, R23: proof -------------------------------------------------------------------------


@query("row_count_snapshot", f"WITH {U}, {A}, {E} SELECT 'users' AS table_name, count(*) AS rows_counted FROM u UNION ALL SELECT 'actors', count(*) FROM a UNION ALL SELECT 'audits', count(*) FROM e")
def _(spark, sf):
    e = _engine(spark, sf)
    e.snapshot("BEFORE")
    return e.store.read("row_count", "sf").select("table_name", "rows_counted")


@query("row_count_reconcile", _with("counts", "exclusions") + "SELECT b.table_name, b.rows_counted AS before, a.rows_counted AS after, b.table_name IN (SELECT table_name FROM exclusions) AS excluded FROM counts b JOIN counts a ON a.table_name = b.table_name AND a.phase = 'AFTER' WHERE b.phase = 'BEFORE' AND a.rows_counted <> b.rows_counted")
def _(spark, sf):
    m = meta(spark)
    return validation.reconcile(m["counts"], m["exclusions"])


@query("validate_unknown_refs", f"WITH {U}, {A}, {M}, d AS ({_REWRITE_A.format(m='m')}) SELECT actor_id, created_by FROM d WHERE created_by IS NOT NULL AND lower(created_by) NOT IN (SELECT obfuscated_user_id FROM m)")
def _(spark, sf):
    m = base_mapping(spark, sf)
    return validation.unknown_references(rewrite.rewrite_ids(actors(spark, sf).select("actor_id", "created_by"), ["created_by"], m), "created_by", m)


def _injected(spark, sf):
    """Obfuscated users whose every seventeenth row kept its old values."""
    u = users(spark, sf)
    k = C.user_id(F.col("user_id"), SALT, 0, WIDTH - 1)
    keep = F.col("user_no") % 17 == 0
    new = {"first_name": C.pooled("FIRST_NAME", k, POOLS["FIRST_NAME"]), "last_name": C.pooled("LAST_NAME", k, POOLS["LAST_NAME"]), "phone": C.phone(k),
           "address": F.left(C.pooled("ADDRESS", k, POOLS["ADDRESS"]), F.lit(10)), "email": C.email(k, SALT)}
    return u.select("user_no", *[F.when(keep, F.col(c)).otherwise(F.when(F.col(c).isNotNull(), v)).alias(c) for c, v in new.items()])


_INJECTED = f"""WITH {U}, i AS (SELECT user_no, CASE WHEN user_no % 17 = 0 THEN first_name ELSE 'x' END AS first_name, CASE WHEN user_no % 17 = 0 THEN last_name END AS last_name,
  CASE WHEN user_no % 17 = 0 THEN phone END AS phone, CASE WHEN user_no % 17 = 0 THEN address END AS address, CASE WHEN user_no % 17 = 0 THEN email END AS email FROM u) """


def _residual(column, kind):
    def run(spark, sf):
        return _injected(spark, sf).filter(F.col(column).isNotNull() & validation.residual(kind, F.col(column), POOLS)).select("user_no", column)

    return run


_lower_list = lambda kind: "(" + ", ".join(f"'{v.lower()}'" for v in POOLS[kind]) + ")"
for _column, _kind, _where in (
    ("email", "EMAIL", "email NOT LIKE '%@example.invalid'"),
    ("first_name", "FIRST_NAME", f"first_name <> 'x' AND lower(first_name) NOT IN {_lower_list('FIRST_NAME')}"),
    ("last_name", "LAST_NAME", f"lower(last_name) NOT IN {_lower_list('LAST_NAME')}"),
    ("address", "ADDRESS", "NOT (" + " OR ".join(f"starts_with('{v.lower()}', lower(address))" for v in POOLS["ADDRESS"]) + ")"),
    ("phone", "PHONE", "NOT regexp_full_match(phone, '04[0-9]{1,8}')"),
):
    query(f"residual_{_column}", _INJECTED + f"SELECT user_no, {_column} FROM i WHERE {_column} IS NOT NULL AND {_where}")(_residual(_column, _kind))


@query("residual_counts", _INJECTED + "SELECT count(*) FILTER (user_no % 17 = 0) AS email, count(*) FILTER (user_no % 17 = 0) AS first_name, count(*) FILTER (last_name IS NOT NULL) AS last_name FROM i")
def _(spark, sf):
    return validation.residuals(_injected(spark, sf), {"email": "EMAIL", "first_name": "FIRST_NAME", "last_name": "LAST_NAME"}, POOLS)


# -- R9, R10: truncation ----------------------------------------------------------------------

_starts = lambda prefixes: " OR ".join(f"starts_with(table_name, '{p}')" for p in prefixes)


@query("truncate_deletion_match", _with("tables") + f"SELECT table_name FROM tables WHERE table_kind = 'BASE TABLE' AND ({_starts(EngineConfig().deletion_prefixes)})")
def _(spark, sf):
    return truncation.with_prefixes(meta(spark)["tables"], EngineConfig().deletion_prefixes)


@query("truncate_reporting_match", _with("tables", "exclusions") + f"SELECT table_name FROM tables WHERE table_kind = 'BASE TABLE' AND ({_starts(EngineConfig().reporting_prefixes)}) AND table_name NOT IN (SELECT table_name FROM exclusions)")
def _(spark, sf):
    m = meta(spark)
    return truncation.with_prefixes(m["tables"], EngineConfig().reporting_prefixes, m["exclusions"])


@query("truncate_empty_keeps_schema", "SELECT count(*) AS n, 3 AS n_columns FROM region WHERE FALSE")
def _(spark, sf):
    empty = truncation.emptied(audits(spark, sf))
    return empty.agg(F.count(F.lit(1)).alias("n"), F.lit(len(empty.columns)).alias("n_columns"))


# -- R25 to R27: runs ---------------------------------------------------------------------------


_ASSESSED = "CASE WHEN n > 0 THEN '{dangling}' ELSE CASE status {others} ELSE '{none}' END END".format(
    dangling=ASSESSMENTS["dangling"], none=ASSESSMENTS[None], others=" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ASSESSMENTS.items() if k not in ("dangling", None))
)


def _recorded(spark) -> tuple[Store, dict[str, Engine]]:
    """A store that holds the runs and keys above, and the engine of each target."""
    store, begin = Store(spark, f"{shared_dir(spark)}/pseudora-store-{uuid.uuid4().hex}"), datetime(2026, 1, 1)
    store.put("run", [{"run_id": r, "target_schema": t, "status": s, "started_at": begin + timedelta(seconds=k)} for r, t, s, k in RUNS])
    store.put("fk_backup", [{"run_id": "r5", "target_schema": t, "constraint_name": c, "table_name": "dap_Actor", "dropped_date": begin, "restored_date": begin if done else None} for t, c, done in KEYS])
    return store, {t: Engine(spark, store, Target(store, t, {}), SchemaModel({})) for t in sorted({r[1] for r in RUNS})}


@query("status_assessment", _with("runs", "fk_state") + f""", l AS (SELECT target_schema, arg_max(status, started_at * 1000 + ascii(substr(run_id, 2))) AS status FROM runs GROUP BY 1),
f AS (SELECT target_schema, count(*) AS n FROM fk_state WHERE NOT restored GROUP BY 1)
SELECT target_schema, status, coalesce(n, 0) AS dropped, {_ASSESSED} AS assessment FROM l LEFT JOIN f USING (target_schema)""")
def _(spark, sf):
    told = [(t, e.status()) for t, e in _recorded(spark)[1].items()]
    return local_rows(spark, [(t, x["last_status"], len(x["dropped"]), x["assessment"]) for t, x in told], "target_schema string, status string, dropped bigint, assessment string")


@query("prune_keep_newest", _with("runs") + "SELECT run_id, target_schema, status FROM (SELECT *, row_number() OVER (PARTITION BY target_schema ORDER BY started_at DESC, run_id DESC) AS n FROM runs) WHERE n <= 2 OR status = 'RUNNING'")
def _(spark, sf):
    store, engines = _recorded(spark)
    for e in engines.values():
        e.prune(2)
    return store.read("run").select("run_id", "target_schema", "status")


@query("latest_runs", _with("runs") + "SELECT run_id, status FROM runs WHERE target_schema = 't' ORDER BY started_at DESC, run_id DESC LIMIT 5")
def _(spark, sf):
    return local_rows(spark, [(r["run_id"], r["status"]) for r in _recorded(spark)[1]["t"].status()["runs"]], "run_id string, status string")


@query("supersede_running", _with("runs") + "SELECT run_id, target_schema, CASE WHEN target_schema = 't' AND status = 'RUNNING' THEN 'SUPERSEDED' ELSE status END AS status FROM runs")
def _(spark, sf):
    store, engines = _recorded(spark)
    store.put("run", engines["t"].supersede(store.rows("run")))
    return store.read("run").select("run_id", "target_schema", "status")


@query("distinct_pairs", f"WITH {U}, {A} SELECT count(DISTINCT user_id) AS owners, count(DISTINCT (user_id, created_by)) FILTER (created_by IS NOT NULL) AS pairs FROM a")
def _(spark, sf):
    return actors(spark, sf).agg(F.countDistinct("user_id").alias("owners"), F.countDistinct("user_id", "created_by").alias("pairs"))


_HASHES = "('0x' || substr(md5(original_user_id || '=' || obfuscated_user_id), {}, 15))::BIGINT"


def mapping_fingerprint(m: DataFrame) -> DataFrame:
    """One row for a whole mapping: rows, and sums of two hashes of each, which combine before
    the shuffle and do not depend on the order."""
    pair = F.md5(F.concat("original_user_id", F.lit("="), "obfuscated_user_id").cast("binary"))
    total = lambda at: F.coalesce(F.sum(F.conv(F.substring(pair, at, 15), 16, 10).cast("decimal(20,0)")), F.lit(0)).cast("string")
    return m.agg(F.count(F.lit(1)).alias("n"), total(1).alias("low"), total(16).alias("high"))


@query("table_fingerprint", f"WITH {U}, {M} SELECT count(*) AS n, CAST(coalesce(sum({_HASHES.format(1)}), 0) AS VARCHAR) AS low, CAST(coalesce(sum({_HASHES.format(16)}), 0) AS VARCHAR) AS high FROM m")
def _(spark, sf):
    """The fingerprint of the whole mapping."""
    return mapping_fingerprint(base_mapping(spark, sf))


# -- the whole run --------------------------------------------------------------------------------


def _new_u(k: str) -> str:
    parts = [f"CASE WHEN {c} IS NOT NULL THEN {_U_SQL[t][1]} END AS {c}" for c, t in (("first_name", "FIRST_NAME"), ("last_name", "LAST_NAME"), ("phone", "PHONE"), ("email", "EMAIL"))]
    return ", ".join(parts)


@query("end_to_end_users", f"WITH {U} SELECT user_no, k AS user_id, {_new_u('k')}, CASE WHEN address IS NOT NULL THEN {sql_pool('ADDRESS', 'k')} END AS address FROM (SELECT *, {sql_id('user_id')} AS k FROM u)")
def _(spark, sf):
    done = rewrite.rewrite_ids(users(spark, sf), ["user_id"], base_mapping(spark, sf))
    parts = [rewrite.Configured(c, t) for c, t in (("first_name", "FIRST_NAME"), ("last_name", "LAST_NAME"), ("phone", "PHONE"), ("address", "ADDRESS"), ("email", "EMAIL"))]
    return rewrite.configured(done, parts, rewrite.seed_of(("user_id",)), SALT, POOLS)


@query("end_to_end_actors", f"WITH {U}, {A}, {M}, {MO}, d AS ({_REWRITE_A.format(m='mo')}) SELECT actor_id, user_id, created_by, {sql_pool('FIRST_NAME', 'user_id')} AS first_name, {sql_pool('LAST_NAME', 'user_id')} AS last_name FROM d")
def _(spark, sf):
    done = rewrite.rewrite_ids(actors(spark, sf), ["user_id", "created_by"], whole_mapping(spark, sf))
    seed = rewrite.seed_column([("user_id", "FOREIGN_KEY"), ("created_by", "NAMING_CONVENTION")], ("actor_id",), None)
    parts = [rewrite.Configured("first_name", "FIRST_NAME"), rewrite.Configured("last_name", "LAST_NAME")]
    return rewrite.configured(done, parts, rewrite.seed_of(seed), SALT, POOLS)


# -- the engine over a store ----------------------------------------------------------------------


def _engine(spark, sf, key: bool = False, config: bool = True) -> Engine:
    """An engine on a store of its own over users, actors and audit rows.

    key: actors' owners are declared as a foreign key, whose strays are left alone."""
    store = Store(spark, f"{shared_dir(spark)}/pseudora-store-{uuid.uuid4().hex}")
    c = ColumnInfo
    tables = {
        "users": Table("users", [c("user_no", "bigint"), c("user_id", width=WIDTH, nullable=False), *[c(n, width=255) for n in ("first_name", "last_name", "phone", "address", "email")]], ("user_id",)),
        "actors": Table("actors", [c("actor_id", "bigint"), c("user_id", width=WIDTH), c("created_by", width=WIDTH), c("first_name", width=50), c("last_name", width=50)], ("actor_id",)),
        "audits": Table("audits", [c("event_id", "bigint"), c("user_id", width=WIDTH), c("event_type", width=50)], ("event_id",)),
    }
    keys = [ForeignKey("fk_owner", "actors", ("user_id",), "users", ("user_id",))] if key else []
    target = Target(store, "sf", {"users": users(spark, sf), "actors": actors(spark, sf), "audits": audits(spark, sf)})
    e = Engine(spark, store, target, SchemaModel(tables, keys), EngineConfig(user_table="users", user_key="user_id", reference_names=("created_by",)))
    e.register("audits", "user_id", "OBFUSCATE")
    e.register("actors", "user_id", "IGNORE" if key else "OBFUSCATE", "FOREIGN_KEY" if key else "MANUAL")
    kinds = {"users": {"first_name": "FIRST_NAME", "last_name": "LAST_NAME", "phone": "PHONE", "address": "ADDRESS", "email": "EMAIL"}, "actors": {"first_name": "FIRST_NAME", "last_name": "LAST_NAME"}}
    rows = [{"target_schema": "sf", "table_name": t, "column_name": n, "obfuscation_type": k, "enabled": True} for t, cs in kinds.items() for n, k in cs.items()]
    store.put("config", rows if config else [])
    return e


@query("engine_run_users", f"WITH {U} SELECT user_no, k AS user_id, {_new_u('k')}, CASE WHEN address IS NOT NULL THEN {sql_pool('ADDRESS', 'k')} END AS address FROM (SELECT *, {sql_id('user_id')} AS k FROM u)")
def _(spark, sf):
    """The user table after a whole run of the engine."""
    e = _engine(spark, sf)
    e.run(SALT)
    return e.target.table("users")


#: The mapping with the orphans of all references.
_ME = f"""oe AS (SELECT DISTINCT rtrim(lower(v)) AS k FROM (SELECT user_id AS v FROM a UNION ALL SELECT created_by FROM a UNION ALL SELECT user_id FROM e) WHERE v IS NOT NULL),
me AS (SELECT * FROM m UNION ALL SELECT k, {sql_id("k")} FROM oe WHERE k NOT IN (SELECT original_user_id FROM m))"""


@query("engine_run_actors", f"WITH {U}, {A}, {E}, {M}, {_ME}, d AS ({_REWRITE_A.format(m='me')}), s AS (SELECT *, coalesce(created_by, user_id, CAST(actor_id AS VARCHAR)) AS seed FROM d) "
       f"SELECT actor_id, user_id, created_by, {sql_pool('FIRST_NAME', 'coalesce(created_by, CAST(actor_id AS VARCHAR))')} AS first_name, {sql_pool('LAST_NAME', 'coalesce(created_by, CAST(actor_id AS VARCHAR))')} AS last_name FROM s")  # fmt: skip
def _(spark, sf):
    """A table with two references after a whole run of the engine."""
    e = _engine(spark, sf)
    e.run(SALT)
    return e.target.table("actors")


@query("engine_resume", f"""WITH {U}, {A}, {E}, {M}, k AS (SELECT count(*) AS n FROM a WHERE lower(user_id) IN (SELECT original_user_id FROM m)),
v AS (SELECT DISTINCT rtrim(lower(v)) AS k FROM (SELECT created_by AS v FROM a UNION ALL SELECT user_id FROM e) WHERE v IS NOT NULL),
w AS (SELECT (SELECT count(*) FROM m) + (SELECT count(*) FROM v WHERE k NOT IN (SELECT original_user_id FROM m)) AS held)
SELECT CAST(1 AS INT) AS step, 'FAILED' AS status, '23000' AS error_sqlstate, CAST(1 AS BIGINT) AS dropped, '{ASSESSMENTS["dangling"]}' AS assessment, held AS mapped, (SELECT count(*) FROM a) AS actors FROM w
UNION ALL SELECT 2, 'COMPLETED', NULL, 0, '{ASSESSMENTS["COMPLETED"]}', held, n FROM w, k""")
def _(spark, sf):
    """A run that a foreign key stops, what the engine says of it, and the run that finishes its work after the strays are gone."""
    e, told = _engine(spark, sf, key=True, config=False), []

    def tell(step):
        x = e.status()
        told.append((step, x["last_status"], x["runs"][0]["error_sqlstate"], len(x["dropped"]), x["assessment"], x["mapping_rows_with_originals"], e.target.table("actors").count()))

    try:
        e.run(SALT)
    except ObfuscationError:
        tell(1)
    mine = e.target.table("actors").join(e.target.table("users"), "user_id", "left_semi")
    e.target.commit({"actors": e.target.stage("actors", mine, "mended", "strays")}, "mended")
    e.run(SALT)
    tell(2)
    return local_rows(spark, told, "step int, status string, error_sqlstate string, dropped bigint, assessment string, mapped bigint, actors bigint")
