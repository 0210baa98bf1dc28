"""Golden values and properties of the replacement columns."""

import hashlib
import zlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pseudora.functions import columns as C

SALT = "test-salt-001"
GOLDEN = [
    ("john@test.com", "690d09900c83e8c51.13a83702a545e8b2", "Ryan", "Stewart", "0462082513", "8 Coral Avenue", "user_33440b68c0daee1b@example.invalid"),
    ("jane@test.com", "f2a99a023f9054bc6.417b75faa5b50b47", "Emma", "Murphy", "0437156942", "12 Wattle Street", "user_dbaa2983fc691ad0@example.invalid"),
    ("mark@test.com", "2cb10cdeb797b43d3.a585c4b20bc1c5d1", "Hannah", "Taylor", "0423520265", "3 Boronia Place", "user_602ad0f3b209ceff@example.invalid"),
]


def test_golden_values(spark):
    pools = C.default_pools()
    df = spark.createDataFrame([(g[0],) for g in GOLDEN], "o string").withColumn("k", C.user_id(F.col("o"), SALT, 0, 254))
    k = F.col("k")
    got = df.select("o", "k", *[C.pooled(x, k, pools[x]) for x in ("FIRST_NAME", "LAST_NAME")], C.phone(k), C.pooled("ADDRESS", k, pools["ADDRESS"]), C.email(k, SALT)).collect()
    assert [tuple(r) for r in got] == GOLDEN


def test_attempts_and_width(spark):
    df = spark.createDataFrame([("newuser@test.com", "ab")], "o string, s string")
    r = df.select(C.user_id(F.col("o"), SALT, 0, 254), C.user_id(F.col("o"), SALT, 1, 254), C.user_id(F.col("s"), SALT, 0, 8)).first()
    assert tuple(r) == ("1d748760013a6b255.d1299cf84945641c", "77ea2ff1a1d41dfeb.df359ddfae79cc1a", "f3bd9.5764")


def test_quoting():
    assert C.quote_identifier("a`b") == "`a``b`"
    assert C.quote_qualified("s", "t") == "`s`.`t`"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(codec="ascii", min_codepoint=33), max_size=30), min_size=1, max_size=20), st.integers(1, 300))
def test_ids_are_formula_and_fit(spark, originals, width):
    df = spark.createDataFrame([(o,) for o in originals], "o string").select("o", C.user_id(F.col("o"), SALT, 0, width).alias("x"))
    n = C.id_length(width)
    for o, x in df.collect():
        h = hashlib.sha256(f"{SALT}|{o.lower()}|0".encode()).hexdigest()[:n]
        assert x == h[: -(-n // 2)] + "." + h[-(-n // 2) :]
        assert len(x) == n + 1


def test_pool_is_positional(spark):
    df = spark.createDataFrame([(str(i),) for i in range(50)], "k string")
    pool = ["A", "B", "C"]
    for k, v in df.select("k", C.pooled("FIRST_NAME", F.col("k"), pool)).collect():
        assert v == pool[zlib.crc32(hashlib.sha256(f"fname|{k}".encode()).hexdigest().encode()) % 3]
    assert {r[0] for r in df.select(C.pooled("LAST_NAME", F.col("k"), [])).collect()} == {"Surname"}


def test_nulls_stay_null(spark):
    df = spark.createDataFrame([(None,)], "k string")
    k = F.col("k")
    r = df.select(C.user_id(k, SALT), C.pooled("ADDRESS", k, ["x", "y"]), C.phone(k), C.email(k, SALT), C.hashed(k, SALT)).first()
    assert all(v is None for v in r)


def test_sql_functions(spark):
    C.register(spark, SALT)
    r = spark.sql(f"SELECT obfuscated_user_id('john@test.com', 0) a, synthetic_phone('{GOLDEN[0][1]}') b, synthetic_first_name('{GOLDEN[0][1]}') c").first()
    assert tuple(r) == (GOLDEN[0][1], GOLDEN[0][4], GOLDEN[0][2])
    r = spark.sql("SELECT obfuscated_user_id('ab', 0, 8) a, quote_identifier('a`b') b, quote_qualified('s', 't') c").first()
    assert tuple(r) == ("f3bd9.5764", "`a``b`", "`s`.`t`")
    with pytest.raises(Exception):
        spark.sql("SELECT no_such_function('x')").collect()
