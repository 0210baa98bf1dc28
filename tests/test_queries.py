"""Every registered query of the engine against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from pseudora.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def listed(df, names):
    return sorted(tuple("~" if v is None or v != v else str(v) for v in r) for r in df[names].itertuples(index=False))


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert listed(got, sorted(got.columns)) == listed(want, sorted(got.columns))


def test_plans_stay_native_and_pruned(spark):
    plan = QUERIES["lineitem_reference_rewrite"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "BroadcastHashJoin" in plan and "l_comment" not in plan


def test_whole_fingerprint_sees_every_row(spark):
    from pyspark.sql import functions as F

    from pseudora.plans.queries import base_mapping, mapping_fingerprint

    m = base_mapping(spark, SF).cache()
    last = m.agg(F.max("original_user_id")).first()[0]
    changed = m.withColumn("obfuscated_user_id", F.when(F.col("original_user_id") == last, "x").otherwise(F.col("obfuscated_user_id")))
    whole = mapping_fingerprint(m).first()
    assert whole["n"] == m.count() and QUERIES["table_fingerprint"](spark, SF).first() == whole
    assert mapping_fingerprint(m.repartition(7)).first() == whole
    assert mapping_fingerprint(changed).first() != whole
    assert mapping_fingerprint(m.filter(F.col("original_user_id") != last)).first() != whole


def test_no_query_compares_nothing_with_nothing(spark, duck):
    for name in ("reference_width_check", "discover_stale", "config_narrow_values", "engine_resume"):
        assert duck.sql(ORACLES[name]).fetchall(), name
