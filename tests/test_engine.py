"""Whole runs on the two-table fixture: invariants of a run, its state and its failures."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pseudora.functions import columns as C
from pseudora.operators import common, rewrite
from pseudora.plans.engine import ASSESSMENTS, Engine
from pseudora.plans.hooks import Hooks
from pseudora.plans.model import ColumnInfo, ForeignKey, ObfuscationError, SchemaModel, Table
from pseudora.sources.store import Store, Target
from pseudora.streaming.delta import folders, rewrite_stream

SALT = "test-salt-001"
USERS = [
    ("john@test.com", "John", "Smith", "0412345678", "1 Real Street"),
    ("jane@test.com", "Jane", "Smith", "0498765432", "2 Real Street"),
    ("mark@test.com", "Mark", "Smith", "0411112222", "3 Real Street"),
]
ACTORS = [(1, "john@test.com", "john@test.com", "John", "Smith"), (2, "jane@test.com", "john@test.com", "Jane", "Smith")]
U, A = "UserID string, FirstName string, LastName string, PhoneNumber string, Address string", "ActorID bigint, UserID string, CreatedBy string, FirstName string, LastName string"


def model(extra=(), created_by=255, more_user=()):
    c = ColumnInfo
    tables = {
        "dap_User": Table("dap_User", [c("UserID", width=255, nullable=False), c("FirstName", width=50), c("LastName", width=50), c("PhoneNumber", width=20), c("Address", width=255), *more_user], ("UserID",)),
        "dap_Actor": Table("dap_Actor", [c("ActorID", "bigint"), c("UserID", width=255), c("CreatedBy", width=created_by), c("FirstName", width=50), c("LastName", width=50)], ("ActorID",)),
    }
    tables |= {t.name: t for t in extra}
    return SchemaModel(tables, [ForeignKey("FK_Actor_User", "dap_Actor", ("UserID",), "dap_User", ("UserID",))])


def engine(spark, path, users=USERS, actors=ACTORS, m=None, more=None, name="t", store=None, config=True):
    store = store or Store(spark, str(path))
    tables = {"dap_User": spark.createDataFrame(users, U), "dap_Actor": spark.createDataFrame(actors, A)} | (more or {})
    e = Engine(spark, store, Target(store, name, tables), m or model())
    if config:
        rows = [("dap_User", "FirstName", "FIRST_NAME"), ("dap_User", "LastName", "LAST_NAME"), ("dap_User", "PhoneNumber", "PHONE"), ("dap_User", "Address", "ADDRESS"), ("dap_Actor", "FirstName", "FIRST_NAME"), ("dap_Actor", "LastName", "LAST_NAME")]
        store.upsert("config", ("target_schema", "table_name", "column_name"), [{"target_schema": name, "table_name": t, "column_name": c, "obfuscation_type": k, "enabled": True} for t, c, k in rows])
    return e


def rows(df):
    return [tuple(r) for r in df.collect()]


def logged(e, step=None, status=None):
    return [r["message"] for r in e.own("run_log") if (step is None or r["step_name"] == step) and (status is None or r["step_status"] == status)]


def test_run_rerun_status_prune(spark, tmp_path):
    e = engine(spark, tmp_path)
    assert e.status()["assessment"] == ASSESSMENTS[None]
    e.run(SALT)
    users, actors = sorted(rows(e.target.table("dap_User"))), rows(e.target.table("dap_Actor").orderBy("ActorID"))
    ids = {u[0] for u in users}
    assert "690d09900c83e8c51.13a83702a545e8b2" in ids and len({(u[1], u[2]) for u in users}) == 3
    assert actors[0][1] == actors[0][2] == actors[1][2] and {a[1] for a in actors} <= ids
    assert not {u[3] for u in users} & {u[3] for u in USERS}
    assert any(m.startswith("Row-count reconciliation passed") for m in logged(e)) and any(m.startswith("Residual-PII spot checks passed") for m in logged(e))
    assert all(r["restored_date"] is not None for r in e.own("fk_backup"))
    # again: nothing changes, nothing is mapped anew
    e.run(SALT)
    assert sorted(rows(e.target.table("dap_User"))) == users and e.mapping().count() == 3
    assert e.status()["assessment"] == ASSESSMENTS["COMPLETED"] and len(e.status()["runs"]) == 2
    # a broken reference is found afterwards
    bad = e.target.table("dap_Actor").withColumn("UserID", F.when(F.col("ActorID") == 2, "nobody").otherwise(F.col("UserID")))
    path = e.target.stage("dap_Actor", bad, "manual", "x")
    good = {v["table_name"]: v["path"] for v in e.own("versions")}
    e.target.commit({"dap_Actor": path}, "manual")
    with pytest.raises(ObfuscationError):
        e.validate()
    # so is a leftover name
    names = spark.read.parquet(good["dap_Actor"]).withColumn("FirstName", F.lit("Zoltan"))
    e.target.commit({"dap_Actor": e.target.stage("dap_Actor", names, "manual", "y")}, "manual")
    with pytest.raises(ObfuscationError):
        e.validate()
    with pytest.raises(ObfuscationError):
        e.prune(0)
    assert e.prune(1) == 1 and len(e.own("run")) == 1
    assert {r["run_id"] for r in e.own("run_log")} <= {r["run_id"] for r in e.own("run")}


def test_collision_takes_next_attempt_and_orphan_policies(spark, tmp_path):
    actors = [*ACTORS, (3, "jane@test.com", "ghost-user@test.com", "G", "H"), (4, "jane@test.com", "JOHN@TEST.COM", "I", None)]
    e = engine(spark, tmp_path, users=[*USERS, ("newuser@test.com", "N", "U", None, None)], actors=actors)
    taken = spark.createDataFrame([("someone-else", "1d748760013a6b255.d1299cf84945641c")], "original_user_id string, obfuscated_user_id string")
    e.put_mapping(taken)
    e.run(SALT, batch_size=10)
    m = dict(rows(e.mapping().select("original_user_id", "obfuscated_user_id")))
    assert m["newuser@test.com"] == "77ea2ff1a1d41dfeb.df359ddfae79cc1a" and m["someone-else"] == "1d748760013a6b255.d1299cf84945641c"
    assert m["ghost-user@test.com"] == "154917b4771c5f536.d9c0c0c8edbdf7e3"
    got = rows(e.target.table("dap_Actor").orderBy("ActorID"))
    assert got[2][2] == m["ghost-user@test.com"] and got[3][2] == m["john@test.com"] and got[3][4] is None
    new = [u for u in rows(e.target.table("dap_User")) if u[0] == m["newuser@test.com"]][0]
    assert new[3] is None and new[4] is None


@pytest.mark.parametrize("action", ["NULLIFY", "IGNORE"])
def test_orphans_nullify_ignore(spark, tmp_path, action):
    e = engine(spark, tmp_path, actors=[*ACTORS, (3, "jane@test.com", "SYSTEM", "G", "H")])
    e.discover()
    e.register("dap_Actor", "CreatedBy", action, "NAMING_CONVENTION")
    e.run(SALT)
    got = rows(e.target.table("dap_Actor").orderBy("ActorID"))
    assert got[2][2] == (None if action == "NULLIFY" else "SYSTEM") and got[0][2] == "690d09900c83e8c51.13a83702a545e8b2"


def test_bad_config_changes_nothing(spark, tmp_path):
    e = engine(spark, tmp_path)
    e.configure("dap_User", "NoSuchColumn", "HASH")
    with pytest.raises(ObfuscationError) as err:
        e.run(SALT)
    assert err.value.sqlstate == "45000" and e.own("versions") == [] and e.own("run")[0]["status"] == "FAILED"
    assert e.status()["assessment"] == ASSESSMENTS["FAILED"]


def test_unique_static_is_fatal_and_narrow_reference_stops(spark, tmp_path):
    m = model(more_user=(ColumnInfo("ExternalRef", width=64),))
    m.tables["dap_User"].unique = {"uq_phone": ("PhoneNumber",), "uq_ref": ("ExternalRef",)}
    users = spark.createDataFrame([(*u, f"x{i}") for i, u in enumerate(USERS)], U + ", ExternalRef string")
    e = engine(spark, tmp_path / "a", m=m, more={"dap_User": users})
    e.configure("dap_User", "ExternalRef", "STATIC", "same")
    with pytest.raises(ObfuscationError):
        e.run(SALT)
    assert any("uq_phone" in x for x in logged(e, "obf_sp_validate_config", "WARN")) and any("ExternalRef" in x for x in logged(e, "obf_sp_validate_config", "ERROR"))
    e = engine(spark, tmp_path / "b", m=model(created_by=20))
    with pytest.raises(ObfuscationError):
        e.run(SALT)
    assert e.own("fk_backup") == []


def test_numeric_reference_warns_and_null_seed_uses_key(spark, tmp_path):
    widget = Table("dap_Widget", [ColumnInfo("WidgetID", "bigint"), ColumnInfo("CreatedBy", "bigint")], ("WidgetID",))
    contact = Table("dap_Contact", [ColumnInfo("id", "int"), ColumnInfo("CreatedUserID", width=255), ColumnInfo("FirstName", width=50)], ("id",))
    plain = Table("dap_NoPk", [ColumnInfo("id", "int"), ColumnInfo("FirstName", width=50)])
    more = {
        "dap_Widget": spark.createDataFrame([(101, 1), (102, 2)], "WidgetID bigint, CreatedBy bigint"),
        "dap_Contact": spark.createDataFrame([(1, "john@test.com", "A"), (2, None, "B")], "id int, CreatedUserID string, FirstName string"),
        "dap_NoPk": spark.createDataFrame([(1, "A"), (2, "B")], "id int, FirstName string"),
    }
    e = engine(spark, tmp_path, m=model([widget, contact, plain], created_by=34), more=more)
    e.configure("dap_Contact", "FirstName", "FIRST_NAME")
    e.configure("dap_NoPk", "FirstName", "FIRST_NAME")
    with pytest.raises(ObfuscationError):  # no seed: the old names remain, which the proof finds
        e.run(SALT)
    assert any("dap_Widget.CreatedBy" in x for x in logged(e, "obf_sp_discover_user_references", "WARN"))
    assert any("dap_NoPk" in x for x in logged(e, "obf_sp_obfuscate_configured_columns", "SKIP"))
    e.override_seed("dap_NoPk", "id")
    e.run(SALT)
    assert any(x.startswith("Resuming after an interrupted/failed run") for x in logged(e))
    assert rows(e.target.table("dap_NoPk").orderBy("id")) == [(1, "Ella"), (2, "Zoe")]
    got = rows(e.target.table("dap_Contact").orderBy("id"))
    assert got[0][2] == "Ryan" and got[1][2] == "Zoe" and got[1][1] is None
    assert rows(e.target.table("dap_Widget").orderBy("WidgetID")) == [(101, 1), (102, 2)]


def test_failed_key_is_half_migrated_and_resumes(spark, tmp_path):
    e = engine(spark, tmp_path, actors=[*ACTORS, (3, "nobody@test.com", None, "X", "Y")])
    e.discover()
    e.register("dap_Actor", "UserID", "IGNORE", "FOREIGN_KEY")
    with pytest.raises(ObfuscationError) as err:
        e.run(SALT)
    assert err.value.sqlstate == "23000" and e.status()["assessment"].startswith("HALF-MIGRATED")
    with pytest.raises(ObfuscationError):  # another salt cannot finish it
        e.run("other-salt")
    fixed = e.target.table("dap_Actor").filter("ActorID <> 3")
    e.target.commit({"dap_Actor": e.target.stage("dap_Actor", fixed, "fix", "x")}, "fix")
    e.run(SALT)
    assert e.status()["assessment"] == ASSESSMENTS["COMPLETED"]


def test_case_duplicates_are_fatal(spark, tmp_path):
    e = engine(spark, tmp_path, users=[*USERS, ("John@dup.com", "a", "b", None, None), ("john@dup.com", "c", "d", None, None)])
    with pytest.raises(ObfuscationError):
        e.run(SALT)
    assert e.mapping().count() == 0


def test_targets_are_apart_truncation_and_purge(spark, tmp_path):
    names = ("dapDel_Something", "casDel_Other", "dapDeleteMeNot", "dap_rpt_Summary", "dap_mv_Live")
    extra = [Table(n, [ColumnInfo("id", "int")]) for n in names]
    more = {n: spark.createDataFrame([(1,), (2,)], "id int") for n in names}
    e = engine(spark, tmp_path, m=model(extra), more=more)
    e.exclude("dap_mv_Live", "kept live")
    e.run(SALT, purge=True)
    assert {n: e.target.table(n).count() for n in names} == {"dapDel_Something": 0, "casDel_Other": 0, "dapDeleteMeNot": 2, "dap_rpt_Summary": 0, "dap_mv_Live": 2}
    assert all(o.startswith("purged-") for (o,) in rows(e.mapping().select("original_user_id"))) and e.status()["mapping_rows_with_originals"] == 0
    two = engine(spark, tmp_path, name="t2", store=e.store)
    two.run("salt-two")
    one_ids, two_ids = ({r[0] for r in rows(x.mapping().select("obfuscated_user_id"))} for x in (e, two))
    assert len(one_ids) == len(two_ids) == 3 and not one_ids & two_ids


def test_hooks(spark, tmp_path):
    live = {"t": [{"trigger_name": n, "table_name": "x", "action_timing": "AFTER", "event_manipulation": "UPDATE", "action_order": i, "definer": "me@host", "sql_mode": "", "action_statement": "..."} for i, n in enumerate("ba")]}
    h = Hooks(Store(spark, str(tmp_path)), live)
    assert h.drop("t") == (2, 2) and h.live["t"] == []
    with pytest.raises(ObfuscationError):
        h.backup("t")
    h.live["t"] = [{"trigger_name": "new"}]
    with pytest.raises(ObfuscationError):
        h.drop("t")
    h.live["t"] = []
    assert h.restore("t") == 2 and [x["trigger_name"] for x in h.live["t"]] == ["b", "a"] and h.restore("t") == 0


def test_model_round_trip_and_stream(spark, tmp_path):
    assert SchemaModel.from_json(model().to_json()) == model()
    src = tmp_path / "in"
    for i, ids in enumerate((["a", "b"], ["B", "c"])):
        spark.createDataFrame([(x,) for x in ids], "user_id string").coalesce(1).write.parquet(str(src / f"p{i}"))
    stream = spark.readStream.schema("user_id string").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(str(src))
    rewrite_stream(stream, ["user_id"], str(tmp_path / "map"), str(tmp_path / "out"), str(tmp_path / "cp"), SALT).awaitTermination()
    out = {r[0] for r in spark.read.parquet(str(tmp_path / "out")).select("user_id").collect()}
    want = {r[0] for r in spark.createDataFrame([(x,) for x in "abc"], "o string").select(C.user_id(F.col("o"), SALT, 0, 254)).collect()}
    assert out == want


def test_two_engines_on_one_store_keep_each_others_rows(spark, tmp_path):
    """Each has a Store of its own on the same root, and has read it before the other writes."""
    one, two = engine(spark, tmp_path, name="one/a"), engine(spark, tmp_path, name="two")
    assert [len(e.own("run")) for e in (one, two)] == [0, 0]
    one.run(SALT)
    two.run("salt-two")
    one.prune(1)
    fresh = Store(spark, str(tmp_path))
    assert sorted(r["target_schema"] for r in fresh.rows("run")) == ["one/a", "two"] and fresh.read("mapping").count() == 6
    assert len({r["target_schema"] for r in fresh.rows("run_log")}) == 2 and len(fresh.rows("config")) == 12
    dates = {r[0] for r in one.mapping().select("created_date").collect()}
    one.purge()
    assert {r[0] for r in one.mapping().select("created_date").collect()} == dates


def test_numeric_references_are_skipped_or_stop(spark, tmp_path):
    widget = Table("dap_Widget", [ColumnInfo("WidgetID", "bigint"), ColumnInfo("CreatedBy", "bigint")], ("WidgetID",))
    more = {"dap_Widget": spark.createDataFrame([(101, 1)], "WidgetID bigint, CreatedBy bigint")}
    e = engine(spark, tmp_path / "a", m=model([widget]), more=more)
    e.run(SALT)
    assert any("dap_Widget.CreatedBy holds no strings" in x for x in logged(e, "obf_sp_validate_obfuscation", "SKIP")) and e.mapping().count() == 3
    assert any(x == "dap_User: 3 row(s) written." for x in logged(e, "obf_sp_obfuscate_user_references", "OK"))
    e = engine(spark, tmp_path / "b", m=model([widget]), more=more)
    e.config.strict_types = True
    with pytest.raises(ObfuscationError):
        e.run(SALT)


def test_stream_reads_the_mapping_of_a_run(spark, tmp_path):
    e = engine(spark, tmp_path / "s")
    e.run(SALT)
    src = str(tmp_path / "in")
    spark.createDataFrame([("JOHN@test.com",), ("new",)], "user_id string").coalesce(1).write.parquet(src)
    rewrite_stream(spark.readStream.schema("user_id string").parquet(src), ["user_id"], str(tmp_path / "map"), str(tmp_path / "out"), str(tmp_path / "cp"), SALT, known=e.mapping).awaitTermination()
    assert "690d09900c83e8c51.13a83702a545e8b2" in {r[0] for r in spark.read.parquet(str(tmp_path / "out")).select("user_id").collect()}
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "map" / "0")).select("original_user_id").collect()] == ["new"]


def _wide(spark):
    """Ids of every kind: mapped, with another id, in capitals, with blanks, already new, strays, nulls, and one on most rows."""
    first = lambda k: spark.range(1).select(C.user_id(F.lit(k), SALT, 0, 33)).first()[0]
    mapping = spark.createDataFrame([("a", first("a")), ("b", "taken.before"), ("c", first("c")), ("d d", first("d d"))], "original_user_id string, obfuscated_user_id string")
    ids = ["a", "A", "a  ", "b", "B ", "c", first("c"), "taken.before", "TAKEN.before ", "stray", "Stray", "", " ", None, "d d", *["a"] * 60]
    table = spark.createDataFrame([(i, v, ids[-i - 1], f"x{i}") for i, v in enumerate(ids)], "n int, `user.id` string, by string, key string")
    return table, common.kept(mapping)


def test_ids_computed_in_their_rows_are_those_of_the_join(spark, monkeypatch):
    table, mapping = _wide(spark)
    columns = ["user.id", "by"]
    joined = sorted(rewrite.rewrite_ids(table, columns, mapping).collect())
    assert joined[3]["user.id"] == "taken.before" and joined[9]["user.id"] == "stray" and joined[13]["user.id"] is None
    assert common.fits(mapping)
    nulled = rewrite.nullify(table, "user.id", mapping).collect()
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    for salt in (SALT, "another"):
        out = rewrite.rewrite_ids(table, columns, mapping, salt, 33)
        assert out.schema == table.schema and sorted(out.collect()) == sorted(joined)
    assert sorted(rewrite.nullify(table, "user.id", mapping).collect(), key=str) == sorted(nulled, key=str)
    assert rewrite.rewrite_ids(table.limit(0), columns, mapping, SALT, 33).count() == 0


def test_only_exceptions_are_joined(spark, monkeypatch):
    table, mapping = _wide(spark)
    found = {r["key"]: r["becomes"] for r in rewrite.exceptions(table, "user.id", mapping, SALT, 33).collect()}
    assert found.pop("b") == "taken.before" and set(found.values()) == {None} and set(found) >= {"stray", "", "taken.before"} and not {"a", "c", "d d"} & set(found)


def test_a_run_beyond_the_broadcast_limit_gives_the_same_tables(spark, tmp_path, monkeypatch):
    strays = [*ACTORS, (3, "ghost@test.com", "JANE@test.com ", "G", "H"), (4, None, "mark@test.com", None, "Smith")]
    told = []
    for limit in (common.BROADCAST_BYTES, -1):
        monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
        e = engine(spark, tmp_path / str(limit), actors=strays)
        e.discover()
        e.register("dap_Actor", "UserID", "NULLIFY", "FOREIGN_KEY")
        e.run(SALT)
        told.append([sorted(e.target.table(t).collect(), key=str) for t in ("dap_User", "dap_Actor")])
    assert told[0] == told[1] and told[0][1][2]["UserID"] is None


def test_a_batch_of_a_stream_reads_few_folders():
    assert folders("m", 0) == [] and folders("m", 1) == ["m/0"] and folders("m", 11) == ["m/10"]
    assert folders("m", 10) == [f"m/{i}" for i in range(10)] and folders("m", 20)[0] == "m/10"


def test_a_stream_keeps_its_ids_past_a_whole_folder(spark, tmp_path):
    src = tmp_path / "in"
    for i in range(13):
        spark.createDataFrame([("early@x",), (f"u{i}@x",)], "user_id string").coalesce(1).write.parquet(str(src / f"{i:02d}"))
    stream = spark.readStream.schema("user_id string").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(str(src))
    rewrite_stream(stream, ["user_id"], str(tmp_path / "map"), str(tmp_path / "out"), str(tmp_path / "cp"), SALT).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 26 and out.select("user_id").distinct().count() == 14
    read = spark.read.parquet(*folders(str(tmp_path / "map"), 13))
    assert read.count() == 14 and read.select("original_user_id").distinct().count() == 14


def test_rows_of_the_driver_come_back_as_they_are(spark, tmp_path):
    schema = "a string, b bigint, c int, d boolean, e timestamp"
    rows = [("x", 2**40, 1, True, datetime(2026, 7, 1, 12, 30, 0, 5)), (None, None, None, None, None), ("é\n", -1, 0, False, datetime(1999, 1, 1))]
    for given in (rows, rows[1:2], []):
        made, plain = common.local_rows(spark, given, schema), spark.createDataFrame(given, schema)
        assert made.schema == plain.schema and made.collect() == plain.collect()
        made.write.parquet(str(tmp_path / str(len(given))))
        assert sorted(spark.read.schema(schema).parquet(str(tmp_path / str(len(given)))).collect(), key=str) == sorted(plain.collect(), key=str)
    zoned = datetime(2026, 7, 1, tzinfo=timezone(timedelta(hours=5)))
    assert common.local_rows(spark, [(zoned,)], "e timestamp").collect() == spark.createDataFrame([(zoned,)], "e timestamp").collect()
