"""The run: from configuration and tables to obfuscated, proven tables.

The engine keeps the order of the steps and their records. Work on rows is one plan per
table, in `operators`; metadata is small and decided on the driver. A run is resumable: a
table is committed whole or not at all, ids come from the stored mapping, and every value
is a function of ids and salt, so running again after a failure finishes the work."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import default_pools
from ..operators import discovery, integrity, mapping, orphans, preflight, rewrite, truncation, validation
from ..operators.common import kept
from ..sources.store import Store, Target
from .model import STRING_LIKE, EngineConfig, ObfuscationError, SchemaModel

# Step names and messages that operators of a run look for.
STEPS = {
    "run": "obf_sp_obfuscate_database", "deletion": "obf_sp_truncate_deletion_history", "reporting": "obf_sp_truncate_reporting_snapshots",
    "config": "obf_sp_validate_config", "discover": "obf_sp_discover_user_references", "width": "obf_sp_validate_reference_column_lengths",
    "count": "obf_sp_snapshot_row_counts", "map": "obf_sp_create_user_mapping", "orphan_report": "obf_sp_report_orphan_user_references",
    "orphan_resolve": "obf_sp_resolve_orphan_user_references", "fk_drop": "obf_sp_drop_user_fk_constraints", "references": "obf_sp_obfuscate_user_references",
    "users": "obf_sp_obfuscate_user_table", "fk_restore": "obf_sp_restore_user_fk_constraints", "columns": "obf_sp_obfuscate_configured_columns",
    "validate": "obf_sp_validate_obfuscation", "purge": "obf_sp_purge_sensitive_staging",
}
ASSESSMENTS = {
    "dangling": "HALF-MIGRATED: FK constraints are currently dropped. Re-run obf_sp_obfuscate_database() with the SAME salt to finish.",
    "RUNNING": "A run is in progress, or one died without recording an outcome. Re-run to resume.",
    "FAILED": "Last run FAILED (see ErrorText). Fix the cause and re-run with the same salt; it resumes.",
    "COMPLETED": "Last run COMPLETED cleanly. Safe to open the environment.",
    None: "No obfuscation run has been recorded yet.",
}


def now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def fingerprint(salt: str) -> str:
    return hashlib.sha256(f"salt|{salt}".encode()).hexdigest()


@dataclass
class RunReport:
    run_id: str
    results: dict[str, DataFrame] = field(default_factory=dict)


class Engine:
    """Obfuscates one target; the store may hold many."""

    def __init__(self, spark: SparkSession, store: Store, target: Target, model: SchemaModel, config: EngineConfig | None = None):
        self.spark, self.store, self.target, self.model = spark, store, target, model
        self.config = config or EngineConfig()
        self.run_id = ""
        self._log: list[dict] = []
        self._marks: list[dict] = []
        for name, kind in (("first_name", "FIRST_NAME"), ("last_name", "LAST_NAME"), ("address", "ADDRESS")):
            if not store._versions(name):
                store.put(name, [{"seed_id": i, "value": v} for i, v in enumerate(default_pools()[kind])])

    # -- state ---------------------------------------------------------------------

    def own(self, name: str) -> list[dict]:
        return [r for r in self.store.rows(name) if r["target_schema"] == self.target.name]

    def others(self, name: str) -> list[dict]:
        return [r for r in self.store.rows(name) if r["target_schema"] != self.target.name]

    def pools(self) -> dict[str, list[str]]:
        get = lambda n: [r["value"] for r in sorted(self.store.rows(n), key=lambda r: r["seed_id"])]
        return {"FIRST_NAME": get("first_name"), "LAST_NAME": get("last_name"), "ADDRESS": get("address")}

    def mapping(self) -> DataFrame:
        return self.store.read("mapping", self.target.name)

    def put_mapping(self, rows: DataFrame) -> None:
        """rows: the whole (original, obfuscated) mapping of this target, with the dates that it has."""
        date = F.col("created_date") if "created_date" in rows.columns else F.lit(now())
        mine = rows.select(F.lit(self.target.name).alias("target_schema"), "original_user_id", "obfuscated_user_id", F.coalesce(date, F.lit(now())).alias("created_date"))
        self.store.replace("mapping", mine, self.target.name)

    def add_mapping(self, new: DataFrame) -> None:
        """Enters rows (original, obfuscated) that the mapping lacks."""
        held = self.mapping().select("original_user_id", "obfuscated_user_id", "created_date")
        self.put_mapping(held.unionByName(new.withColumn("created_date", F.lit(now()))))

    def configure(self, table: str, column: str, kind: str, value: str | None = None, enabled: bool = True) -> None:
        row = {"target_schema": self.target.name, "table_name": table, "column_name": column, "obfuscation_type": kind, "static_value": value, "enabled": enabled}
        self.store.upsert("config", ("target_schema", "table_name", "column_name"), [row])

    def register(self, table: str, column: str, action: str = "OBFUSCATE", method: str = "MANUAL", enabled: bool = True) -> None:
        row = {"target_schema": self.target.name, "table_name": table, "column_name": column, "discovery_method": method, "enabled": enabled, "orphan_action": action}
        self.store.upsert("registry", ("target_schema", "table_name", "column_name"), [row])

    def override_seed(self, table: str, column: str) -> None:
        self.store.upsert("seed_override", ("target_schema", "table_name"), [{"target_schema": self.target.name, "table_name": table, "column_name": column}])

    def exclude(self, table: str, reason: str = "") -> None:
        self.store.upsert("exclusion", ("target_schema", "table_name"), [{"target_schema": self.target.name, "table_name": table, "reason": reason}])

    def log(self, step: str, status: str, message: str) -> None:
        self._log.append({"run_id": self.run_id, "target_schema": self.target.name, "step_name": STEPS[step], "step_status": status, "message": message, "logged_at": now()})

    def mark(self, name: str) -> None:
        self._marks.append({"run_id": self.run_id, "target_schema": self.target.name, "milestone_name": name, "logged_at": now()})

    def flush(self) -> None:
        for table, key, new in (("run_log", "log_id", self._log), ("milestone", "milestone_id", self._marks)):
            if new:
                held = self.store.rows(table)
                first = max((r[key] for r in held), default=0) + 1
                self.store.put(table, held + [r | {key: first + i} for i, r in enumerate(new)])
                new.clear()

    def stop(self, step: str, message: str, sqlstate: str = "45000") -> None:
        self.log(step, "ERROR", message)
        raise ObfuscationError(message, sqlstate)

    def frame(self, name: str) -> DataFrame:
        return self.store.read(name).filter(F.col("target_schema") == self.target.name).drop("target_schema")

    def references(self) -> list[dict]:
        rows = [r for r in self.own("registry") if r["enabled"] and r["table_name"] in self.target.sources]
        return sorted(rows, key=lambda r: (r["table_name"], r["column_name"]))

    # -- steps ---------------------------------------------------------------------

    def truncate(self, kind: str) -> dict[str, str]:
        c = self.config
        prefixes, exclusions = (c.deletion_prefixes, None) if kind == "deletion" else (c.reporting_prefixes, self.frame("exclusion"))
        names = [r[0] for r in truncation.with_prefixes(self.model.frames(self.spark)["tables"], prefixes, exclusions).collect()]
        staged = {n: self.target.stage(n, truncation.emptied(self.target.table(n)), self.run_id, kind) for n in sorted(names) if n in self.target.sources}
        self.target.commit(staged, self.run_id)
        for n in staged:
            self.log(kind, "OK", f"Truncated {n}")
        self.log(kind, "OK", f"{len(staged)} table(s) truncated.")
        return staged

    def validate_config(self) -> DataFrame:
        frames, config = self.model.frames(self.spark), self.frame("config")
        gone = preflight.missing_columns(config, frames["columns"]).collect()
        if gone:
            self.stop("config", f"{len(gone)} config row(s) reference columns that do not exist: " + ", ".join(f"{r[0]}.{r[1]}" for r in gone))
        narrow = preflight.narrow_values(config, frames["columns"]).collect()
        if narrow:
            self.stop("config", "columns too narrow for their replacement: " + ", ".join(f"{r[0]}.{r[1]} ({r[3]} < {r[4]})" for r in narrow))
        found, fatal = preflight.unique_columns(config, frames["unique_keys"]), 0
        for r in found.collect():
            at = f"{r['table_name']}.{r['column_name']}"
            if r["obfuscation_type"] == "STATIC" and r["index_columns"] == 1 and self.target.table(r["table_name"]).limit(2).count() >= 2:
                fatal += 1
                self.log("config", "ERROR", f"{at}: STATIC writes one value to every row, but unique index {r['index_name']} forbids duplicates.")
            else:
                self.log("config", "WARN", f"{at} is under unique index {r['index_name']} ({r['obfuscation_type']}); values must stay unique.")
        if fatal:
            raise ObfuscationError("a configured column's type cannot satisfy a UNIQUE constraint")
        self.log("config", "OK", "All configured columns exist; UNIQUE-constraint checks complete.")
        return found

    def discover(self) -> DataFrame:
        c, frames = self.config, self.model.frames(self.spark)
        before = self.frame("registry")
        gone = discovery.stale(before, frames).collect()
        after = discovery.discover(frames, before, c.user_table, c.user_key, c.reference_names)
        rows = [r.asDict() | {"target_schema": self.target.name} for r in after.orderBy("table_name", "column_name").collect()]
        self.store.put("registry", self.others("registry") + rows)
        for r in gone:
            self.log("discover", "WARN", f"{r['table_name']}.{r['column_name']} is no longer a base-table column; disabled.")
        checked = discovery.type_check(self.frame("registry"), frames["columns"], STRING_LIKE)
        odd = checked.filter("enabled AND type_looks_compatible = 0").collect()
        for r in odd:
            self.log("discover", "WARN", f"{r['table_name']}.{r['column_name']} has type {r['data_type']}, which does not look like a user id.")
        self.log("discover", "OK", f"{sum(r['enabled'] for r in rows)} enabled reference column(s).")
        return checked

    def user_width(self) -> int:
        table = self.model.tables.get(self.config.user_table)
        column = table.column(self.config.user_key) if table else None
        if column is None:
            self.stop("width", f"{self.config.user_table}.{self.config.user_key} does not exist")
        return column.width or 255

    def validate_widths(self) -> DataFrame:
        width, frames = self.user_width(), self.model.frames(self.spark)
        narrow = preflight.narrow_references(self.frame("registry"), frames["columns"], width)
        found = [f"{r[0]}.{r[1]}" for r in narrow.collect()]
        if width < preflight.required_width(width):
            found.append(f"{self.config.user_table}.{self.config.user_key}")
        if found:
            self.stop("width", "too narrow for obfuscated ids: " + ", ".join(found))
        self.log("width", "OK", "All reference columns can hold an obfuscated id.")
        return narrow

    def counted_tables(self) -> list[str]:
        names = {self.config.user_table} | {r["table_name"] for r in self.own("config") if r["enabled"]} | {r["table_name"] for r in self.references()}
        return sorted(n for n in names if n in self.target.sources)

    def snapshot(self, phase: str) -> None:
        rows = [
            {"run_id": self.run_id, "target_schema": self.target.name, "table_name": n, "phase": phase, "rows_counted": self.target.table(n).count(), "captured_at": now()}
            for n in self.counted_tables()
        ]
        self.store.upsert("row_count", ("run_id", "table_name", "phase"), rows)

    def create_mapping(self, salt: str) -> None:
        users = self.target.table(self.config.user_table)
        try:
            new = kept(mapping.fresh(users, self.config.user_key, self.mapping(), salt, self.user_width(), self.config.attempts))
        except ObfuscationError as e:
            self.stop("map", str(e), e.sqlstate)
        added = new.count()
        self.add_mapping(new)
        self.log("map", "OK", f"{self.mapping().count()} mapped user(s), {added} of them new.")

    def report_orphans(self) -> DataFrame:
        refs = [(r["table_name"], r["column_name"], r["orphan_action"]) for r in self.references()]
        found = kept(orphans.report({t: self.target.table(t) for t, _, _ in refs}, refs, self.mapping()))
        total = orphans.summary(found).first()
        if total["actionable_rows"]:
            self.log("orphan_report", "WARN", f"{total['actionable_rows']} row(s) across {total['actionable_columns']} column(s) hold a reference with no user match.")
        else:
            self.log("orphan_report", "OK", "No unhandled orphan user-reference values.")
        return found

    def resolve_orphans(self, found: DataFrame, salt: str) -> list[tuple[str, str]]:
        """Extends the mapping for OBFUSCATE; returns the columns to nullify."""
        nulls = []
        for r in self.references():
            at = f"{r['table_name']}.{r['column_name']}"
            if r["orphan_action"] == "IGNORE":
                self.log("orphan_resolve", "SKIP", f"{at}: orphans are left as they are.")
            elif r["orphan_action"] == "NULLIFY":
                nulls.append((r["table_name"], r["column_name"]))
        # columns that hold no strings are never rewritten, so their values need no id
        strings = [f"{r['table_name']}.{r['column_name']}" for r in self.references() if rewrite.is_string(self.target.table(r["table_name"]), r["column_name"])]
        new = found.filter((F.col("orphan_action") == "OBFUSCATE") & F.concat("table_name", F.lit("."), "column_name").isin(strings))
        keys = mapping.unmapped(new, "orphan_value", self.mapping())
        if not keys.isEmpty():
            try:
                more = kept(mapping.extend(keys, self.mapping(), salt, max(self.user_width() - 1, 8), self.config.attempts))
            except ObfuscationError as e:
                self.stop("orphan_resolve", str(e), e.sqlstate)
            self.add_mapping(more)
        self.log("orphan_resolve", "OK", "Orphan references resolved by policy.")
        return nulls

    def drop_foreign_keys(self) -> None:
        rows = self.store.rows("fk_backup")
        open_ = {(r["target_schema"], r["constraint_name"], r["table_name"]) for r in rows if r["restored_date"] is None}
        for r in integrity.definitions(self.model.frames(self.spark)["foreign_keys"], self.config.user_table).collect():
            if (self.target.name, r["constraint_name"], r["table_name"]) not in open_:
                rows.append(r.asDict() | {"run_id": self.run_id, "target_schema": self.target.name, "dropped_date": now(), "restored_date": None})
        self.store.put("fk_backup", rows)
        self.log("fk_drop", "OK", "Foreign keys to the user table are dropped.")

    def plan_table(self, name: str, nulls: list[tuple[str, str]], salt: str, configured: bool) -> DataFrame:
        """One projection: nullified, rewritten and, if asked for, configured columns."""
        raw, ids = self.target.table(name), self.mapping().select("original_user_id", "obfuscated_user_id")
        df = raw
        for t, c in nulls:
            if t == name:
                df = rewrite.nullify(df, c, ids)
        refs = [r for r in self.references() if r["table_name"] == name]
        columns = [r["column_name"] for r in refs if rewrite.is_string(df, r["column_name"])]
        if name == self.config.user_table and self.config.user_key not in columns:
            columns.append(self.config.user_key)
        df = rewrite.rewrite_ids(df, columns, ids, salt, max(self.user_width() - 1, 8), raw)
        wanted = [r for r in self.own("config") if r["enabled"] and r["table_name"] == name]
        if not configured or not wanted:
            return df
        override = next((r["column_name"] for r in self.own("seed_override") if r["table_name"] == name), None)
        seed = rewrite.seed_column([(r["column_name"], r["discovery_method"]) for r in refs], self.model.tables[name].primary_key, override)
        if seed is None:
            self.log("columns", "SKIP", f"{name}: no reference column, primary key or seed override; not obfuscated.")
            return df
        known = [r for r in wanted if r["obfuscation_type"] in validation_types()]
        for r in wanted:
            if r not in known:
                self.log("columns", "SKIP", f"{name}.{r['column_name']}: unknown type {r['obfuscation_type']}.")
        parts = [rewrite.Configured(r["column_name"], r["obfuscation_type"], self.model.width(name, r["column_name"]), r["static_value"]) for r in known]
        return rewrite.configured(df, parts, rewrite.seed_of(seed), salt, self.pools())

    def touched(self) -> list[str]:
        return self.counted_tables()

    def rewrite_tables(self, nulls: list[tuple[str, str]], salt: str) -> None:
        """Stages every touched table in one pass each, and commits them together."""
        staged = {}
        for n in self.touched():
            seen = Observation()
            plan = self.plan_table(n, nulls, salt, True).observe(seen, F.count(F.lit(1)).alias("rows"))
            staged[n] = self.target.stage(n, plan, self.run_id, "rewrite")
            self.log("references", "OK", f"{n}: {seen.get['rows']} row(s) written.")
        self.target.commit(staged, self.run_id)
        for step in ("references", "users", "columns"):
            self.log(step, "OK", f"{len(staged)} table(s) rewritten in one pass each.")

    def restore_foreign_keys(self) -> None:
        """The integrity proof: a key is back only if no row breaks it."""
        rows = self.store.rows("fk_backup")
        for r in rows:
            if r["target_schema"] != self.target.name or r["restored_date"] is not None:
                continue
            if r["table_name"] in self.target.sources and r["ref_table"] in self.target.sources:
                child, parent = self.target.table(r["table_name"]), self.target.table(r["ref_table"])
                bad = integrity.violations(child, r["column_list"].split(","), parent, r["ref_column_list"].split(","))
                if not bad.isEmpty():
                    self.store.put("fk_backup", rows)
                    self.stop("fk_restore", f"cannot restore {r['constraint_name']}: rows of {r['table_name']} have no parent", "23000")
            r["restored_date"] = now()
        self.store.put("fk_backup", rows)
        self.log("fk_restore", "OK", "Foreign keys are restored.")

    def validate(self, run_id: str | None = None) -> dict[str, int]:
        """References, row counts and leftovers; raises if any check fails."""
        alone = run_id is None
        if alone:
            self.run_id = str(uuid.uuid4())
        ids, bad_refs, bad_counts, bad_values = self.mapping(), 0, 0, 0
        for r in self.references():
            if r["orphan_action"] == "IGNORE":
                continue
            if not rewrite.is_string(self.target.table(r["table_name"]), r["column_name"]) and not self.config.strict_types:
                self.log("validate", "SKIP", f"{r['table_name']}.{r['column_name']} holds no strings: not rewritten and not checked.")
                continue
            n = validation.unknown_references(self.target.table(r["table_name"]), r["column_name"], ids).count()
            if n:
                self.log("validate", "ERROR", f"{r['table_name']}.{r['column_name']}: {n} row(s) hold no known obfuscated id.")
            bad_refs += n
        if any(r["run_id"] == self.run_id and r["phase"] == "BEFORE" for r in self.own("row_count")):
            self.snapshot("AFTER")
            mine = self.store.read("row_count").filter((F.col("run_id") == self.run_id) & (F.col("target_schema") == self.target.name))
            for r in validation.reconcile(mine, self.frame("exclusion")).collect():
                text = f"Row count changed: {r['table_name']} before={r['before']} after={r['after']}"
                self.log("validate", "SKIP" if r["excluded"] else "ERROR", text)
                bad_counts += not r["excluded"]
            if not bad_counts:
                self.log("validate", "OK", "Row-count reconciliation passed (no unexpected table gained or lost rows).")
        else:
            self.log("validate", "SKIP", "Row-count reconciliation skipped - no BEFORE snapshot for this run.")
        users, key = self.target.table(self.config.user_table), self.config.user_key
        bad_values += validation.unknown_references(users, key, ids).count()
        pools = self.pools()
        for name in sorted({r["table_name"] for r in self.own("config") if r["enabled"]} & set(self.target.sources)):
            table = self.target.table(name)
            kinds = {r["column_name"]: r["obfuscation_type"] for r in self.own("config") if r["enabled"] and r["table_name"] == name and r["column_name"] in table.columns}
            for column, n in (validation.residuals(table, kinds, pools).first() or {}).asDict().items() if kinds else ():
                if n and column in kinds:
                    self.log("validate", "ERROR", f"{name}.{column}: {n} row(s) hold a value that no {kinds[column]} replacement has.")
                    bad_values += n
        if not bad_values:
            self.log("validate", "OK", "Residual-PII spot checks passed.")
        counts = {"references": bad_refs, "row_counts": bad_counts, "values": bad_values}
        if any(counts.values()):
            self.log("validate", "ERROR", f"Validation failed: {counts}")
            if alone:
                self.flush()
            raise ObfuscationError(f"validation failed: {counts}")
        self.log("validate", "OK", "Validation passed.")
        if alone:
            self.flush()
        return counts

    def purge(self) -> None:
        self.put_mapping(kept(mapping.purge(self.mapping())))
        self.log("purge", "OK", "Original ids are purged from the mapping.")

    # -- the run -------------------------------------------------------------------

    def run(self, salt: str, purge: bool = False, batch_size: int | None = None) -> RunReport:
        """All steps in order. batch_size has no meaning for immutable files and is only recorded."""
        name, self.run_id = self.target.name, str(uuid.uuid4())
        self.mark("Started OBF")
        runs = self.store.rows("run")
        previous = max((r for r in runs if r["target_schema"] == name), key=lambda r: r["started_at"], default=None)
        self.supersede(runs)
        self.store.put("fk_backup", [r for r in self.store.rows("fk_backup") if r["target_schema"] != name or r["restored_date"] is None])
        dangling = len(self.own("fk_backup"))
        resuming = dangling > 0 or (previous is not None and previous["status"] in ("FAILED", "SUPERSEDED"))
        header = {"run_id": self.run_id, "target_schema": name, "status": "RUNNING", "salt_fingerprint": fingerprint(salt), "started_at": now()}
        self.store.put("run", [*runs, header])
        report = RunReport(self.run_id)
        try:
            self.log("run", "START", f"Run started, RunID={self.run_id}" + (f", batch size {batch_size}" if batch_size else ""))
            dropped_by = {r["run_id"] for r in self.own("fk_backup")}
            if any(r["run_id"] in dropped_by and r["salt_fingerprint"] != fingerprint(salt) for r in runs):
                self.stop("run", "an interrupted run used another salt; resume with the same one")
            if resuming:
                self.log("run", "WARN", f"Resuming after an interrupted/failed run (previous status: {previous['status'] if previous else '?'}; FK constraints currently dropped: {dangling}).")
            self.truncate("deletion")
            self.mark(STEPS["deletion"])
            self.truncate("reporting")
            self.mark(STEPS["reporting"])
            report.results["unique_columns"] = self.validate_config()
            self.mark(STEPS["config"])
            report.results["references"] = self.discover()
            self.mark(STEPS["discover"])
            report.results["narrow"] = self.validate_widths()
            self.mark(STEPS["width"])
            self.snapshot("BEFORE")
            self.mark(STEPS["count"])
            self.create_mapping(salt)
            self.mark(STEPS["map"])
            found = report.results["orphans"] = self.report_orphans()
            self.mark(STEPS["orphan_report"])
            nulls = self.resolve_orphans(found, salt)
            self.mark(STEPS["orphan_resolve"])
            self.drop_foreign_keys()
            self.mark(STEPS["fk_drop"])
            self.rewrite_tables(nulls, salt)
            self.mark(STEPS["references"])
            self.mark(STEPS["users"])
            self.restore_foreign_keys()
            self.mark(STEPS["fk_restore"])
            self.mark(STEPS["columns"])
            self.validate(self.run_id)
            self.mark(STEPS["validate"])
            if purge:
                self.purge()
                self.mark(STEPS["purge"])
            self.log("run", "OK", "Run completed.")
            self._finish("COMPLETED")
        except Exception as e:
            state = getattr(e, "sqlstate", None) or "HY000"
            self.log("run", "ERROR", str(e)[:2000])
            self._finish("FAILED", state, str(e)[:2000])
            raise
        return report

    def supersede(self, runs: list[dict]) -> list[dict]:
        """Marks runs of this target that never ended."""
        for r in runs:
            if r["target_schema"] == self.target.name and r["status"] == "RUNNING":
                r |= {"status": "SUPERSEDED", "finished_at": now()}
        return runs

    def _finish(self, status: str, sqlstate: str | None = None, text: str | None = None) -> None:
        rows = self.store.rows("run")
        for r in rows:
            if r["run_id"] == self.run_id:
                r |= {"status": status, "finished_at": now(), "error_sqlstate": sqlstate, "error_text": text}
        self.store.put("run", rows)
        self.mark(f"Run {status}")
        self.flush()

    # -- status and pruning ----------------------------------------------------------

    def status(self) -> dict:
        """The last five runs, dropped keys, and one assessment."""
        runs = sorted(self.own("run"), key=lambda r: (r["started_at"], r["run_id"]), reverse=True)
        dropped = [r for r in self.own("fk_backup") if r["restored_date"] is None]
        last = runs[0]["status"] if runs else None
        held = self.mapping().filter(~F.col("original_user_id").startswith("purged-")).count()
        return {
            "runs": runs[:5],
            "dropped": sorted(dropped, key=lambda r: (r["dropped_date"], r["table_name"], r["constraint_name"])),
            "last_status": last,
            "mapping_rows_with_originals": held,
            "assessment": ASSESSMENTS["dangling"] if dropped else ASSESSMENTS.get(last, ASSESSMENTS[None]),
        }

    def prune(self, keep: int) -> int:
        """Keeps the newest runs and what belongs to them; returns how many remain."""
        if keep is None or keep < 1:
            raise ObfuscationError("keep must be 1 or more")
        runs = sorted(self.own("run"), key=lambda r: (r["started_at"], r["run_id"]), reverse=True)
        left = [r for i, r in enumerate(runs) if i < keep or r["status"] == "RUNNING"]
        self.store.put("run", self.others("run") + left)
        known = {r["run_id"] for r in self.store.rows("run")}
        for name in ("run_log", "row_count", "milestone"):
            self.store.put(name, self.others(name) + [r for r in self.own(name) if r["run_id"] in known])
        self.store.put("fk_backup", self.others("fk_backup") + [r for r in self.own("fk_backup") if r["restored_date"] is None or r["run_id"] in known])
        return len(left)


def validation_types() -> tuple[str, ...]:
    from ..functions.columns import TYPES

    return TYPES
