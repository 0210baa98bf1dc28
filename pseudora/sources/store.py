"""State of runs and versions of tables, as Parquet under one root.

Files are never changed in place. A table of the store is a series of version folders, for
each target its own where rows belong to targets; a reader takes the newest that is complete,
a writer adds one and drops all but the last. A writer only touches the targets whose rows it
changes, so engines of different targets may run on one store side by side.
Target tables are written to a folder of the run and then entered in the `versions` table,
which is the commit: readers see the old table until then and the new one after."""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession

from ..operators.common import empty, local_rows

SCHEMAS = {
    "config": "config_id bigint, target_schema string, table_name string, column_name string, obfuscation_type string, static_value string, enabled boolean",
    "registry": "target_schema string, table_name string, column_name string, discovery_method string, constraint_name string, enabled boolean, orphan_action string",
    "seed_override": "target_schema string, table_name string, column_name string",
    "exclusion": "target_schema string, table_name string, reason string",
    "mapping": "target_schema string, original_user_id string, obfuscated_user_id string, created_date timestamp",
    "fk_backup": "run_id string, target_schema string, constraint_name string, table_name string, column_list string, ref_table string, ref_column_list string, "
    "update_rule string, delete_rule string, dropped_date timestamp, restored_date timestamp",
    "run_log": "log_id bigint, run_id string, target_schema string, step_name string, step_status string, message string, logged_at timestamp",
    "milestone": "milestone_id bigint, run_id string, target_schema string, milestone_name string, logged_at timestamp",
    "run": "run_id string, target_schema string, status string, salt_fingerprint string, started_at timestamp, finished_at timestamp, error_sqlstate string, error_text string",
    "row_count": "run_id string, target_schema string, table_name string, phase string, rows_counted bigint, captured_at timestamp",
    "first_name": "seed_id int, value string",
    "last_name": "seed_id int, value string",
    "address": "seed_id int, value string",
    "hook_backup": "target_schema string, trigger_name string, table_name string, action_timing string, event_manipulation string, action_order bigint, "
    "definer string, sql_mode string, action_statement string, backed_up_at timestamp",
    "versions": "target_schema string, table_name string, path string, run_id string",
}
#: Tables that grow with the number of users; all others hold metadata and fit the driver.
LARGE = ("mapping",)


def parted(name: str) -> bool:
    """Whether the rows of a table belong to targets."""
    return SCHEMAS[name].startswith("target_schema ") or ", target_schema " in SCHEMAS[name]


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._rows: dict[tuple[str, str | None], list[dict]] = {}

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _place(self, name: str, part: str | None) -> str:
        return f"{self.root}/{name}" if part is None else f"{self.root}/{name}/t-{quote(part, safe='').replace('%', '+')}"

    def _names(self, path: str) -> list[str]:
        fs, at = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def _parts(self, name: str) -> list[str | None]:
        """The targets that a table has rows of; one part without a name where rows belong to none."""
        if not parted(name):
            return [None]
        return sorted(unquote(f[2:].replace("+", "%")) for f in self._names(f"{self.root}/{name}") if f.startswith("t-"))

    def _versions(self, name: str, part: str | None = None) -> list[int]:
        place = self._place(name, part)
        fs, _ = self._fs(place)
        return sorted(int(f[1:]) for f in self._names(place) if f.startswith("v") and fs.exists(self._fs(f"{place}/{f}/_SUCCESS")[1]))

    def read(self, name: str, part: str | None = None) -> DataFrame:
        """The newest complete version, of one target or of all; or an empty table."""
        paths = []
        for p in self._parts(name) if part is None else [part]:
            versions = self._versions(name, p)
            if versions:
                paths.append(f"{self._place(name, p)}/v{versions[-1]}")
        return self.spark.read.schema(SCHEMAS[name]).parquet(*paths) if paths else empty(self.spark, SCHEMAS[name])

    def replace(self, name: str, df: DataFrame, part: str | None = None) -> None:
        """A new version of a table, or of a target's part of it."""
        versions, place = self._versions(name, part), self._place(name, part)
        new = (versions[-1] if versions else 0) + 1
        df.write.mode("overwrite").parquet(f"{place}/v{new}")
        for old in versions[:-1]:
            fs, at = self._fs(f"{place}/v{old}")
            fs.delete(at, True)
        self._rows.pop((name, part), None)

    def rows(self, name: str) -> list[dict]:
        """All rows of a metadata table; read once, then held."""
        if name in LARGE:
            raise ValueError(f"{name} is not for the driver")
        out = []
        for part in dict.fromkeys([*self._parts(name), *(p for n, p in self._rows if n == name)]):
            if (name, part) not in self._rows:
                self._rows[name, part] = [r.asDict() for r in self.read(name, part).collect()]
            out += [dict(r) for r in self._rows[name, part]]
        return out

    def put(self, name: str, rows: list[dict]) -> None:
        """Replaces a metadata table; targets whose rows are as they were stay untouched."""
        names = [f.split()[0] for f in SCHEMAS[name].split(", ")]
        data = [{n: r.get(n) for n in names} for r in rows]
        self.rows(name)
        parts = {p: [] for n, p in self._rows if n == name} if parted(name) else {None: []}
        for r in data:
            parts.setdefault(r["target_schema"] if parted(name) else None, []).append(r)
        for part, new in parts.items():
            if new != self._rows.get((name, part)) or (part is None and not self._versions(name)):
                self.replace(name, local_rows(self.spark, [tuple(r.values()) for r in new], SCHEMAS[name]).coalesce(1), part)
                self._rows[name, part] = new

    def upsert(self, name: str, keys: tuple[str, ...], rows: list[dict]) -> None:
        held = {tuple(r[k] for k in keys): r for r in self.rows(name)}
        for r in rows:
            held[tuple(r[k] for k in keys)] = held.get(tuple(r[k] for k in keys), {}) | r
        self.put(name, list(held.values()))


class Target:
    """A named set of tables: sources given once, later versions from the store."""

    def __init__(self, store: Store, name: str, tables: dict[str, DataFrame], folder: str | None = None):
        self.store, self.name, self.sources = store, name, dict(tables)
        self.folder = (folder or f"{store.root}/targets/{name}").rstrip("/")

    def names(self) -> list[str]:
        return list(self.sources)

    def table(self, name: str) -> DataFrame:
        for v in self.store.rows("versions"):
            if v["target_schema"] == self.name and v["table_name"] == name:
                return self.store.spark.read.parquet(v["path"])
        return self.sources[name]

    def stage(self, name: str, df: DataFrame, run_id: str, part: str) -> str:
        path = f"{self.folder}/{run_id}/{part}/{name}"
        df.write.mode("overwrite").parquet(path)
        return path

    def commit(self, staged: dict[str, str], run_id: str) -> None:
        """All staged tables become current at once."""
        rows = [{"target_schema": self.name, "table_name": t, "path": p, "run_id": run_id} for t, p in staged.items()]
        if rows:
            self.store.upsert("versions", ("target_schema", "table_name"), rows)


def directory(spark: SparkSession, path: str, names: list[str], kind: str = "parquet") -> dict[str, DataFrame]:
    """Tables read from <path>/<name>.<kind>."""
    return {n: spark.read.format(kind).load(f"{path}/{n}.{kind}") for n in names}


def catalog(spark: SparkSession, database: str, names: list[str]) -> dict[str, DataFrame]:
    """Tables of a database of the session catalog."""
    return {n: spark.table(f"`{database}`.`{n}`") for n in names}
