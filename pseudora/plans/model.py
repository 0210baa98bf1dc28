"""What the engine knows about a set of tables: columns with widths, keys, constraints.

Spark's catalog has no information schema and no constraints on files, so the model is
given beside the data, and handed to the metadata operators as small DataFrames."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..operators.common import local_rows

STRING_LIKE = ("varchar", "char", "text", "tinytext", "mediumtext", "longtext", "enum", "set", "string")


class ObfuscationError(Exception):
    """A designed stop: '45000', or '23000' where a foreign key cannot hold."""

    def __init__(self, message: str, sqlstate: str = "45000"):
        super().__init__(message)
        self.sqlstate = sqlstate


@dataclass(frozen=True)
class ColumnInfo:
    name: str
    type: str = "varchar"
    width: int | None = None
    nullable: bool = True


@dataclass(frozen=True)
class ForeignKey:
    name: str
    table: str
    columns: tuple[str, ...]
    ref_table: str
    ref_columns: tuple[str, ...]
    update_rule: str = "RESTRICT"
    delete_rule: str = "RESTRICT"


@dataclass
class Table:
    name: str
    columns: list[ColumnInfo]
    primary_key: tuple[str, ...] = ()
    unique: dict[str, tuple[str, ...]] = field(default_factory=dict)
    kind: str = "BASE TABLE"

    def column(self, name: str) -> ColumnInfo | None:
        return next((c for c in self.columns if c.name == name), None)


@dataclass
class EngineConfig:
    """The names that a target gives its parts; all can be set."""

    user_table: str = "dap_User"
    user_key: str = "UserID"
    # fixed values: names that mark a column as a reference to a user
    reference_names: tuple[str, ...] = (
        "CreatedBy", "CreatedUser", "CreatedUserID", "ModifiedBy", "ModifiedUserID", "UpdatedBy", "RfiCreatedUserID", "ActivityDateUpdateUserID",
    )
    deletion_prefixes: tuple[str, ...] = ("dapDel_", "casDel_", "payDel_")
    reporting_prefixes: tuple[str, ...] = ("dap_rpt_", "dap_mv_")
    attempts: int = 5
    #: Whether references that hold no strings, which are never rewritten, fail the run or are logged as skipped.
    strict_types: bool = False


@dataclass
class SchemaModel:
    tables: dict[str, Table]
    foreign_keys: list[ForeignKey] = field(default_factory=list)

    def width(self, table: str, column: str) -> int | None:
        found = self.tables[table].column(column) if table in self.tables else None
        return found.width if found else None

    def frames(self, spark: SparkSession) -> dict[str, DataFrame]:
        """tables, columns, unique_keys, foreign_keys as DataFrames."""
        tables = [(t.name, t.kind) for t in self.tables.values()]
        columns = [(t.name, c.name, c.type, c.width, c.nullable, i) for t in self.tables.values() for i, c in enumerate(t.columns)]
        unique = []
        for t in self.tables.values():
            keys = dict(t.unique) | ({"PRIMARY": t.primary_key} if t.primary_key else {})
            unique += [(t.name, k, c, i, len(cols)) for k, cols in keys.items() for i, c in enumerate(cols)]
        fks = [
            (f.name, f.table, c, i, f.ref_table, r, f.update_rule, f.delete_rule)
            for f in self.foreign_keys for i, (c, r) in enumerate(zip(f.columns, f.ref_columns, strict=True))
        ]
        make = partial(local_rows, spark)
        return {
            "tables": make(tables, "table_name string, table_kind string"),
            "columns": make(columns, "table_name string, column_name string, data_type string, width int, nullable boolean, ordinal int"),
            "unique_keys": make(unique, "table_name string, index_name string, column_name string, ordinal int, index_columns int"),
            "foreign_keys": make(
                fks, "constraint_name string, table_name string, column_name string, ordinal int, ref_table string, ref_column string, update_rule string, delete_rule string"
            ),
        }

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> SchemaModel:
        raw = json.loads(text)
        tables = {
            k: Table(t["name"], [ColumnInfo(**c) for c in t["columns"]], tuple(t["primary_key"]), {n: tuple(c) for n, c in t["unique"].items()}, t["kind"])
            for k, t in raw["tables"].items()
        }
        return SchemaModel(tables, [ForeignKey(**{k: tuple(v) if isinstance(v, list) else v for k, v in f.items()}) for f in raw["foreign_keys"]])
