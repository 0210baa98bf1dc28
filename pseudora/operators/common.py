"""Bounded broadcasts and materialised tables for the engine's operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast up to so many bytes by the optimizer's estimate, which counts files
#: as they are compressed; its hash table takes several times that.
BROADCAST_BYTES = 16 << 20


def fits(df: DataFrame) -> bool:
    """Whether the estimated size of df is within the limit."""
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= BROADCAST_BYTES


def sized(df: DataFrame) -> DataFrame:
    """A broadcast hint for a side whose estimated size is within the limit; else the side
    as it is, for a shuffled join whose skewed keys adaptive execution splits."""
    return F.broadcast(df) if fits(df) else df


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, and known by the optimizer to be none."""
    columns = [c.split() for c in schema.split(", ")]
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in columns])


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "timestamp": pa.timestamp("us", "UTC")}


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows that the driver holds, sent as Arrow, which takes no Python worker. Times without a zone are local."""
    made = {}
    for i, (name, kind) in enumerate(c.split() for c in schema.split(", ")):
        values = [r[i] for r in rows]
        made[name] = pa.array([v.astimezone(UTC) if isinstance(v, datetime) else v for v in values], _ARROW[kind])
    return spark.createDataFrame(pa.table(made), schema)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; a folder of our own only in one process."""
    sc = spark.sparkContext
    at = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", "")
    if not at:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='pseudora-')}"
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """df computed once, as a table in the shared folder: its lineage is cut, a lost executor
    loses nothing, and the size of its files tells whether it can be broadcast."""
    path = f"{shared_dir(df.sparkSession)}/pseudora-kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
