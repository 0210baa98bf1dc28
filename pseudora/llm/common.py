"""Helpers shared by the training-data operators: shared storage, materialised
tables, bounded broadcasts and native building blocks."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space, as every operator here splits words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: A table of at most so many rows and bytes may be broadcast; larger ones are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: Rows of a narrow table that one file holds, about, where their number is known before.
FILE_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, set here only where it is unset
    and Spark runs in this one process. A path without a scheme is on the default file system,
    and is told with its scheme, as Python workers know of no default."""
    at = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", "")
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='pseudora-')}"
        spark.sparkContext.setCheckpointDir(at)
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/pseudora-{what}-{uuid.uuid4().hex}"


#: The open scopes of scratch(), innermost last: lists of (session, path).
_scopes: list[list] = []


@contextlib.contextmanager
def scratch():
    """Deletes at its end the tables written inside, but for those handed to the function it
    gives, which the result reads; an outer scope deletes these at its own end."""
    made, left = [], set()
    _scopes.append(made)

    def keep(*tables: DataFrame) -> None:
        left.update(t._pseudora_path for t in tables if hasattr(t, "_pseudora_path"))

    try:
        yield keep
    except BaseException:
        left.clear()
        raise
    finally:
        _scopes.pop()
        for spark, path in made:
            if path not in left:
                remove(spark, path)
            elif _scopes:
                _scopes[-1].append((spark, path))


def held(spark: SparkSession, path: str) -> None:
    """Enter files that a result reads into the open scope, whose caller deletes them."""
    if _scopes:
        _scopes[-1].append((spark, path))


def written(df: DataFrame, what: str, rows: int | None = None) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, survives lost executors.

    rows: an upper bound of its rows, where known, by which the files are counted."""
    spark = df.sparkSession
    path = new_path(spark, what)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    if _scopes:
        _scopes[-1].append((spark, path))
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._pseudora_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete at once a table made by written() that nothing will read again."""
    remove(df.sparkSession, df._pseudora_path)


#: Rows of whole texts or pages that go to a Python worker at once.
TEXT_ROWS = 1000


@contextlib.contextmanager
def text_batches(spark: SparkSession, rows: int = TEXT_ROWS):
    """Within, tables that are written send whole texts to Python in batches of so many rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm = spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _bytes(field: T.StructField) -> Column:
    """About what a value takes in a hash table."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        return F.greatest(F.size(c), F.lit(0)) * (8 + 8 * len(inner.fields) if isinstance(inner, T.StructType) else 16) + 16
    return F.lit(8)


def small(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint if the written table df has at most `limit` rows and `most_bytes`
    bytes; else df, so that the join shuffles and adaptive execution splits its skewed keys."""
    size = sum((_bytes(f) for f in df.schema.fields), F.lit(0)).cast("bigint")
    n, b = df.limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= limit and b <= most_bytes else df


def let(value: Column, body) -> Column:
    """body(value) with value computed once, inside any expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, without the empty strings that split leaves."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def prefix_sums(lens: Column, block: int = 64) -> Column:
    """Exclusive prefix sums of an array of long, in blocks, so that the cost of
    the growing arrays stays linear for texts with very many pieces."""
    zero = F.lit(0).cast("bigint")

    def run(arr: Column, start: Column) -> Column:
        return F.aggregate(
            arr,
            F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out")),
            lambda s, x: F.struct((s["at"] + x).alias("at"), F.array_append(s["out"], s["at"]).alias("out")),
            lambda s: s["out"],
        )

    def blocks(arr: Column) -> Column:
        n = F.greatest(F.ceil(F.size(arr) / F.lit(float(block))).cast("int"), F.lit(1))
        parts = F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.slice(arr, b * block + 1, F.lit(block)))
        return let(
            parts,
            lambda ps: let(
                run(F.transform(ps, lambda p: F.aggregate(p, zero, lambda s, x: s + x)), zero),
                lambda starts: F.flatten(F.zip_with(ps, starts, lambda p, s: run(p, s))),
            ),
        )

    return F.when(F.size(lens) <= block, run(lens, zero)).otherwise(blocks(lens))
