"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a target size. The mix takes every document of a source
floor(target / size) times, and once more those whose hash lies below a threshold
that the source's remaining budget sets. The threshold is found without sorting:
sizes are summed by source and hash bucket, the running sum shows in which bucket
the budget ends, and only that bucket is refined, level by level, until it holds one
hash value. Only sums by (source, bucket) are shuffled, after partial aggregation,
so a hot source costs no more than others: a task adds up at most 2^LEVEL_BITS buckets of a
source, whatever the input. Sources are ranked in ranges, as there may be many.

Defined results: null text counts 0 words; texts of any length are counted whole; a null source is a source of its own, last
in order; sources of size 0 have target 0; rows equal in document id and source share
a hash and are taken together; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, scratch, small, written

#: Weights, by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: The mix holds SHARE_NUM / SHARE_DEN of all words.
SHARE_NUM, SHARE_DEN = 3, 2
#: No source is taken more than this many times.
MOST = 2
#: Hashes have 60 bits, of which each level of the histogram resolves so many.
HASH_BITS, LEVEL_BITS = 60, 12
#: Sources that one task ranks, about.
RANGE_ROWS = 50_000


def sizes(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed="mix") -> DataFrame:
    """doc_id, source, size and a 60-bit hash of (seed, id): the narrow table that all passes read."""
    key = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(source_col), F.lit("")))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long").alias("h"),
    )


def ranked(per_source: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """per_source with `rank`, from 0, in order of the source, null last: ranges are ranked
    each by itself, and their counts added up."""
    order = F.col("source").asc_nulls_last()
    parts = -(-max(per_source.count(), 1) // range_rows)
    held = written(per_source.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id()), "mix-ranges")
    counts = held.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a range
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = written(counts.select("part", before.cast("long").alias("before")), "mix-ranges", rows=parts)
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return held.withColumn("rank", inside).join(small(counts), "part").withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")


def targets(per_source: DataFrame, weights=WEIGHTS, num=SHARE_NUM, den=SHARE_DEN, most=MOST) -> DataFrame:
    """source, source_size, target for a table (source, source_size).

    The budget is dealt by weight; sources above `most` times their size stop there and
    their excess is dealt anew among the others, until none is above. The loop brings two
    sums to the driver a round; the per-source table itself stays distributed."""
    weight = F.get(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int")).cast("long")
    per_source = ranked(per_source).withColumn("w", weight).drop("rank").withColumn("full", F.lit(False))
    now = written(per_source, "mix-sources")
    total = int(now.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        left = now.filter("NOT full").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).first()
        used = int(now.filter("full").agg(F.sum("source_size")).first()[0] or 0)
        # a share is w * top / bottom, in whole numbers, so that engines agree to the bit
        top, bottom = num * total - den * most * used, den * int(left["w"] or 1)
        share = F.col("w").cast("decimal(38,0)") * F.lit(top).cast("decimal(20,0)")
        cap = F.lit(most).cast("decimal(20,0)") * F.col("source_size") * F.lit(bottom)
        over = now.filter("NOT full").filter(share > cap)
        if not left["n"] or over.isEmpty():
            break
        now = written(now.withColumn("full", F.col("full") | (share > cap)), "mix-sources")
    # top and the weight stay below 2^53 for any corpus under 10^15 words
    dealt = (F.col("w") * F.lit(top)).cast("double") / F.lit(bottom).cast("double")
    return now.select("source", "source_size", F.when(F.col("full"), (F.lit(most) * F.col("source_size")).cast("double")).otherwise(dealt).alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """source -> cut: documents with h < cut fit the budget `extra` of their source.

    Level by level: histogram the boundary bucket of each source, add its buckets up,
    keep those that fit and go on inside the one where the budget ends. At a single
    hash value, it is taken if that brings the sum nearer the budget."""
    state = written(
        budgets.select("source", "extra", F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("got"), (F.col("extra") <= 0).alias("done")), "mix-state"
    )
    shift = HASH_BITS
    while shift > 0 and not state.filter("NOT done").isEmpty():
        span, shift = shift, max(0, shift - LEVEL_BITS)
        open_ = state.filter("NOT done").select(F.col("source").alias("s"), "extra", "lo", "got")
        inside = sized.join(small(open_), F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", span) == F.shiftright("lo", span)))
        hist = inside.groupBy("s", "extra", "lo", "got", F.shiftright("h", shift).alias("b")).agg(
            F.sum("size").alias("n"), F.min("h").alias("h0"), F.max("h").alias("h1")
        )
        w = Window.partitionBy("s").orderBy("b")
        hist = hist.withColumn("upto", F.col("got") + F.sum("n").over(w))
        # the first bucket that the budget does not cover
        edge = (
            hist.filter(F.col("upto") > F.col("extra"))
            .groupBy("s")
            .agg(F.min(F.struct("b", "n", "h0", "h1", "upto", "extra")).alias("e"))
            .select("s", "e.*", (F.col("e.upto") - F.col("e.n")).alias("before"))
        )
        one = F.col("h0") == F.col("h1")
        nearer = (F.col("upto") - F.col("extra")) < (F.col("extra") - F.col("before"))
        step = edge.select(
            F.col("s"),
            F.when(one, F.when(nearer, F.col("h1") + 1).otherwise(F.col("h0"))).otherwise(F.shiftleft("b", shift)).alias("lo2"),
            F.col("before").cast("long").alias("got2"),
            one.alias("done2"),
        )
        top = F.lit(1 << HASH_BITS).cast("long")
        state = written(
            state.join(step, F.col("source").eqNullSafe(F.col("s")), "left").select(
                "source",
                "extra",
                # no bucket beyond the budget: all that was open fits
                F.when(F.col("done"), F.col("lo")).otherwise(F.coalesce("lo2", F.shiftleft(F.shiftright("lo", span) + 1, span) if span < HASH_BITS else top)).alias("lo"),
                F.coalesce("got2", "got").alias("got"),
                (F.col("done") | F.coalesce("done2", F.lit(True))).alias("done"),
            ),
            "mix-state",
        )
    return state.select("source", F.when(F.col("extra") <= 0, F.lit(0)).otherwise(F.col("lo")).cast("long").alias("cut"))


def mix(docs: DataFrame, weights=WEIGHTS, num=SHARE_NUM, den=SHARE_DEN, most=MOST, seed="mix", **cols) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row per document.

    Threshold joins go by source, whose table is broadcast only after its rows are counted."""
    with scratch() as keep:
        sized = written(sizes(docs, seed=seed, **cols), "mix-sizes")
        per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
        aims = written(targets(per, weights, num, den, most), "mix-targets")
        whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
        plan = aims.withColumn("times", whole).withColumn("extra", F.col("target") - F.col("times") * F.col("source_size"))
        cuts = thresholds(sized, plan.select("source", "extra")).withColumnRenamed("source", "s2")
        plan = written(plan.join(cuts, F.col("source").eqNullSafe(F.col("s2"))).select(F.col("source").alias("s"), "source_size", "target", "times", "cut"), "mix-plan")
        keep(sized, plan)
        copies = (F.col("times") + F.when(F.col("h") < F.col("cut"), 1).otherwise(0)).cast("long")
        return (
            sized.join(small(plan), F.col("source").eqNullSafe(F.col("s")))
            .select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size"))
        )


def op1_mix_sources(spark, sf_dir):
    """Every document with its size, its source's size and target, and the words the mix takes."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         ('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(source, '')), 1, 15))::BIGINT AS h
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
ranked AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS INT) + 1] AS w,
         (SELECT CAST(sum(size) AS BIGINT) FROM d) AS total FROM per),
-- a source is full if, at the level where it just fills, the whole budget is not yet spent
aims AS (
  SELECT a.source, a.source_size, a.w, a.total,
         (SELECT sum(least(b.source_size::HUGEINT * 2 * a.w, b.w::HUGEINT * 2 * a.source_size)) FROM ranked b) * 2 < a.w::HUGEINT * 3 * a.total AS capped
  FROM ranked a),
rest AS (
  SELECT CAST(3 * max(total) - 4 * coalesce(sum(source_size) FILTER (capped), 0) AS BIGINT) AS top, CAST(2 * coalesce(sum(w) FILTER (NOT capped), 0) AS BIGINT) AS bottom FROM aims),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE) ELSE CAST(w * top AS DOUBLE) / CAST(bottom AS DOUBLE) END AS target
  FROM aims, rest),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM t),
x AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.times, p.target - p.times * p.source_size AS extra,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS same
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (times + CASE WHEN extra > 0 AND (upto <= extra OR (upto - same < extra AND upto - extra < extra - (upto - same))) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x
"""
