"""The corpus pipeline: five stages, each applying one operator of pseudora.llm to all
documents that the stage before kept.

quality     documents whose probability of quality 1 is below the threshold go
near_dedup  one document of each group of near copies stays, that with the smallest id
pii         personal data is masked in the texts
mixing      documents go in the number of copies that their source's target gives them;
            those that the mix does not take go
packing     the rest, cut into pieces, with their places in sequences of 2048 tokens

Rows of `documents` may have nulls in any column and columns beyond its own; all are kept
as they are (but for masked texts) up to the last stage. Null and empty texts are scored,
linked and packed like any other; texts of any length go through whole; rows equal in id and
text are one document for near_dedup, and are mixed alike. Empty tables pass through. Tables
that a stage makes are deleted when no later plan reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pseudora.llm import mixing, packing, pii, quality, simhash
from pseudora.llm.common import new_path, scratch, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier does not reject."""
    model = quality.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, model, to="quality__score").filter(F.col("quality__score") >= quality.THRESHOLD).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that five-word shingles show as near copies.

    Of rows equal in id and text one stays; of different texts of a group under the smallest
    id, that with the smallest hash. Groups are apart even where their ids are null or equal."""
    with scratch() as keep_table:
        groups = written(simhash.near_duplicates(docs, **simhash.WIDE), "dedup")
        first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        keep = first.groupBy("root", F.col("component_id").alias("dedup__id")).agg(F.min("key").alias("dedup__key"), F.count(F.lit(1)).alias("n"))
        keep = written(keep, "dedup-keep")
        keep_table(keep)
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = docs.join(
        keep.select("dedup__id", "dedup__key"), docs["doc_id"].eqNullSafe(F.col("dedup__id")) & (key == F.col("dedup__key")), "left_semi"
    )
    if not keep.filter("n > 1").isEmpty():  # ids that stand on several rows
        kept = kept.withColumn("dedup__key", key).dropDuplicates(["doc_id", "dedup__key"])
    return kept.select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts."""
    return pii.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents as the mix takes them."""
    with scratch() as keep:
        mixed = mixing.mix(docs).select(F.col("doc_id").alias("mix__id"), F.col("source").alias("mix__source"), F.col("copies").alias("mix__copies"))
        mixed = written(mixed.distinct(), "mixed")
        keep(mixed)
    same = docs["doc_id"].eqNullSafe(F.col("mix__id")) & docs["source"].eqNullSafe(F.col("mix__source"))
    copies = F.when(F.col("mix__copies") > 0, F.sequence(F.lit(1), F.col("mix__copies").cast("int"))).otherwise(F.array().cast("array<int>"))
    return docs.join(mixed, same).withColumn("mix__copy", F.explode(copies)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all pieces of all documents."""
    return packing.pack(docs, specials=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: A trained network, fingerprint links and a tokenizer have no SQL form; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, "stage-" + "-".join(name.lower().split()))
        with scratch():
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
