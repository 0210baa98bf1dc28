"""Quality rules with host verdicts, in DataFrame functions only.

Every text is measured once, in its own row. Rule failures are then summed by host
(a partial aggregation: a hot host sends one row a task), failure rates are shrunk with
a beta prior fitted to all hosts by the method of moments, and a host whose shrunk rate
exceeds HOST_LIMIT in any rule is rejected. Verdicts are joined back to the documents;
the per-host table is broadcast only after its rows are counted.

Defined results: null and empty texts have no words and fail; texts of any length are measured
whole, in one row; equal lines and windows count however they tie; a null host is a host of
its own; repeated rows count as often as they stand; with one host or none the prior is
uniform. Only documents of rejected hosts and those that fail the base rules go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, scratch, small, words, written

MIN_WORDS, MAX_REPEAT_PCT = 50, 50
#: A host goes if its shrunk failure rate in a rule is above this.
HOST_LIMIT = 0.6
#: The rules whose rates are held against hosts: per cent limits.
SYMBOLS_PCT, DUP_LINES_PCT = 10, 30
WORD_CHARS = (3, 20)
RULES = ("short", "repeats", "symbols", "dup_lines", "word_length")
SYMBOLS = "[#*$%&|<>]"


def repeat_words(w: Column) -> Column:
    """Words that stand in a 3-word window found twice or more in the array w.

    Most texts repeat no window: their hashes are all distinct and nothing else is done.
    Else windows are sorted by (hash, place); the places of repeated windows, in order,
    each cover 3 words less what the next covers too."""
    windows = F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = lambda p: F.array_sort(
            F.transform(
                F.filter(
                    F.transform(p, lambda x, j: F.struct(x["i"].alias("i"), (F.coalesce(F.get(p, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(p, j + 1)["h"] == x["h"], F.lit(False))).alias("r"))),
                    lambda x: x["r"],
                ),
                lambda x: x["i"],
            )
        )
        total = lambda at: F.aggregate(
            F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3)))), F.lit(0).cast("bigint"), lambda s, x: s + x
        )
        return let(pairs, lambda p: let(again(p), total))

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)))


def measured(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source") -> DataFrame:
    """doc_id, host and the measures of every whole text: one narrow row per document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("text"))
    facts = let(
        words(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    lines = let(
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("bigint"),
    )
    symbols = F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint")
    rows = rows.select("doc_id", "host", facts.alias("f"), symbols.alias("n_symbols"), lines.alias("n_dup_lines"), F.size(F.split("text", "\n")).alias("n_lines"))
    return rows.select("doc_id", "host", "f.n_words", "f.word_chars", "n_symbols", "n_dup_lines", "f.n_repeat_words", "n_lines")


def failures() -> dict[str, Column]:
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * n,
        "symbols": 100 * F.col("n_symbols") > SYMBOLS_PCT * n,
        "dup_lines": 100 * F.col("n_dup_lines") > DUP_LINES_PCT * F.col("n_lines"),
        "word_length": (F.col("word_chars") < WORD_CHARS[0] * n) | (F.col("word_chars") > WORD_CHARS[1] * n),
    }


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host, host_docs, a shrunk rate per rule, host_ok."""
    hosts = written(rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"), *[F.count_if(c).alias(k) for k, c in failures().items()]), "hosts")
    rates = [(F.col(k) / F.col("host_docs")) for k in RULES]
    fit = hosts.agg(*[F.avg(r).alias(f"m_{k}") for k, r in zip(RULES, rates, strict=True)], *[F.var_pop(r).alias(f"v_{k}") for k, r in zip(RULES, rates, strict=True)], F.count(F.lit(1)).alias("n")).first()
    out, ok = [], F.lit(True)
    for k in RULES:
        m, v = fit[f"m_{k}"] or 0.0, fit[f"v_{k}"] or 0.0
        # moments of a beta: a + b = m (1 - m) / v - 1; uniform where they give none
        strength = m * (1 - m) / v - 1 if v > 0 and fit["n"] > 1 else 2.0
        strength = min(max(strength, 1.0), 1e4)
        a = m * strength if v > 0 and fit["n"] > 1 else 1.0
        rate = (F.col(k) + F.lit(a)) / (F.col("host_docs") + F.lit(strength))
        out.append(rate.alias(f"rate_{k}"))
        ok = ok & (rate <= limit)
    return hosts.select("host", "host_docs", *out, ok.alias("host_ok"))


def judged(docs: DataFrame, limit: float = HOST_LIMIT, **cols) -> DataFrame:
    """One row per document: its measures, base_failed, its host's verdict, kept."""
    with scratch() as keep:
        rows = written(measured(docs, **cols), "rules")
        verdicts = written(host_verdicts(rows, limit), "verdicts")
        keep(rows, verdicts)
    verdicts = verdicts.withColumnRenamed("host", "host2")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    got = rows.join(small(verdicts), F.col("host").eqNullSafe(F.col("host2")), "left").drop("host2")
    return got.withColumn("base_failed", base).withColumn("kept", ~base & F.coalesce("host_ok", F.lit(True)))


def op5_quality_rules(spark, sf_dir):
    """Every document with its measures, the base verdict and whether it stays."""
    got = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls, len(string_split(text, chr(10))) AS n_lines FROM d),
g AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
rep AS (
  SELECT r, CAST(sum(least(3, coalesce(nxt - i, 3))) AS BIGINT) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM again) GROUP BY r),
f AS (
  SELECT w.doc_id, w.source, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, n_lines
  FROM w LEFT JOIN rep ON w.r = rep.r),
e AS (
  SELECT *, CAST(n_words < 50 AS INT) AS x1, CAST(100 * n_repeat_words > 50 * n_words AS INT) AS x2, CAST(100 * n_symbols > 10 * n_words AS INT) AS x3,
         CAST(100 * n_dup_lines > 30 * n_lines AS INT) AS x4, CAST(word_chars < 3 * n_words OR word_chars > 20 * n_words AS INT) AS x5 FROM f),
long AS (
  SELECT source, k, CAST(sum(x) AS DOUBLE) AS bad, CAST(count(*) AS DOUBLE) AS n
  FROM (SELECT source, unnest([1, 2, 3, 4, 5]) AS k, unnest([x1, x2, x3, x4, x5]) AS x FROM e) GROUP BY source, k),
fit AS (
  SELECT k, avg(bad / n) AS m, var_pop(bad / n) AS v, count(*) AS hosts FROM long GROUP BY k),
prior AS (
  SELECT k, m, v > 0 AND hosts > 1 AS told, least(greatest(CASE WHEN v > 0 AND hosts > 1 THEN m * (1 - m) / v - 1 ELSE 2.0 END, 1.0), 10000.0) AS s FROM fit),
verdict AS (
  SELECT source, bool_and((bad + CASE WHEN told THEN m * s ELSE 1.0 END) / (n + s) <= 0.6) AS ok FROM long JOIN prior USING (k) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND ok) AS kept
FROM e JOIN verdict ON e.source IS NOT DISTINCT FROM verdict.source
"""
