"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

The terms of a text are its words, weighted by their counts. For each of SAMPLES samples a
term draws r and c from Gamma(2, 1) and b from the uniform distribution, all from hashes of
(term, sample); with t = floor(ln w / r + b) its sample value is
ln c - r (t - b + 1), and the sample keeps the term of the smallest value (Ioffe, "Improved
Consistent Sampling, Weighted Minhash and L1 Sketching"). Two texts agree in a sample with
the probability of their generalised Jaccard similarity, sum of minima over sum of maxima
of the weights. The smallest value itself, which only equal (term, t) share, is hashed to
16 bits, so a fingerprint is SAMPLES groups of four hex digits.

Shape of the job: texts are shuffled once, to ranges of ids. Within a range a text meets
its neighbour and neighbours' fingerprints are compared without another shuffle of texts,
since every later grouping contains the range. Words are counted in the text's own row, by
sorting their hashes; terms as heavy in a text and its edited form are drawn once for both.
Samples are drawn GROUP to a row: that keeps the generated code small enough to be compiled.

Logarithms are taken only where they can matter. The exponential of a sample value is itself
exponentially distributed with the term's weight as its rate, so the least of a text of W
words has rate W, and is above LEAST / W with a probability of exp(-LEAST), 4e-18. A bound
from below that takes no logarithm (-ln q >= 2 (1 - q) / (1 + q), and p^x >= p / (x + p (1 - x))
by the means, where r = -ln p and c = -ln q) tells terms that lie above; all others are drawn
in full, so the least value, and with it the fingerprint, is that of all terms.

Defined results: null and empty texts have no words and the fingerprint of zeros, and are
alike with each other (1) and unlike all else (0); texts of any length are read whole; rows
equal in id are ordered by a hash of their text, and go to as many ranges as their number asks
for, like rows without an id, which come last in descending order; rows equal in id and text
are interchangeable and stay in one range; a single row is its own next; further columns are
not read."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, let

SAMPLES, GROUP = 64, 8
#: Values above LEAST over the number of words cannot be a text's least.
LEAST = 40.0
#: A term stands for itself as TERM_BITS of its hash above its weight.
TERM_BITS, WEIGHT_BITS = 40, 24
BITS = 16
PER_LONG = 4  # samples of 16 bits that a long holds
EMPTY = "0" * (SAMPLES * BITS // 4)


def uniforms(h: Column) -> Column:
    """The product of two uniforms in (0, 1) from the upper 48 bits of a hash."""
    one = F.shiftrightunsigned(h, 40) + F.lit(0.5)
    two = F.shiftrightunsigned(h, 16).bitwiseAND(F.lit(0xFFFFFF)) + F.lit(0.5)
    return one * two * F.lit(2.0**-48)


def low(h: Column) -> Column:
    """A uniform in (0, 1) from the other 16 bits."""
    return (h.bitwiseAND(F.lit(0xFFFF)) + F.lit(0.5)) * F.lit(2.0**-16)


def can_be_least(p: Column, q: Column, b: Column, weight: Column, limit: Column) -> Column:
    """Whether a term's value in a sample, where r = -ln p and c = -ln q, may lie below ln(limit)."""
    above = F.when(weight == 1, F.lit(1.0) - b + b * p).otherwise(weight)
    return F.lit(2.0) * (F.lit(1.0) - q) * p <= limit * (F.lit(1.0) + q) * above


def sample_value(p: Column, q: Column, b: Column, weight: Column) -> Column:
    t = F.when(weight == 1, F.lit(0.0)).otherwise(F.floor(F.ln(weight) / -F.ln(p) + b).cast("double"))
    return F.ln(-F.ln(q)) + F.ln(p) * (t - b + F.lit(1.0))


def signatures(terms: DataFrame, keys: list[str]) -> DataFrame:
    """keys, s0_0.. (longs of four samples of the text) and s1_0.. (of its edited form): for rows
    keys, term, in (1 the text, 2 its edited form, 3 both, by weight) and limit (see LEAST).
    No shuffle where the rows are already clustered by some of the keys."""
    rows = terms.select(*keys, "in", "limit", F.col("term").bitwiseAND(F.lit((1 << WEIGHT_BITS) - 1)).cast("double").alias("w"), F.shiftright("term", WEIGHT_BITS).alias("term"),
                        F.explode(F.sequence(F.lit(0), F.lit(SAMPLES // GROUP - 1))).alias("part"))
    held, each = [*keys, "in", "w", "part", "x"], range(GROUP)
    rows = rows.select(*keys, "in", "limit", "w", "part", F.xxhash64("term", "part").alias("x"))
    hashed = lambda k: F.xxhash64(F.col("x").bitwiseXOR(k))
    # in steps, so that no expression stands twice in the generated code
    rows = rows.select(*held, "limit", *[hashed(F.lit(2 * i)).alias(f"h{i}") for i in each], *[uniforms(hashed(F.lit(2 * i + 1))).alias(f"q{i}") for i in each])
    rows = rows.select(*held, "limit", *[f"q{i}" for i in each], *[uniforms(F.col(f"h{i}")).alias(f"p{i}") for i in each], *[low(F.col(f"h{i}")).alias(f"b{i}") for i in each])
    bit = lambda i: F.when(can_be_least(F.col(f"p{i}"), F.col(f"q{i}"), F.col(f"b{i}"), F.col("w"), F.col("limit")), 1 << i).otherwise(0)
    bits_of = F.array(*[F.array(*[F.lit(i) for i in each if m >> i & 1]).cast("array<int>") for m in range(1 << GROUP)])
    rows = rows.select(*held, F.explode(F.get(bits_of, sum((bit(i) for i in each), F.lit(0)))).alias("i"))
    # only what may be the least is drawn
    rows = rows.select(*keys, "in", "w", (F.col("part") * GROUP + F.col("i")).alias("sample"), hashed(F.col("i") * 2).alias("h"), uniforms(hashed(F.col("i") * 2 + 1)).alias("q"))
    rows = rows.select(*keys, "in", "w", "sample", "q", uniforms(F.col("h")).alias("p"), low(F.col("h")).alias("b"))
    drawn = rows.select(*keys, "in", "sample", sample_value(F.col("p"), F.col("q"), F.col("b"), F.col("w")).alias("v"))
    member = lambda kind: F.col("in").bitwiseAND(F.lit(1 << kind)) != 0
    least = drawn.groupBy(*keys, "sample").agg(*[F.min(F.when(member(kind), F.col("v"))).alias(f"v{kind}") for kind in (0, 1)])
    place = (F.lit(PER_LONG - 1) - F.pmod("sample", F.lit(PER_LONG))) * BITS
    short = lambda v: F.call_function("shiftleft", F.xxhash64(v).bitwiseAND(F.lit((1 << BITS) - 1)), place)
    longs = least.groupBy(*keys, F.floor(F.col("sample") / PER_LONG).cast("int").alias("l")).agg(
        *[F.bit_or(F.when(F.col(f"v{kind}").isNotNull(), short(f"v{kind}"))).alias(f"l{kind}") for kind in (0, 1)]
    )
    wide = [F.max(F.when(F.col("l") == k, F.col(f"l{kind}"))).alias(f"s{kind}_{k}") for kind in (0, 1) for k in range(SAMPLES // PER_LONG)]
    return longs.groupBy(*keys).agg(*wide)


def text_of(longs: Column) -> Column:
    """A fingerprint: the longs in hex; zeros for a text without words."""
    return F.coalesce(F.lower(F.array_join(F.transform(longs, lambda x: F.lpad(F.hex(x), F.lit(16), F.lit("0"))), "")), F.lit(EMPTY))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples of two fingerprints given as arrays of longs, null if empty."""

    def same(x: Column) -> Column:
        return sum((F.when(F.shiftrightunsigned(x, BITS * i).bitwiseAND(F.lit((1 << BITS) - 1)) == 0, 1).otherwise(0) for i in range(PER_LONG)), F.lit(0))

    share = F.aggregate(F.zip_with(a, b, lambda x, y: same(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x) / F.lit(float(SAMPLES))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(share)


def ranges(docs: DataFrame, n: int, id_col: str) -> tuple[list[int], dict[int | None, int]]:
    """Cuts of the ids into up to about n ranges of like counts, and the ids (and null) that
    hold more rows than a range, each a range of its own, with the parts that these rows need."""
    cuts, rows, known = docs.agg(
        F.percentile_approx(F.col(id_col).cast("bigint"), F.array(*[F.lit(i / n) for i in range(1, n)]), 20 * n), F.count(F.lit(1)), F.count(id_col)
    ).first()
    found = Counter(cuts or [])
    hot = {x: k + 1 for x, k in found.items() if k > 1}
    parts: dict[int | None, int] = dict(hot)
    if rows > known:
        parts[None] = max(1, round(n * (rows - known) / rows))
    least = -(1 << 63)
    return sorted({*found, *(x - 1 for x in hot if x > least)}), parts


def _longs(values: list[int]) -> Column:
    """An array of longs as one literal, whatever its size."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def bucket_of(value: Column, tie: Column, cuts: list[int], parts: dict[int | None, int]) -> Column:
    """The range of a row, ascending as ids descend: how many cuts lie at or above its id, counted in
    two steps of about the root of their number; within a range of one id, the part of its tie."""
    at = F.lit(0)
    if cuts:
        step, down = math.isqrt(len(cuts)) + 1, cuts[::-1]
        coarse = F.size(F.filter(_longs(down[step - 1 :: step]), lambda c: c >= value))
        fine = F.size(F.filter(F.slice(_longs(down), coarse * step + 1, F.lit(step)), lambda c: c >= value))
        at = coarse * step + fine
    at = F.when(value.isNull(), F.lit(len(cuts) + 1)).otherwise(at)
    most = max(parts.values(), default=1)
    if most == 1:
        return at.cast("bigint")
    ids = sorted(x for x in parts if x is not None)
    own = F.lit(1)
    if ids:
        place = F.array_position(_longs(ids), value)
        own = F.when(place > 0, F.get(_longs([parts[x] for x in ids]), place.cast("int") - 1)).otherwise(own)
    own = F.when(value.isNull(), F.lit(parts.get(None, 1))).otherwise(own)
    # ties ascend within an id, and so do their parts
    high = F.shiftright(tie, 44) + F.lit(1 << 19)
    return (at.cast("bigint") * F.lit(most) + F.floor(high * own / F.lit(float(1 << 20)))).cast("bigint")


def neighbours(docs: DataFrame, id_col="doc_id", text_col="text", n_ranges: int | None = None) -> DataFrame:
    """bucket, rn, extra, doc_id, text, next_text in descending order of id.

    Texts go to ranges of ids; the first row of each range is also sent to the range
    before it (after the last range comes the first), as an `extra` row sorted last, so
    that every row finds its next in its own range. Which row is first is a broadcast of
    one id and hash a range."""
    spark = docs.sparkSession
    n = n_ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.withColumn("bucket", bucket_of(F.col("doc_id"), F.col("tie"), *ranges(docs, n, id_col)))
    # descending, nulls last: the first of a range is its smallest (is null, -id, tie)
    rank = F.struct(F.col("doc_id").isNull().alias("a"), (-F.col("doc_id")).alias("b"), F.col("tie").alias("c"))
    firsts = rows.groupBy("bucket").agg(F.min(rank).alias("f")).orderBy("bucket").collect()  # one row a range
    if not firsts:
        empty = rows.limit(0)
        return empty.select("bucket", F.lit(0).alias("rn"), F.lit(False).alias("extra"), "doc_id", "text", F.col("text").alias("next_text"))
    live = [r["bucket"] for r in firsts]
    heads = [(r["bucket"], live[i - 1], r["f"]["b"], r["f"]["c"]) for i, r in enumerate(firsts)]
    heads = spark.createDataFrame(heads, "head bigint, before bigint, neg bigint, tie2 bigint")
    copies = rows.join(
        F.broadcast(heads), (F.col("bucket") == F.col("head")) & F.col("tie").eqNullSafe(F.col("tie2")) & (-F.col("doc_id")).eqNullSafe(F.col("neg")), "left"
    )
    sent = F.when(F.col("head").isNull(), F.array(F.struct("bucket", F.lit(False).alias("extra")))).otherwise(
        F.array(F.struct("bucket", F.lit(False).alias("extra")), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("extra")))
    )
    placed = copies.select("doc_id", "text", "tie", F.explode(sent).alias("s")).select("s.bucket", "s.extra", "doc_id", "text", "tie")
    w = Window.partitionBy("bucket").orderBy("extra", F.col("doc_id").desc_nulls_last(), "tie")
    placed = placed.select("bucket", "extra", "doc_id", "text", F.row_number().over(w).alias("rn"), F.lead("text").over(w).alias("next_text"), F.lead("extra").over(w).alias("next_extra"))
    return placed


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last third replaced by the beginning of the next."""
    return F.concat(F.left(text, _kept(text)), _borrowed(text, next_text))


def _kept(text: Column) -> Column:
    n = F.length(text)
    return n - F.floor(n / F.lit(3)).cast("int")


def _borrowed(text: Column, next_text: Column) -> Column:
    return F.left(F.coalesce(next_text, F.lit("")), F.length(text) - _kept(text))


def counted(hashes: Column) -> Column:
    """The distinct terms of an array of hashes, each with its count in its lower bits."""

    def ends(s: Column) -> Column:
        return F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i - 1)))

    def encoded(s: Column, e: Column) -> Column:
        n = lambda x, k: (x - F.coalesce(F.get(e, k - 1), F.lit(0))).cast("bigint")
        most = F.lit((1 << WEIGHT_BITS) - 1).cast("bigint")
        return F.transform(e, lambda x, k: F.get(s, x - 1).bitwiseOR(F.least(n(x, k), most)))

    some = let(F.sort_array(hashes), lambda s: let(ends(s), lambda e: encoded(s, e)))
    return F.when(F.size(hashes) > 0, some).otherwise(F.array().cast("array<bigint>"))


def terms(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, term (hash and weight), in, limit: the terms of each text and of its edited form.

    The words that end before the cut are split and hashed once for both; what follows the
    last white space before the cut belongs to a word that each form ends in its own way."""
    text, following = F.col("text"), F.col("next_text")
    cut = pairs.select(*keys, F.left(text, _kept(text)).alias("kept"), F.substring(text, _kept(text) + 1, F.length(text)).alias("gone"), _borrowed(text, following).alias("new"))
    cut = cut.withColumn("whole", F.regexp_extract("kept", rf"(?s)^.*{SPACE}", 0))
    cut = cut.withColumn("open", F.substring(F.col("kept"), F.length("whole") + 1, F.length("kept")))
    mask = F.lit(-(1 << WEIGHT_BITS))
    hashes = lambda t: F.transform(F.array_remove(F.split(t, SPACE + "+"), ""), lambda x: F.xxhash64(x).bitwiseAND(mask))
    cut = cut.select(*keys, hashes(F.col("whole")).alias("h"), hashes(F.concat("open", "gone")).alias("o"), hashes(F.concat("open", "new")).alias("e"))
    cut = cut.select(*keys, counted(F.concat("h", "o")).alias("own"), counted(F.concat("h", "e")).alias("changed"), (F.size("h") + F.size("o")).alias("w0"), (F.size("h") + F.size("e")).alias("w1"))
    cut = cut.withColumn("both", F.array_intersect("own", "changed"))
    part = lambda kinds, values, words: F.struct(F.lit(kinds).alias("in"), (F.lit(LEAST) / words).alias("limit"), values.alias("terms"))
    least_words = F.greatest(F.least("w0", "w1"), F.lit(1))
    parts = F.array(
        part(3, F.col("both"), least_words),
        part(1, F.array_except("own", "both"), F.greatest("w0", F.lit(1))),
        part(2, F.array_except("changed", "both"), F.greatest("w1", F.lit(1))),
    )
    return cut.select(*keys, F.explode(parts).alias("p")).select(*keys, "p.in", "p.limit", F.explode("p.terms").alias("term"))


def fingerprinted(docs: DataFrame, id_col="doc_id", text_col="text", n_ranges: int | None = None) -> DataFrame:
    """One row per document: see op2_fingerprints."""
    pairs = neighbours(docs, id_col, text_col, n_ranges).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    keys = ["bucket", "rn"]
    signs = signatures(terms(pairs, keys), keys)
    n_longs = SAMPLES // PER_LONG
    array = lambda kind: F.when(F.col(f"s{kind}_0").isNotNull(), F.array(*[F.col(f"s{kind}_{i}") for i in range(n_longs)]))
    signs = signs.select(*keys, array(0).alias("own"), array(1).alias("changed"))
    facts = pairs.select(*keys, "extra", "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"))
    # null-safe keys: no filter on nulls is pushed into one branch only, so both read the one shuffle of texts
    signs = signs.select(F.col("bucket").alias("b2"), F.col("rn").alias("rn2"), "own", "changed")
    both = facts.join(signs, F.col("bucket").eqNullSafe(F.col("b2")) & F.col("rn").eqNullSafe(F.col("rn2")), "left")
    w = Window.partitionBy("bucket").orderBy("rn")
    both = both.withColumn("following", F.lead("own").over(w)).filter(~F.col("extra"))
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_of(F.col("own")).alias("fingerprint"),
        text_of(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def op2_fingerprints(spark, sf_dir):
    """Every document with its fingerprint and those of its edited text and its next document."""
    return fingerprinted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
