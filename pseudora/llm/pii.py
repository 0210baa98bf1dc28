"""Personal data: patterns of fixed kinds, and bootstrapped contextual extraction.

Base spans (email, ip, card, phone) are found in each text's own row, with possessive
patterns whose cost is linear even in very long runs of letters or digits.

The method on top starts from them as seeds. Each base span is one token, and a seed, with the
words around the whole span as its context; so is every other token shaped like an identifier:
one with a digit, an at sign, an underscore, or a mark between two letters. (Plain words are no
instances: to try all tokens in all contexts that five seeds share took 3,700 CPU seconds a GB.)
Contexts are lexical patterns: the words on either side, and the three words before. Spark
scores the graph of patterns and instances in rounds: a pattern is as sure as its distinct
instances are on average, with one doubtful instance more; a seed is sure, any other instance
as sure as its patterns are on average, with one doubtful pattern more. Scores rise from round
to round, and the rounds end when no pattern moves by more than SETTLED. Patterns of SUPPORT
distinct seeds or more count. One of S seeds and U others that stand in it alone settles at
S / (S + U / 2 + 1): five seeds reach CONFIDENCE with up to two others, thirty with up to
twenty-three. What else stands in a pattern that sure is found as a span of kind "context".
Contexts left out are those of fewer seeds, and those that mostly hold other identifiers.

Only narrow rows of tokens are shuffled; scores are grouped with partial aggregation and
joined back as broadcasts if few by count and bytes, else as skew-splitting joins.

Defined results: null texts are empty and have no spans; the digest of no spans is that of
the empty string; texts of any length are read whole, in time linear in their length and, for
texts with spans, in length times spans; rows equal in id and text share their spans; a
discovered span never overlaps a base span, and base spans never change; ties at CONFIDENCE
are sure; an empty table gives no rows; further columns are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, let, prefix_sums, scratch, small, written

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"
# The shapes that define the base kinds. Against plain forms of the same
# shapes these only add anchors that keep a failed run from being tried again inside.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that a text can hold a kind at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
#: Rounds at most, seeds of a pattern at least, how sure a pattern is that discovers, and when scores have settled.
ROUNDS, SUPPORT, CONFIDENCE, SETTLED = 12, 5, 0.7, 0.01
#: What parts tokens, beside white space; dots at their end are no part of them. One by one, as Java's
#: classes are slow for ranges and for characters beyond Latin-1.
_BREAKS = r" \t\n\x0B\f\r,;:!?()\[\]{}<>\"'"
_WORDS = rf"[^{_BREAKS}]+"
#: Characters of base spans, and what stands for them in a text of tokens: private characters that keep
#: a span one token, tell it from others, and are taken out of the text before.
_SPAN_CHARS = "0123456789@ ()"
_PRIVATE = "".join(chr(0xF8D0 + k) for k in range(len(_SPAN_CHARS)))
_MARKED = f"[{_PRIVATE[0]}-{_PRIVATE[-1]}]"
#: Tokens shaped like identifiers, tried once a token: with a mark of identity after what has none.
_PLAIN = rf"[^{_BREAKS}0123456789@_.+%\-{_PRIVATE[0]}-{_PRIVATE[-1]}]"
CANDIDATE = rf"(?<![^{_BREAKS}])(?:{_PLAIN}*+(?:[0123456789@_]|{_MARKED}|(?<=[A-Za-z])[.+%\-](?=[A-Za-z])|[.+%\-]++(?=[^{_BREAKS}]*?(?:[0123456789@_]|{_MARKED}))))[^{_BREAKS}]*+"
#: Code points beside a token in which its context words are looked for first; where they do not show whole, in all of the text.
REACH = 160


def found(text: Column, pattern: str, more=None) -> Column:
    """array of (start, end, value) of all matches, in code points, and of what more(pieces, matches, i) adds.

    The text is split at the matches; places are running sums of the lengths."""

    def build(pieces: Column, matches: Column) -> Column:
        steps = F.transform(matches, lambda m, i: (F.length(m) + F.length(F.get(pieces, i))).cast("bigint"))

        def spans(at: Column) -> Column:
            return F.transform(
                matches,
                lambda m, i: let(
                    F.get(at, i) + F.length(F.get(pieces, i)),
                    lambda s: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("value"), *(more(pieces, matches, i) if more else ())),
                ),
            )

        return let(prefix_sums(steps), spans)

    return let(F.split(text, pattern, -1), lambda p: let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: build(p, m)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a number pass the Luhn check."""

    def total(d: Column) -> Column:
        n = F.length(d)
        odd = lambda i: F.substring(d, n - i + 1, F.lit(1))
        # a doubled digit, its own digits added: fixed values of the check
        return F.aggregate(
            F.sequence(F.lit(1), n),
            F.lit(0),
            lambda s, i: s + F.when(i % 2 == 0, F.translate(odd(i), "123456789", "246813579")).otherwise(odd(i)).cast("int"),
        )

    return let(digits(value), lambda d: total(d) % 10 == 0)


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)(?:\.|$)){4}$")
    if kind == "card":
        return F.length(digits(value)).between(14, 19) & luhn(value)
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


_SPANS = "array<struct<start:bigint,k:int,end:bigint>>"


def base_spans(text: Column) -> dict[str, Column]:
    """kind -> array of (start, k, end), k the place of the kind."""
    def spans(k: int, kind: str) -> Column:
        hits = F.filter(found(text, PATTERNS[kind]), lambda x: valid(kind, x["value"]))
        return F.transform(hits, lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("k"), x["end"].alias("end"))).cast(_SPANS)

    out = {}
    for k, kind in enumerate(KINDS):
        hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])
        out[kind] = F.when(hint, spans(k, kind)).otherwise(F.array().cast(_SPANS))
    return out


def rows_of(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, key (hash of the text), n_<kind>, base (sorted spans), candidates: a narrow row per document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("key"), "text", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])
    rows = rows.select("doc_id", "key", "text", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS], F.array_sort(F.concat(*KINDS)).alias("base"))
    return rows.select("doc_id", "key", *[f"n_{k}" for k in KINDS], "base", candidates(F.col("text"), F.col("base")).alias("candidates"))


def woven(text: Column, spans: Column, gap, span) -> Column:
    """The text with what lies between spans, and the spans themselves, replaced by columns;
    of spans that overlap, the later ones' further part is a span of its own: span(its text, its kind, whether new)."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    part = lambda a, b: F.substring(text, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))

    def step(s: Column, x: Column) -> Column:
        begin = F.greatest(s["at"], x["start"])
        return F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.concat(s["out"], F.array(gap(part(s["at"], x["start"])), span(part(begin, x["end"]), x["k"], x["start"] >= s["at"]))).alias("out"),
        )

    whole = lambda s: F.concat(F.array_join(s["out"], ""), gap(F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, whole)).otherwise(gap(text))


def candidates(text: Column, spans: Column) -> Column:
    """array of (start, end, instance, seed, both, left): the tokens of a text that are shaped like identifiers,
    base spans among them as seeds, with hashes of their lower case and of their contexts; null if there are none."""
    clean = F.when(text.rlike(_MARKED), F.translate(text, _PRIVATE, " " * len(_PRIVATE))).otherwise(text)
    marked = woven(clean, spans, lambda t: t, lambda t, k, new: F.translate(t, _SPAN_CHARS, _PRIVATE))
    split = lambda t: F.regexp_extract_all(t, F.lit(_WORDS), F.lit(0))
    plain = lambda w: F.rtrim(F.lower(w), F.lit("."))

    def contexts(pieces: Column, matches: Column, i: Column) -> list[Column]:
        before = F.concat(F.coalesce(F.get(matches, i - 1), F.lit("")), F.get(pieces, i))
        after = F.concat(F.get(pieces, i + 1), F.coalesce(F.get(matches, i + 1), F.lit("")))
        # the outermost word of a part may be cut: one more than is needed shows that the others are whole
        near = let(before, lambda t: let(split(F.right(t, F.lit(REACH))), lambda w: F.when((F.size(w) > 3) | (F.length(t) <= REACH), w).otherwise(split(t))))
        far = let(after, lambda t: let(split(F.left(t, F.lit(REACH))), lambda w: F.when((F.size(w) > 1) | (F.length(t) <= REACH), w).otherwise(split(t))))
        last = lambda w, k: plain(F.get(w, F.size(w) - k))
        both = let(near, lambda w: F.when(F.size(w) > 0, last(w, 1)))
        right = let(far, lambda w: plain(F.get(w, F.lit(0))))
        three = let(near, lambda w: F.when(F.size(w) > 2, F.xxhash64(last(w, 3), last(w, 2), last(w, 1))))
        return [let(both, lambda x: let(right, lambda y: F.when(x.isNotNull() & y.isNotNull(), F.xxhash64(x, y)))).alias("both"), three.alias("left")]

    def candidate(x: Column) -> Column:
        value = F.rtrim(x["value"], F.lit("."))
        return F.struct(
            x["start"].alias("start"), (x["start"] + F.length(value)).alias("end"), F.xxhash64(F.lower(value)).alias("instance"),
            value.rlike(_MARKED).alias("seed"), x["both"].alias("both"), x["left"].alias("left"),
        )

    return F.when(marked.rlike(CANDIDATE), let(marked, lambda t: F.transform(found(t, CANDIDATE, contexts), candidate)))


def scored(edges: DataFrame, rounds=ROUNDS, settled=SETTLED) -> DataFrame:
    """pattern, support, sure: of edges (pattern, instance, seed), each pair once."""
    most = edges.count()
    told = edges.withColumn("score", F.col("seed").cast("double"))
    patterns, before = None, None
    for _ in range(rounds):
        # an instance stands in many patterns and a pattern round many instances: both sums combine before the shuffle
        patterns = told.groupBy("pattern").agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("sure"), F.count_if("seed").alias("support"))
        patterns = written(patterns, "pii-patterns", rows=most)
        if before is not None:
            old = before.select(F.col("pattern").alias("p2"), F.col("sure").alias("was"))
            moved = patterns.join(old, patterns["pattern"] == old["p2"]).agg(F.max(F.col("sure") - F.col("was"))).first()[0]
            forget(before)
            if (moved or 0.0) <= settled:
                break
        before = patterns
        scores = edges.filter("NOT seed").join(small(patterns.select("pattern", "sure")), "pattern").groupBy("instance").agg((F.sum("sure") / (F.count(F.lit(1)) + 1)).alias("told"))
        scores = written(scores, "pii-scores", rows=most)
        told = edges.join(small(scores), "instance", "left").select("pattern", "instance", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("told", F.lit(0.0))).alias("score"))
    return patterns


def discovered(rows: DataFrame, rounds=ROUNDS, support=SUPPORT, confidence=CONFIDENCE) -> DataFrame:
    """doc_id, key, start, end of the spans that sure patterns find beyond the base ones."""
    seen = rows.filter(F.size("candidates") > 0).select("doc_id", "key", F.explode("candidates").alias("c")).select("doc_id", "key", "c.*")
    held = ["doc_id", "key", "start", "end", "instance", "seed"]
    seen = written(seen.select(*held, F.explode(F.array("both", "left")).alias("pattern")).filter("pattern IS NOT NULL"), "pii-seen")
    # an instance that is a seed anywhere is one everywhere
    known = written(seen.filter("seed").select(F.col("instance").alias("i2")).distinct().withColumn("is", F.lit(True)), "pii-seeds")
    edges = seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")).join(small(known), F.col("instance") == F.col("i2"), "left")
    edges = written(edges.select("pattern", "instance", F.coalesce("is", F.lit(False)).alias("seed")), "pii-edges")
    # patterns of fewer seeds cannot be sure enough, nor lend what they do not have
    shared = written(edges.groupBy("pattern").agg(F.count_if("seed").alias("n")).filter(F.col("n") >= support).select("pattern"), "pii-shared")
    edges = written(edges.join(small(shared), "pattern", "left_semi"), "pii-edges")
    sure = scored(edges, rounds).filter((F.col("support") >= support) & (F.col("sure") >= confidence)).select("pattern")
    return seen.filter("NOT seed").join(small(written(sure, "pii-sure")), "pattern", "left_semi").select("doc_id", "key", "start", "end").distinct()


def all_spans(docs: DataFrame, id_col="doc_id", text_col="text", **limits) -> DataFrame:
    """doc_id, key, n_<kind>, base, spans: base and discovered spans, sorted."""
    with scratch() as keep:
        rows = written(rows_of(docs, id_col, text_col), "pii")
        extra = discovered(rows, **limits).groupBy(F.col("doc_id").alias("d2"), F.col("key").alias("key2")).agg(
            F.collect_set(F.struct("start", F.lit(len(KINDS)).alias("k"), "end")).cast(_SPANS).alias("extra")
        )
        extra = written(extra, "pii-extra")
        keep(rows, extra)
        got = rows.drop("candidates").join(small(extra), F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("key") == F.col("key2")), "left")
        spans = F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast(_SPANS))))
        return got.withColumn("spans", spans).drop("d2", "key2", "extra")


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, CONTEXT)])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by [KIND]."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in (*KINDS, CONTEXT)])
    return woven(text, spans, lambda t: t, lambda t, k, new: F.when(new, F.get(names, k)).otherwise(F.lit("")))


def redacted(docs: DataFrame, id_col="doc_id", text_col="text", **limits) -> DataFrame:
    """docs with personal data masked in `text_col`; all other columns and null texts as they are."""
    with scratch() as keep:
        found_ = all_spans(docs, id_col, text_col, **limits).filter(F.size("spans") > 0)
        spans = written(found_.select(F.col("doc_id").alias("pii__id"), F.col("key").alias("pii__key"), F.col("spans").alias("pii__spans")).distinct(), "pii-spans")
        keep(spans)
        key = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        got = docs.join(small(spans), docs[id_col].eqNullSafe(F.col("pii__id")) & (key == F.col("pii__key")), "left")
        text = F.when(F.col("pii__spans").isNull(), F.col(text_col)).otherwise(masked(F.col(text_col), F.col("pii__spans")))
        return got.withColumn(text_col, text).select(*docs.columns)


def op6_pii(spark, sf_dir):
    """Every document with its counts, the digest of its base spans, and all spans."""
    got = all_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digest = F.sha2(listed(F.col("base")), 256)
    return got.select("doc_id", *[f"n_{k}" for k in KINDS], digest.alias("base_sha256"), listed(F.col("spans")).alias("spans"))
