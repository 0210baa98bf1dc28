"""URL filters: rules by host and path, and a logistic regression on hashed character
n-grams of host and path, all in DataFrame functions.

The model is trained from a small labelled table, MAX_LABELLED rows at most: its n-grams
are hashed to BUCKETS, and gradient descent runs as one SQL expression over the collected
features of those rows, in a single row. The weights (BUCKETS + 1 doubles, whatever the
input) become a literal of the scoring expression: every URL is judged in its own row,
with no shuffle and no join. A session fits the built-in table once.

Defined results: a URL that is null or has no "://" has empty host and path; host and path
that are both empty have no n-grams and get the verdict of the bias; URLs of any length are
judged whole; of rules that fit, the longest wins, and of equally long ones the blocking one;
a score equal to the threshold blocks; without labelled rows all weights are 0 and the verdict
is allow; repeated rows are judged alike; an empty table gives no rows; further columns are
not read."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, scratch, written

BUCKETS, GRAMS = 2048, (3, 4, 5)
MAX_LABELLED, STEPS, RATE, RIDGE = 2000, 300, 8.0, 1e-4
#: The table has as many bad rows as good ones, the web has not: to block a good page is held to be
#: four times as bad as to let a bad one pass.
THRESHOLD = 0.8

# The rules of the filter.
#: (verdict, host, path): a rule fits its host and all subdomains, if the path starts with its path.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

#: What the labelled table is made of: words of unwanted hosts and of others, and paths of both.
UNWANTED = (
    "cheap", "pills", "casino", "jackpot", "bets", "replica", "payday", "loans", "xxx", "cams", "adult", "dating", "prize",
    "winner", "giveaway", "bonus", "spins", "tracker", "popup", "clicks", "pharmacy", "escort", "lottery", "warez",
)
WANTED = (
    "library", "university", "museum", "garden", "history", "physics", "news", "recipes", "weather", "travel", "science",
    "music", "poetry", "health", "parliament", "cooking", "astronomy", "birds", "trains", "river", "teaching", "school",
    "archive", "language", "nature", "council", "theatre", "bridge", "forest", "village", "weekly", "journal",
)
_PREFIXES = ("", "", "www.", "www.", "m.", "blog.", "en.", "my.")
_ENDINGS = ("com", "org", "net", "info", "de", "fr", "es", "io", "co.uk", "edu", "eu", "biz")
_BOTH = ("/", "/en/{n}", "/de/{n}", "/fr/{n}", "/es/{n}", "/index.html", "/p/{n}", "/about")
_PATHS = {1: ("/bonus/{n}", "/buy-now/{w}", "/promo/{w}", "/free-{w}", "/click/{n}"), 0: ("/articles/{n}", "/wiki/{w}", "/2019/05/{w}", "/events/{n}", "/contact")}
#: Rows of each label.
TABLE_ROWS = 300


def labelled(spark: SparkSession) -> DataFrame:
    """url, label (1 blocks): hosts of two words of a kind, in all forms, endings and paths, by a rule.

    The pairs of words that come first by a hash are taken, TABLE_ROWS of each label."""
    rows = []
    for label, words in ((1, UNWANTED), (0, WANTED)):
        pairs = sorted((zlib.crc32(f"{label}|{a}|{b}".encode()), a, b) for a in words for b in words if a != b)
        for h, a, b in pairs[:TABLE_ROWS]:
            pick = lambda options, k: options[(h >> k) % len(options)]  # noqa: B023, E731
            host = pick((f"{a}{b}", f"{a}-{b}", f"{a}.{b}", f"{b}{h % 100}-{a}", f"the{a}{b}"), 3)
            path = pick(_BOTH + _PATHS[label], 11).format(n=h % 1000, w=pick(words, 17))
            rows.append((f"http{'s' * (h & 1)}://{pick(_PREFIXES, 5)}{host}.{pick(_ENDINGS, 7)}{path}", label))
    return spark.createDataFrame(rows, "url string, label int")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    has = F.instr(text, "://") > 0
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(has, lower).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def grams(host: Column, path: Column) -> Column:
    """Buckets of the distinct character n-grams of host and path, each marked by its part."""

    def of(text: Column, mark: str) -> list[Column]:
        edged = F.concat(F.lit("^"), text, F.lit("$"))
        return [
            F.when(
                F.length(text) > 0,
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.length(edged) - (n - 1), F.lit(1))),
                    lambda i: F.pmod(F.xxhash64(F.lit(mark), F.substring(edged, i, F.lit(n))), F.lit(BUCKETS)).cast("int"),
                ),
            ).otherwise(F.array().cast("array<int>"))
            for n in GRAMS
        ]

    return F.array_distinct(F.concat(*of(host, "h"), *of(path, "p")))


def train(table: DataFrame, steps=STEPS, rate=RATE, ridge=RIDGE) -> list[float]:
    """BUCKETS weights and the bias, by full-batch gradient descent in one SQL expression."""
    with scratch():
        return _train(table, steps, rate, ridge)


def _train(table: DataFrame, steps: int, rate: float, ridge: float) -> list[float]:
    host, path = parts(F.col("url"))
    rows = table.filter("label in (0, 1)").select("url", "label").distinct().orderBy("url", "label").limit(MAX_LABELLED)
    rows = rows.select(F.col("label").cast("double").alias("y"), grams(host, path).alias("g")).withColumn("norm", F.sqrt(F.greatest(F.size("g"), F.lit(1)).cast("double")))
    # one row: all examples, and the examples of each bucket
    one = rows.agg(F.array_sort(F.collect_list(F.struct("g", "y", "norm"))).alias("x"))
    # written between the steps, else each would be computed anew inside the next one's lambdas
    used = written(one.select("x", F.array_sort(F.array_distinct(F.flatten(F.transform("x", lambda r: r["g"])))).alias("used")), "urls")
    slots = used.select(
        "used",
        F.transform("x", lambda r: F.struct(F.transform(r["g"], lambda b: F.array_position(F.col("used"), b).cast("int") - 1).alias("g"), r["y"].alias("y"), r["norm"].alias("norm"))).alias("x"),
    )
    slots = written(slots, "urls")
    holds = lambda i: F.filter(F.transform("x", lambda r, k: F.when(F.array_contains(r["g"], i), F.struct(k.alias("k"), r["norm"].alias("norm")))), lambda e: e.isNotNull())
    slots = written(slots.withColumn("cols", F.transform("used", lambda b, i: holds(i))), "urls")
    n = F.size("x").cast("double")
    zero = F.lit(0.0)

    def step(s: Column, _: Column) -> Column:
        def residual(r: Column) -> Column:
            z = F.aggregate(r["g"], s["b"], lambda a, i: a + F.get(s["w"], i) / r["norm"])
            return (F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) - r["y"]) / n

        def moved(e: Column) -> Column:
            w = F.zip_with(
                s["w"],
                F.col("cols"),
                lambda w, c: w - F.lit(rate) * (F.aggregate(c, zero, lambda a, k: a + F.get(e, k["k"]) / k["norm"]) + F.lit(ridge) * w),
            )
            b = s["b"] - F.lit(rate) * F.aggregate(e, zero, lambda a, x: a + x)
            return F.struct(w.alias("w"), b.alias("b"))

        return let(F.transform("x", residual), moved)

    start = F.struct(F.transform("used", lambda _: zero).alias("w"), zero.alias("b"))
    got = slots.select("used", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step).alias("m")).first()
    weights = [0.0] * BUCKETS
    if got is None or not got["used"]:
        return [*weights, 0.0]
    for b, w in zip(got["used"], got["m"]["w"], strict=True):
        weights[b] = w
    return [*weights, got["m"]["b"]]


def probability(host: Column, path: Column, model: list[float]) -> Column:
    """The probability that a URL is unwanted."""
    weights = F.split(F.lit(",".join(map(repr, model[:-1]))), ",").cast("array<double>")
    z = let(
        grams(host, path),
        lambda g: F.lit(model[-1]) + F.aggregate(g, F.lit(0.0), lambda a, b: a + F.get(weights, b)) / F.sqrt(F.greatest(F.size(g), F.lit(1)).cast("double")),
    )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def judged(pages: DataFrame, model: list[float], rules=RULES, threshold=THRESHOLD, id_col="page_id", url_col="url") -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row."""
    host, path = parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # tried from the shortest to the longest: the last that fits stands
    for what, at, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((F.col("host") == at) | F.endswith("host", F.lit("." + at))) & F.startswith("path", F.lit(start))
        rule, verdict = F.when(fits, at + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    rows = rows.withColumn("score", probability(F.col("host"), F.col("path"), model)).withColumn("rule", rule)
    return rows.withColumn("verdict", F.coalesce(verdict, F.when(F.col("score") >= threshold, "block").otherwise("allow")))


#: The model of the built-in table, by session.
_fitted: dict[str, list[float]] = {}


def fitted(spark: SparkSession) -> list[float]:
    session = spark.sparkContext.applicationId
    if session not in _fitted:
        _fitted[session] = train(labelled(spark))
    return _fitted[session]


def op8_url_filter(spark, sf_dir):
    """Every page's host, path, the rule that fits and the verdict."""
    got = judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), fitted(spark))
    return got.select("page_id", "host", "path", "rule", "verdict", "score")
