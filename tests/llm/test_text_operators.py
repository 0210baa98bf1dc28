"""Operators on texts against brute force, on a small fixture of hard cases."""

import collections
import hashlib
import math
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pseudora.llm import components, fingerprints, mixing, pii, quality, rules, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def collected(df):
    return [r.asDict() for r in df.collect()]


def key(r):
    return (r["doc_id"] is None, r["doc_id"])


# -- 1: mixing -----------------------------------------------------------------------------


def water(sizes, num=3, den=2, most=2):
    """Targets by the rule as it is told: deal by weight, stop at the cap, deal the excess anew."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, open_, out = sum(sizes.values()) * num / den, set(order), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            open_.remove(s)
        left = sum(sizes.values()) * num / den - sum(out.values())
    return out


def test_mixing(spark):
    rows = [(i, "w " * (1 + i * 7 % 13), "abcd"[min(i % 10, 3)] if i % 11 else None) for i in range(400)]
    got = collected(mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")))
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t))
    aims = water(sizes)
    assert len(got) == 400
    taken = collections.Counter()
    for r in got:
        assert r["size"] == len(WORD.findall(rows[r["doc_id"]][1])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(aims[r["source"]]) and r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, n in taken.items():
        assert abs(n - aims[s]) <= 13
    again = collected(mixing.mix(spark.createDataFrame(rows[::-1], "doc_id bigint, text string, source string")))
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_mixing_cases(docs, nothing):
    assert mixing.mix(docs).count() == docs.count()
    assert mixing.mix(nothing).count() == 0


# -- 2: fingerprints -------------------------------------------------------------------------


def test_fingerprints(spark, docs, nothing):
    got = sorted(collected(fingerprints.fingerprinted(docs)), key=key)
    assert len(got) == docs.count()
    rows = sorted(collected(docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))), key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["tie"]))
    want = collections.Counter()
    for r, nxt in zip(rows, rows[1:] + rows[:1], strict=True):
        t, n = r["text"] or "", nxt["text"] or ""
        third = len(t) // 3
        e = t[: len(t) - third] + n[:third]
        want[r["doc_id"], len(t), hashlib.sha256(e.encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    by = collections.defaultdict(set)
    text = {r["doc_id"]: r["text"] for r in rows}
    for r in got:
        by[text[r["doc_id"]] or ""].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(v) == 1 for v in by.values())
    assert fingerprints.fingerprinted(nothing).count() == 0


def test_collisions_follow_generalised_jaccard(spark):
    # neighbours share words that no other pair has, so the pairs' errors are independent
    rng = np.random.default_rng(3)
    rows = []
    for pair in range(40):
        words, p = [f"p{pair}w{i}" for i in range(80)], np.arange(1, 81) ** -0.5
        rows += [(2 * pair + k, " ".join(rng.choice(words, 150, p=p / p.sum())), None) for k in (0, 1)]
    got = {r["doc_id"]: r for r in collected(fingerprints.fingerprinted(spark.createDataFrame(rows, "doc_id bigint, text string, x string")))}
    diff = []
    for i in range(1, 80, 2):
        a, b = (collections.Counter(rows[k][1].split()) for k in (i, i - 1))
        diff.append(got[i]["near_next"] - sum((a & b).values()) / sum((a | b).values()))
    spread = math.sqrt(0.25 / fingerprints.SAMPLES)
    assert abs(np.mean(diff)) < 3 * spread / math.sqrt(40) and np.std(diff) < 1.5 * spread


# -- 3: SimHash ------------------------------------------------------------------------------


def brute_fingerprint(text, shingle=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))] if w else []
    n = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for b in range(64):
            n[b] += h >> b & 1
    return sum(1 << b for b in range(64) if parts and 2 * n[b] > len(parts))


def test_simhash_fingerprints(docs, texts, nothing):
    got = collected(simhash.near_duplicates(docs))
    assert len(got) == docs.count() and simhash.near_duplicates(nothing).count() == 0
    for r in got:
        if r["doc_id"] is not None:
            assert r["f0"] & (2**64 - 1) == brute_fingerprint(texts[r["doc_id"]])
    assert {r["component_id"] for r in got if r["doc_id"] in (0, 1, 2)} == {0}
    assert {r["component_id"] for r in got if r["doc_id"] in (7, 8)} == {7}


@pytest.mark.parametrize("radius,tile", [(2, 8), (2, 4096), (6, 50)])
def test_links_connect_all_within_radius(spark, radius, tile):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 40, dtype=np.int64).astype(np.uint64)
    near = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, rng.integers(0, radius + 2), replace=False))) for b in base for _ in range(8)]
    fps = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius), strict=True):
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    nodes = spark.createDataFrame([(int(x),) * 2 for x in fps.view(np.int64)], "fp bigint, f0 bigint")
    roots = {r["node"]: r["root"] for r in components.components(simhash.links(nodes, radius, tile_rows=tile)).collect()}
    groups = collections.defaultdict(set)
    for i, x in enumerate(fps.view(np.int64).tolist()):
        groups[find(i)].add(x)
    for g in groups.values():
        assert len({roots.get(x, x) for x in g}) == 1
    assert len({roots.get(x, x) for x in fps.view(np.int64).tolist()}) == len(groups)


@pytest.mark.parametrize("edges", [[], [(5, 5)], [(3, 2), (2, 3), (3, 2)], None])
def test_components_settle_alike_on_the_driver_and_off_it(spark, edges):
    if edges is None:  # chains, hubs and pairs, with ids of either sign
        rng = np.random.default_rng(4)
        edges = [(int(a), int(b)) for a, b in rng.integers(-400, 400, (300, 2))] + [(1000, i) for i in range(1001, 1060)] + [(i + 1, i) for i in range(2000, 2040)] + [(-(2**63), 2**63 - 1)]
    groups = {x: {x} for e in edges for x in e}
    for a, b in edges:
        if groups[a] is not groups[b]:
            groups[a] |= groups[b]
            groups |= dict.fromkeys(groups[b], groups[a])
    table = spark.createDataFrame(edges, "u bigint, v bigint")
    for settled in (components.SETTLED_EDGES, 0):
        got = components.components(table, settled=settled)
        assert dict(got.dtypes) == {"node": "bigint", "root": "bigint"}
        assert sorted(map(tuple, got.collect())) == sorted((x, min(g)) for x, g in groups.items())


def test_components_of_few_edges_take_few_jobs(spark):
    """A chain takes the distributed steps many rounds, each of them four jobs and more of the driver's memory."""
    table = spark.createDataFrame([(i + 1, i) for i in range(300)], "u bigint, v bigint")
    spark.sparkContext.setJobGroup("few edges", "")
    try:
        assert components.components(table).filter("root = 0").count() == 301
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few edges")) <= 8
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# -- 4: quality ------------------------------------------------------------------------------


def test_convolution_matches_plain_loops():
    rng = np.random.default_rng(1)
    m = quality.Model(rng.normal(size=(4, 256, quality.FILTERS)).astype(np.float32), rng.normal(size=(quality.FILTERS, quality.HIDDEN)).astype(np.float32), rng.normal(size=quality.HIDDEN).astype(np.float32), rng.normal(size=2 * quality.HIDDEN).astype(np.float32), 0.1)
    texts = [b"", b"abc", b"hello world " * 40, bytes(range(256)) * 3]
    for t, s in zip(texts, quality.score_texts(m, texts), strict=True):
        n = -(-(len(t) + 3) // quality.HALF)
        pad = t + b"\0" * (n * quality.HALF - len(t) + 4)
        conv = np.array([sum(m.conv[k, pad[i + k]] for k in range(4)) for i in range(n * quality.HALF)])
        half = conv.reshape(n, quality.HALF, -1).max(axis=1)
        chunk = [np.maximum(half[i], half[i + 1]) for i in range(n - 1)] or [half[0]]
        h = np.maximum(np.array(chunk) @ m.hid + m.hid_b, 0)
        z = np.concatenate([h.mean(axis=0), h.max(axis=0)]) @ m.out + m.out_b
        assert s == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_quality_learns_and_bears_cases(spark, docs, nothing):
    good = [(i, f"the quick brown fox number {i} jumps over the lazy dog " * 5, 1) for i in range(120)]
    bad = [(200 + i, f"BUY!! NOW!! CHEAP!! OFFER!! {i} " * 8, 0) for i in range(120)]
    both = spark.createDataFrame(good + bad, "doc_id bigint, text string, quality int")
    model = quality.fitted(both, both.select("doc_id", "quality"))
    out = quality.scored(both, model).withColumn("held", quality.held_out("doc_id")).filter("held").collect()
    assert len(out) > 20 and all((r["score"] >= 0.5) == (r["quality"] == 1) for r in out)
    assert quality.scored(docs, model, to="s2").filter("s2 between 0 and 1").count() == docs.count()
    assert quality.scored(nothing, model).count() == 0
    assert quality.fitted(both, both.select("doc_id", "quality").limit(0)) is None
    assert {r["s2"] for r in quality.scored(docs, None, to="s2").collect()} == {0.5}


# -- 5: rules --------------------------------------------------------------------------------


def brute_measures(t):
    t = t or ""
    w = WORD.findall(t)
    grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def test_rules(spark, docs, texts, nothing):
    got = collected(rules.judged(docs))
    assert len(got) == docs.count() and rules.judged(nothing).count() == 0
    for r in got:
        t = "no id" if r["doc_id"] is None else texts[r["doc_id"]]
        want = brute_measures(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, r
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r["base_failed"] and r["kept"])


def test_bad_hosts_go_and_small_ones_are_shrunk(spark):
    prose = " ".join(f"word{i}" for i in range(60))
    symbols = " ".join(f"word{i} # *" for i in range(30))
    rows = [(i, prose, f"h{i % 8}") for i in range(400)] + [(1000 + i, symbols, "junk") for i in range(95)] + [(2000 + i, prose, "junk") for i in range(5)]
    got = collected(rules.judged(spark.createDataFrame(rows, "doc_id bigint, text string, source string")))
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[i] for i in range(400)) and not any(kept[i] for i in range(1000, 1095)) and not kept[2000]


# -- 6: personal data ------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(t):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), list(PATTERNS).index(kind), m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


HARD = [
    "a@b.com@d.org a@b.com+x@d.org .@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004", "4111111111111111", "4111 1111 1111 1111 2", "+1 (017) 555-7713) x +12345 +1234567890123456",
    "é 日本 me@host.example, +44 20 7946 0958.", "1" * 3000, "a" * 3000 + "@", "1.1.1.1" * 3, "x@y.z " * 150, "10.0.0.1 " * 200, "-4111-1111-1111-1111-", "",
]


def test_base_spans(spark, docs, texts, nothing):
    df = spark.createDataFrame(list(enumerate(HARD)), "doc_id bigint, text string")
    for source, known in ((df, dict(enumerate(HARD))), (docs, dict(enumerate(texts)) | {None: "no id"})):
        for r in collected(pii.all_spans(source).select("doc_id", pii.listed(F.col("base")).alias("base"))):
            assert r["base"] == brute_spans(known[r["doc_id"]]), known[r["doc_id"]]
    assert pii.all_spans(nothing).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    def card(i):
        body = f"{400000000000000 + 7919 * i:015d}"
        return next(body + c for c in "0123456789" if sum(sum(divmod(int(x) * (1 + k % 2), 10)) for k, x in enumerate((body + c)[::-1])) % 10 == 0)

    cards = [card(i) for i in range(30)]
    rows = [(i, f"some words member no: {c} expires soon") for i, c in enumerate(cards)]
    rows += [(100, "other words member no: AB123456Z expires soon"), (101, "room 123456 is free"), (102, "member no: later")]
    got = {r["doc_id"]: r["s"] for r in pii.all_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()}
    at = rows[30][1].index("AB123456Z")
    assert got[100] == f"context:{at}:{at + 9}" and got[101] == "" and got[102] == ""
    assert all(got[i].startswith("card:") for i in range(30))


def test_redaction(spark, docs):
    out = {r["doc_id"]: r["text"] for r in pii.redacted(docs).collect()}
    assert pii.redacted(docs).columns == docs.columns and len(out) == 18
    assert out[12] == "mail [EMAIL] or [PHONE] at [IP] today" and out[0] is None and out[4] == "two words"
    assert out[13] == "card [CARD] and 4111-1111-1111-1112"


def brute_signature(text):
    """All samples of all terms, one by one: the least value's hash of each sample, in hex."""

    def long_hash(x, seed=42):
        return xxhash.xxh64_intdigest((x & 2**64 - 1).to_bytes(8, "little"), seed)

    def uniforms(h):
        return ((h >> 40) + 0.5) * ((h >> 16 & 0xFFFFFF) + 0.5) * 2.0**-48

    out, counts = "", collections.Counter(WORD.findall(text or ""))
    for sample in range(fingerprints.SAMPLES):
        least = math.inf
        for word, n in counts.items():
            term = xxhash.xxh64_intdigest(word.encode(), 42)
            term = (term - (term >> 63 << 64)) >> fingerprints.WEIGHT_BITS
            x = xxhash.xxh64_intdigest((sample // fingerprints.GROUP).to_bytes(4, "little"), long_hash(term))
            i = sample % fingerprints.GROUP
            h, q = long_hash(x ^ 2 * i), uniforms(long_hash(x ^ 2 * i + 1))
            r, b = -math.log(uniforms(h)), ((h & 0xFFFF) + 0.5) * 2.0**-16
            t = math.floor(math.log(n) / r + b)
            least = min(least, math.log(-math.log(q)) - r * (t - b + 1))
        out += f"{xxhash.xxh64_intdigest(struct.pack('<d', least), 42) & 0xFFFF:04x}" if counts else "0000"
    return out


def test_fingerprints_are_the_least_of_all_samples(spark):
    """Logarithms that are left out, and terms that two texts share, change nothing."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, n) % 500) for n in (0, 1, 3, 30, 300, 900)] + [None, "a", "a a a a a"]
    rows = sorted(((i, t) for i, t in enumerate(texts)), reverse=True)
    got = {r["doc_id"]: r for r in collected(fingerprints.fingerprinted(spark.createDataFrame(rows, "doc_id bigint, text string")))}
    same = lambda a, b: sum(a[k : k + 4] == b[k : k + 4] for k in range(0, len(a), 4)) / fingerprints.SAMPLES
    differ = 0
    for (i, t), (j, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, n = t or "", n or ""
        e = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
        want = [brute_signature(t), brute_signature(e)]
        # a last bit of a logarithm may differ between the two languages, never more than a few samples
        differ += sum(x != y for a, b in zip(want, (got[i]["fingerprint"], got[i]["edited_fingerprint"]), strict=True) for x, y in zip(*([s[k : k + 4] for k in range(0, len(s), 4)] for s in (a, b)), strict=True))
        assert abs(got[i]["near_edited"] - same(*want)) <= 2 / 64
        assert (got[i]["fingerprint"] == got[j]["fingerprint"]) == (got[i]["near_next"] == 1.0)
    assert differ <= 0.1 * 2 * 64 * len(rows)


def test_many_rows_without_an_id_or_with_one_id_are_split(spark):
    rows = [(None, f"text {i} of nobody") for i in range(40)] + [(7, f"text {i} of seven") for i in range(40)] + [(i, f"text {i}") for i in range(100, 140)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    placed = collected(fingerprints.neighbours(docs, n_ranges=12).filter("NOT extra").select("doc_id", "bucket", "text", "next_text", F.xxhash64("text").alias("tie")))
    by = collections.defaultdict(set)
    for r in placed:
        by[r["doc_id"]].add(r["bucket"])
    assert len(placed) == 120 and len(by[None]) > 2 and len(by[7]) > 2 and max(collections.Counter(r["bucket"] for r in placed).values()) < 40
    order = sorted(placed, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["tie"]))
    for r, nxt in zip(order, order[1:] + order[:1], strict=True):
        assert r["next_text"] == nxt["text"]


def test_very_long_texts_are_walked_in_slabs(monkeypatch):
    monkeypatch.setattr(simhash, "_SLAB", 37)
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 4, 50, 400):
        text = "  ".join("Wörd%d" % k for k in rng.integers(0, 90, n)) + "\n" * (n % 3)
        assert simhash.fingerprint(text) == [brute_fingerprint(text)]
        words = [w.lower() if w.isascii() else w.replace("W", "w") for w in text.split()]
        grams = {" ".join(words[k : k + 5]) for k in range(max(1, n - 4))} if n else set()
        assert simhash.distinct_shingles(text, 5).tolist() == sorted(xxhash.xxh64_intdigest(g.encode(), 42) for g in grams)


def test_whole_spans_are_seeds_whatever_they_look_like(spark):
    """E-mails without digits and phones with blanks induce patterns; names without digits are found in them."""
    rows = [(i, f"please write to the desk {w}{w}@example.com about this") for i, w in enumerate(("anna", "bert", "carl", "dora", "emil", "finn", "gina", "hugo"))]
    rows += [(20 + i, f"you may ring us at +44 20 7946 {1000 + 37 * i} or not") for i in range(8)]
    rows += [(40, "please write to the desk annette.b about this"), (41, "you may ring us at 5526 or not"), (42, "please write to " + "x" * 300 + " the desk later")]
    got = {r["doc_id"]: r["s"] for r in pii.all_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()}
    for i, what in ((40, "annette.b"), (41, "5526")):
        at = dict(rows)[i].index(what)
        assert got[i] == f"context:{at}:{at + len(what)}"
    assert got[42] == "" and all(got[i].count(":") == 2 for i in [*range(8), *range(20, 28)])


def test_context_words_are_whole(spark):
    long = "w" * 500
    rows = [(i, f"{long}a {x}@example.com end") for i, x in enumerate("abcdefgh")] + [(20, f"{long}b maybe_7 end"), (21, f"{long}a maybe_7 end")]
    got = {r["doc_id"]: r["spans"] for r in pii.all_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(got[20]) == 0 and len(got[21]) == 1


def brute_scores(edges, rounds=200):
    """The scores of patterns by plain loops, until nothing moves."""
    by_p, by_i = collections.defaultdict(list), collections.defaultdict(list)
    for p, i, seed in edges:
        by_p[p].append((i, seed))
        by_i[i].append(p)
    score = {i: float(seed) for _, i, seed in edges}
    for _ in range(rounds):
        sure = {p: sum(score[i] for i, _ in xs) / (len(xs) + 1) for p, xs in by_p.items()}
        score = {i: score[i] if any(s for p in ps for j, s in by_p[p] if j == i) else sum(sure[p] for p in ps) / (len(ps) + 1) for i, ps in by_i.items()}
    return sure


def test_scores_settle_near_the_fixed_point(spark):
    rng = np.random.default_rng(4)
    seeds = {i: bool(rng.random() < 0.4) for i in range(60)}
    edges = sorted({(int(p), int(i), seeds[int(i)]) for p, i in zip(rng.integers(0, 12, 300), rng.integers(0, 60, 300), strict=True)})
    got = {r["pattern"]: (r["sure"], r["support"]) for r in pii.scored(spark.createDataFrame(edges, "pattern bigint, instance bigint, seed boolean"), rounds=40, settled=1e-6).collect()}
    want = brute_scores(edges)
    assert all(abs(got[p][0] - want[p]) < 1e-4 and got[p][1] == sum(s for q, _, s in edges if q == p) for p in want)
    lone = [(1, i, i < 9) for i in range(18)]  # nine seeds, nine others in this pattern alone
    sure = pii.scored(spark.createDataFrame(lone, "pattern bigint, instance bigint, seed boolean"), settled=1e-6).first()["sure"]
    assert abs(sure - 9 / (9 + 4.5 + 1)) < 1e-3


def test_sources_are_ranked_in_ranges(spark):
    per = spark.createDataFrame([(f"s{i:03d}", i) for i in range(100)] + [(None, 5)], "source string, source_size bigint")
    got = sorted((r["rank"], r["source"]) for r in mixing.ranked(per, range_rows=7).collect())
    assert got == [(i, f"s{i:03d}") for i in range(100)] + [(100, None)]


def test_few_labels_and_one_label(spark):
    """Few labelled rows are trained as long as many, and uneven labels weigh the same."""
    few = [(i, f"the quick brown fox number {i} jumps over the lazy dog " * 5, 1) for i in range(40)] + [(100 + i, f"BUY!! NOW!! CHEAP!! OFFER!! {i} " * 8, 0) for i in range(6)]
    docs = spark.createDataFrame(few, "doc_id bigint, text string, quality int")
    model = quality.train([t.encode() for _, t, _ in few], [y for *_, y in few])
    out = quality.scored(docs, model).collect()
    assert all((r["score"] >= quality.THRESHOLD) == (r["quality"] == 1) for r in out)
    alone = quality.train([t.encode() for _, t, _ in few[:40]], [1] * 40, epochs=1)
    assert all(r["score"] > 0.5 for r in quality.scored(docs.filter("quality = 1"), alone).collect())


def test_tables_of_a_scope_are_deleted(spark):
    import os

    from pseudora.llm import common

    at = lambda t: t._pseudora_path.removeprefix("file:")
    with common.scratch():
        with common.scratch() as keep:
            a, b = common.written(spark.range(3), "a"), common.written(spark.range(3), "b")
            keep(b)
        assert not os.path.exists(at(a)) and b.count() == 3
    assert not os.path.exists(at(b))
