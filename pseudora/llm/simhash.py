"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: one bit for each hash bit that is set in over half of the XXH64 hashes of a
text's word shingles, 64 bits, or 256 in the wide form, whose further words are mixed from
the same hashes. Equal fingerprints become one node first, so groups of copies of any size
cost one comparison. Nodes are laid out in cells by population counts, of four 16-bit
quarters for a small radius, of the whole first word for a large one. Fingerprints within
`radius` bits have counts that differ by `radius` at most in all, so pairs of tiles
farther apart are skipped; the others are compared whole with exclusive-or and bit counts
in numpy. Cells of many nodes are split into tiles of bounded size, so no task holds an
unbounded group, and a pair of tiles emits a star for each group that it links, never all
pairs. In the wide form pairs must also lie within `wide_radius` bits of all 256.

The wide form takes each shingle once, names nodes by their set of shingles, and links only
candidates: what they connect is compared again, in tiles of each group, by the Jaccard
similarity of the sets of shingles (as their 64-bit hashes), and links at SIMILARITY or more.
Sets so alike have sizes within that ratio, so cells and the tiles of a group are also laid
out by the logarithm of the size, and only neighbouring ones meet.

Exact comparison of all tiles is quadratic in the number of distinct fingerprints; quarters
keep about one pair in seventy at radius 2, the wide form those of like sizes.

Defined results: null and empty texts have fingerprint 0 and link like any other; fewer
words than a shingle make one shingle; very long texts are walked in slabs, with a shingle's
overlap, and hold no list of their words (the wide form holds 8 bytes a distinct shingle);
repeated rows are kept; null ids are never the smallest of a component unless it has no
other; an empty table gives no rows; further columns are not read."""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, small, text_batches, written
from .components import components, hook

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Rows of a tile: two tiles are compared in blocks of about a million pairs.
TILE_ROWS = 4096
WIDE_TILE_ROWS = 1 << 16
#: Bytes of a text that are cut into words at once.
_SLAB = 1 << 18
#: The wide form: candidates for five-word shingles at a similarity of 0.8 or more. At
#: Jaccard 0.8 the cosine of two sets of one size is 8/9, which differs in 0.15 of the bits:
#: 38.8 of 256 and 9.7 of 64, to which the radii add about three deviations (5.7 and 2.9).
WIDE = {"shingle": 5, "radius": 18, "wide_radius": 56}
#: Jaccard similarity that links candidates, as a fraction.
SIMILARITY = (4, 5)
#: Texts, and bytes of texts, of a tile of a group in which candidates are compared by their shingles.
GROUP_ROWS, GROUP_BYTES = 512, 64 << 20
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


_SPACES = b" \t\n\v\f\r"
_BLANK = re.compile(rb"[ \t-\r]")


def _slabs(text: str | None):
    """Lists of the lower-case words of a text, a slab of its bytes at a time."""
    raw, at = (text or "").encode("utf-8", "surrogatepass"), 0
    while at < len(raw):
        end = at + _SLAB
        if end < len(raw):
            cut = _BLANK.search(raw, end)
            end = cut.start() if cut else len(raw)
        yield raw[at:end].lower().split()
        at = end


def shingled(text: str | None, shingle: int):
    """The hashes of a text's word shingles, one for each place, in arrays of bounded size."""
    digest, held, told = xxhash.xxh64_intdigest, [], False
    for words in _slabs(text):
        held += words
        n = len(held) - shingle + 1
        if n < 1:
            continue
        line = b" ".join(held)
        ends = np.cumsum([len(w) + 1 for w in held])
        starts, stops = [0, *ends[: n - 1].tolist()], (ends[shingle - 1 :] - 1).tolist()
        yield np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
        held, told = held[n:], True
    if held and not told:  # fewer words than a shingle
        yield np.array([digest(b" ".join(held), SEED)], np.uint64)


def distinct_shingles(text: str | None, shingle: int) -> np.ndarray:
    """The sorted set of the hashes of a text's shingles."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *(np.unique(h) for h in shingled(text, shingle))]))


def _words(parts, k: int) -> list[int]:
    """k words of 64 bits: each bit that is set in over half of all hashes in the arrays."""
    ones, n = np.zeros((k, 64), np.int64), 0
    for h in parts:
        n += len(h)
        for i in range(k):
            x = h
            if i:
                x = (h ^ (h >> np.uint64(29))) * np.uint64(_MIX[i - 1])
                x = x ^ (x >> np.uint64(32))
            ones[i] += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > n, axis=1, bitorder="little").reshape(-1).view("<u8").tolist()


def fingerprint(text: str | None, shingle: int = SHINGLE, wide: bool = False) -> list[int]:
    """The words of the fingerprint: one, or four, a hash of the set of shingles and its size in the wide form."""
    if not wide:
        return _words(shingled(text, shingle), 1)
    h = distinct_shingles(text, shingle)
    return [*_words([h[k : k + _SLAB // 8] for k in range(0, len(h), _SLAB // 8)], 4), xxhash.xxh64_intdigest(h.tobytes(), SEED), len(h)]


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = SHINGLE, wide: bool = False) -> DataFrame:
    """doc_id, key (hash of the text), f0.. : the words of every whole text's fingerprint, as
    signed longs; fp, which names its node: the word, or the hash of the set of shingles, of size n."""
    names = ["f0", "f1", "f2", "f3", "fp", "n"] if wide else ["f0"]

    def run(batches):
        for b in batches:
            got = np.array([fingerprint(t.as_py(), shingle, wide) for t in b.column(2)], np.uint64).reshape(-1, len(names)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(got[:, i].copy()) for i in range(len(names))]], names=["doc_id", "key", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    made = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text")).mapInArrow(
        run, f"doc_id {kind}, key bigint, " + ", ".join(f"{n} bigint" for n in names)
    )
    return made if wide else made.withColumn("fp", F.col("f0"))


def _alike_sizes(x, y):
    """Whether sets of these sizes can be as like as SIMILARITY."""
    num, den = SIMILARITY
    return den * np.minimum(x, y) >= num * np.maximum(x, y)


def _near(a: np.ndarray, b: np.ndarray, radius: int, wide_radius: int | None, same: bool, sizes=None):
    """Index pairs (i, j) within the radii and, where sizes are given, of like sizes, in blocks of rows."""
    step = max(1, (1 << 20) // max(1, len(b)))
    b0 = np.ascontiguousarray(b[:, 0])
    for at in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[at : at + step, :1] ^ b0[None, :]) <= radius)
        i = i + at
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        if sizes is not None and len(i):
            keep = _alike_sizes(sizes[0][i], sizes[1][j])
            i, j = i[keep], j[keep]
        if wide_radius is not None and len(i):
            keep = np.bitwise_count(a[i] ^ b[j]).sum(axis=1, dtype=np.int64) <= wide_radius
            i, j = i[keep], j[keep]
        if len(i):
            yield i, j


def _stars(a: np.ndarray, b: np.ndarray | None, radius: int, wide_radius: int | None = None, sizes=None):
    """(node, root) places of one tile pair: every linked node with the root of its group in the pair."""
    shift = 0 if b is None else len(a)
    parent = np.arange(len(a) + (0 if b is None else len(b)))
    for i, j in _near(a, a if b is None else b, radius, wide_radius, b is None, sizes):
        parent = hook(parent, i, j + shift)
    moved = np.flatnonzero(parent != np.arange(len(parent)))
    return moved, parent[moved]


def _size_class(n):
    """Sizes as like as SIMILARITY fall into one class or neighbouring ones."""
    num, den = SIMILARITY
    return F.floor(F.ln(F.greatest(n, F.lit(1)).cast("double")) / F.lit(math.log(den / num))).cast("int")


def links(nodes: DataFrame, radius: int = RADIUS, wide_radius: int | None = None, tile_rows: int | None = None) -> DataFrame:
    """Edges (u, v) among nodes (fp, f0.. and in the wide form n) that connect all within the radii."""
    words = [c for c in nodes.columns if re.fullmatch("f[0-9]", c)]
    wide = wide_radius is not None and "n" in nodes.columns
    # a small radius: four quarters, counts one by one; a large one: the first word, counts by eights
    parts, grain = (4, 1) if radius <= 4 else (1, 8)
    if tile_rows is None:
        total = nodes.count()
        tile_rows = TILE_ROWS if parts == 4 else max(TILE_ROWS, min(WIDE_TILE_ROWS, total // 12))
    bits = 64 // parts
    mask = F.lit((1 << bits) - 1 if parts > 1 else -1)
    counts = [F.floor(F.bit_count(F.shiftrightunsigned("f0", bits * k).bitwiseAND(mask)) / F.lit(grain)).cast("int") for k in range(parts)]
    top = bits // grain
    base = top + 1
    cell = sum((c * base**k for k, c in enumerate(counts)), F.lit(0))
    data = [*words, *(["n"] if wide else [])]
    if wide:
        cell = cell + _size_class(F.col("n")) * base**parts
    placed = nodes.select("fp", *data, cell.cast("int").alias("cell"), *[c.alias(f"c{k}") for k, c in enumerate(counts)])
    # at most 17^4 cells, or 9 for each class of sizes, whatever the input: a bounded broadcast
    tiles = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(tile_rows))).cast("int").alias("tiles"))
    tiles = written(tiles, "cells", rows=base**parts)
    least = lambda x: max(0, grain * abs(x) - (grain - 1))  # noqa: E731  bits by which counts in cells x apart differ
    reach = [x for x in range(-top, top + 1) if least(x) <= radius]
    steps = [(*d, z) for d in itertools.product(reach, repeat=parts) if sum(map(least, d)) <= radius for z in ((-1, 0, 1) if wide else (0,))]
    step = F.explode(F.array(*[F.struct(*[F.lit(x).alias(f"d{k}") for k, x in enumerate(d[:parts])], F.lit(sum(x * base**k for k, x in enumerate(d))).alias("off")) for d in steps]))
    own = placed.join(F.broadcast(tiles), "cell").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    inside = F.lit(True)
    for k in range(parts):
        inside = inside & (F.col(f"c{k}") + F.col(f"s.d{k}")).between(0, top)
    other = tiles.select(F.col("cell").alias("cell2"), F.col("tiles").alias("tiles2"))
    met = (
        own.withColumn("s", step).filter(inside).withColumn("cell2", F.col("cell") + F.col("s.off"))
        .join(F.broadcast(other), "cell2")
        .withColumn("tile2", F.explode(F.sequence(F.lit(0), F.col("tiles2") - 1)))
    )
    pack = lambda c, t: F.shiftleft(F.col(c).cast("long"), 32).bitwiseOR(F.col(t).cast("long"))
    met = met.select("fp", *data, pack("cell", "tile").alias("x"), pack("cell2", "tile2").alias("y"))
    dealt = met.select(
        F.least("x", "y").alias("p"),
        F.greatest("x", "y").alias("q"),
        F.when(F.col("x") == F.col("y"), 0).when(F.col("x") < F.col("y"), 1).otherwise(2).cast("byte").alias("side"),
        "fp",
        *data,
    )

    def compare(batches):
        held: list[np.ndarray] = []

        def flush():
            rows = np.concatenate(held)
            side, fp = rows["side"], rows["fp"]
            f = np.stack([rows[w].view(np.uint64) for w in words], axis=1)
            n = rows["n"] if wide else None
            if side[0] == 0:
                u, v = _stars(f, None, radius, wide_radius, (n, n) if wide else None)
            else:
                a, b = side == 1, side == 2
                if not a.any() or not b.any():
                    return
                u, v = _stars(f[a], f[b], radius, wide_radius, (n[a], n[b]) if wide else None)
                fp = np.concatenate([fp[a], fp[b]])
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(fp[u]), pa.array(fp[v])], names=["u", "v"])

        kind = np.dtype([("p", np.int64), ("q", np.int64), ("side", np.int8), ("fp", np.int64), *[(w, np.int64) for w in data]])
        for b in batches:
            rows = np.empty(b.num_rows, kind)
            for name in kind.names:
                rows[name] = b.column(name).to_numpy(zero_copy_only=False)
            if not len(rows):
                continue
            cut = np.flatnonzero((rows["p"][1:] != rows["p"][:-1]) | (rows["q"][1:] != rows["q"][:-1])) + 1
            for part in np.split(rows, cut):
                if held and (held[-1]["p"][0], held[-1]["q"][0]) != (part["p"][0], part["q"][0]):
                    yield from flush()
                    held = []
                held.append(part)
        if held:
            yield from flush()

    return dealt.repartition("p", "q").sortWithinPartitions("p", "q").mapInArrow(compare, "u bigint, v bigint")


def _alike(sets: list[np.ndarray], f: np.ndarray, wide_radius: int, side: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (i, j) that connect all within wide_radius whose sets are as like as SIMILARITY.

    side is 0 where all pairs count, else those of a 1 and a 2. Pairs that others connect are not compared."""
    num, den = SIMILARITY
    size = np.array([len(x) for x in sets], np.int64)
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i in range(len(sets)):
        fits = _alike_sizes(size[:i], size[i]) & ((side[:i] == 0) | (side[:i] != side[i]))
        js = np.flatnonzero(fits)
        apart = np.bitwise_count(f[js] ^ f[i]).sum(axis=1, dtype=np.int64)
        order = np.argsort(apart, kind="stable")
        for j in js[order[apart[order] <= wide_radius]].tolist():
            p, q = root(i), root(j)
            if p == q:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if den * both >= num * int(size[i] + size[j] - both):
                parent[max(p, q)] = min(p, q)
                out.append((i, j))
    return out


def confirmed(texts: DataFrame, shingle: int, wide_radius: int, group_rows: int = GROUP_ROWS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Edges (u, v) that connect all pairs of a group (fp, root, n, f0.., text) which are as like as SIMILARITY.

    A group is dealt in pairs of tiles of bounded size, of one class of sizes or neighbouring ones."""
    words = [c for c in texts.columns if re.fullmatch("f[0-9]", c)]
    texts = texts.withColumn("class", _size_class(F.col("n")) if "n" in texts.columns else F.lit(0))
    tiles = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(float(group_rows)), F.sum(F.octet_length("text")) / F.lit(float(group_bytes)))).cast("int")
    tiles = written(texts.groupBy("root", "class").agg(F.greatest(tiles, F.lit(1)).alias("tiles")), "simhash-groups")
    own = texts.join(small(tiles), ["root", "class"]).withColumn("t", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("long")).drop("tiles")
    met = own.withColumn("class2", F.explode(F.array(*[F.col("class") + d for d in (-1, 0, 1)]))).join(
        small(tiles.select("root", F.col("class").alias("class2"), "tiles")), ["root", "class2"]
    )
    met = met.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles").cast("long") - 1)))
    pack = lambda c, t: F.shiftleft(F.col(c).cast("long"), 40).bitwiseOR(F.col(t))
    met = met.withColumn("x", pack("class", "t")).withColumn("y", pack("class2", "o"))
    dealt = met.select(
        "root", F.least("x", "y").alias("p"), F.greatest("x", "y").alias("q"),
        F.when(F.col("x") == F.col("y"), 0).when(F.col("x") < F.col("y"), 1).otherwise(2).cast("int").alias("side"), "fp", *words, "text",
    )

    def compare(batches):
        at, held = None, []

        def flush():
            if len(held) < 2:
                return
            got = _alike([h[2] for h in held], np.array([h[3:] for h in held], np.int64).view(np.uint64), wide_radius, np.array([h[0] for h in held]))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([held[k[x]][1] for k in got], pa.int64()) for x in (0, 1)], names=["u", "v"])

        for b in batches:
            text = b.column("text")
            rows = [b.column(c).to_pylist() for c in ("root", "p", "q", "side", "fp", *words)]
            for k, (root, p, q, side, fp, *f) in enumerate(zip(*rows, strict=True)):
                if (root, p, q) != at:
                    yield from flush()
                    at, held = (root, p, q), []
                held.append((side, fp, distinct_shingles(text[k].as_py(), shingle), *f))
        yield from flush()

    return dealt.repartition("root", "p", "q").sortWithinPartitions("root", "p", "q").mapInArrow(compare, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", shingle=SHINGLE, radius=RADIUS, wide_radius: int | None = None, tile_rows: int | None = None) -> DataFrame:
    """doc_id, key (hash of the text), f0, component_id (the smallest id reachable) and root
    (the name of the component, which ids that are null or stand twice leave apart) for every row of docs."""
    wide, spark = wide_radius is not None, docs.sparkSession
    with scratch() as keep:
        with text_batches(spark):
            fps = written(fingerprints(docs, id_col, text_col, shingle, wide), "simhash")
        data = [c for c in fps.columns if re.fullmatch("f[0-9]|n", c)]
        nodes = written(fps.groupBy("fp", *data).agg(F.min("doc_id").alias("first"), F.min("key").alias("sample")), "simhash-nodes")
        roots = written(components(links(nodes.drop("first", "sample"), radius, wide_radius, tile_rows)), "simhash-roots")
        if wide:
            # one text of each node that has candidates
            asked = written(nodes.join(roots, nodes["fp"] == roots["node"]).select("fp", "root", "sample", *data), "simhash-asked")
            text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
            told = docs.select(F.xxhash64(text).alias("told"), text.alias("text")).join(small(asked), F.col("told") == F.col("sample"))
            texts = written(told.groupBy("fp", "root", *data).agg(F.first("text").alias("text")), "simhash-texts")
            with text_batches(spark):
                roots = written(components(confirmed(texts, shingle, wide_radius)), "simhash-roots")
        # nodes without links stand alone; for the others, the smallest id of the component
        linked = written(nodes.join(roots, nodes["fp"] == roots["node"]).select("fp", "root", "first"), "simhash-linked")
        low = linked.groupBy("root").agg(F.min("first").alias("low"))
        member = linked.join(low, "root").select(F.col("fp").alias("m"), "low", "root")
        named = nodes.join(member, nodes["fp"] == member["m"], "left").select(
            F.col("fp").alias("node"), F.coalesce("low", "first").alias("component_id"), F.coalesce("root", "fp").alias("root")
        )
        keep(fps, nodes, linked)
        return fps.join(named, fps["fp"] == named["node"]).select("doc_id", "key", "f0", "component_id", "root")


def op3_simhash(spark, sf_dir):
    """Every document with its fingerprint and the component of links at 2 bits or fewer."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = near_duplicates(docs)
    return got.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")
