"""Best-fit packing after Martello-Toth dominance reduction.

What decides a packing is only how many pieces there are of each length, at most
`capacity` numbers whatever the corpus. The driver reduces that histogram: a longest
piece is fixed for good together with the one partner that dominates every other way of
filling its sequence (nothing else fits; the partner fills it exactly; only one more
piece could fit at all; or no two pieces that fit outweigh the partner). What remains is
packed best-fit, longest first, in whole groups of equal sequences. The plan, a list of
ranges of ranks within a length, goes to the executors; each piece finds its place by its
rank, from counts by (length, salt), so that a hot length is spread over many tasks: each
length has as many salts as its pieces ask for.

Defined results: null and empty texts have one token, the end id; texts of any length are
encoded whole, one at a time; pieces longer than the capacity do not exist; repeated rows are packed as often as they stand; no rows, no
sequences."""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, small, text_batches, written
from .tokens import encoder, public

CAPACITY, END = 2048, 0
TOKENIZER = "word_bpe_49k.json"
#: Pieces of one (length, salt) that one task ranks, about.
RANKED_ROWS = 20_000


def reduce(n: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fixes dominating sets in the histogram n (by length), which it changes in place."""
    fixed = []
    sizes = [x for x in range(1, capacity + 1) if n[x]]
    moved = True
    while moved and sizes:
        moved = False
        for j in sizes[::-1]:
            while n[j]:
                room = capacity - j
                n[j] -= 1
                # the three smallest others, and the largest other that fits
                least = []
                for x in sizes:
                    least += [x] * min(n[x], 3 - len(least))
                    if len(least) == 3:
                        break
                at = bisect.bisect_right(sizes, room) - 1
                while at >= 0 and not n[sizes[at]]:
                    at -= 1
                n[j] += 1
                if at < 0:
                    fixed.append(((j,), n[j]))
                    n[j] = 0
                    moved = True
                    break
                k = sizes[at]
                alone = len(least) < 2 or least[0] + least[1] > room
                two = len(least) < 3 or sum(least) > room
                if not (k == room or alone or (two and k >= _best_pair(n, sizes, room, j))):
                    break
                q = n[j] // 2 if j == k else min(n[j], n[k])
                if not (k == room) and len(least) < 3:
                    q = 1  # with so few left, look again after each
                if q == 0:
                    break
                fixed.append(((j, k), q))
                n[j] -= q
                n[k] -= q
                moved = True
        sizes = [x for x in sizes if n[x]]
    return fixed


def _best_pair(n: list[int], sizes: list[int], room: int, j: int) -> int:
    """The largest sum of two other pieces that fits in room; 0 if none does."""
    n[j] -= 1
    live = [x for x in sizes if n[x]]
    best, lo, hi = 0, 0, len(live) - 1
    while lo <= hi:
        s = live[lo] + live[hi]
        if s > room or (lo == hi and n[live[lo]] < 2):
            hi -= 1
            continue
        best = max(best, s)
        lo += 1
    n[j] += 1
    return best


def best_fit(n: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing of the histogram n, in groups of equal sequences."""
    rooms: list[int] = []  # sorted free rooms that some group has
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(room: int, items: tuple[int, ...], count: int) -> None:
        if room not in groups:
            groups[room] = []
            bisect.insort(rooms, room)
        groups[room].append((items, count))

    for size in range(capacity, 0, -1):
        left = n[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                per = capacity // size
                whole, rest = divmod(left, per)
                if whole:
                    put(capacity - per * size, (size,) * per, whole)
                if rest:
                    put(capacity - rest * size, (size,) * rest, 1)
                break
            room = rooms[at]
            items, count = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            # equal pieces keep going into the same sequence while it is the best fit
            per = room // size
            if left >= per:
                take = min(count, left // per)
                put(room - per * size, items + (size,) * per, take)
                left -= take * per
                if count > take:
                    put(room, items, count - take)
            else:
                put(room - left * size, items + (size,) * left, 1)
                if count > 1:
                    put(room, items, count - 1)
                left = 0
    return [g for many in groups.values() for g in many]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, offset), sorted by rank.

    Within a row ranks and sequences run on together, so a piece of rank r in a row
    (r0, s0, o) lies in sequence s0 + r - r0 at offset o."""
    n = [counts.get(x, 0) for x in range(capacity + 1)]
    sets = reduce(n, capacity)
    sets += best_fit(n, capacity)
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for items, count in sets:
        offset = 0
        for x in items:
            r = used.get(x, 0)
            out.setdefault(x, []).append((r, sequence, offset))
            used[x] = r + count
            offset += x
        sequence += count
    return {x: np.array(rows, np.int64) for x, rows in out.items()}


def pieces(docs: DataFrame, tokenizer: str, id_col="doc_id", text_col="text", capacity=CAPACITY, end=END, specials=False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every piece of every whole text."""
    last = np.array([end], "<u4").tobytes()

    def run(batches):
        enc = encoder(tokenizer, drops_space=True, specials=specials)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(enc.stream(t.as_py() for t in b.column(1))):
                ids += last
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A written table of pieces, with the sequence and offset of each."""
    with scratch() as keep:
        return _packed(cut, capacity, keep)


def _packed(cut: DataFrame, capacity: int, keep) -> DataFrame:
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a length
    # salts of each length, by its place in an array of capacity + 1
    salts = F.split(F.lit(",".join(str(-(-counts.get(x, 0) // RANKED_ROWS) or 1) for x in range(capacity + 1))), ",").cast("array<int>")
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.get(salts, F.col("length").cast("int"))).cast("int")
    salted = cut.withColumn("salt", salt)
    most = sum(-(-n // RANKED_ROWS) for n in counts.values())
    parts = written(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "lengths", rows=most)
    places = plan(counts, capacity)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = written(parts.select("length", "salt", before.alias("first")), "lengths", rows=most)
    keep(first)
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("rank", rank).join(small(first), ["length", "salt"]).withColumn("rank", (F.col("rank") + F.col("first")).cast("long"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            kinds, at = np.unique(length[order], return_index=True)
            for x, rows in zip(kinds.tolist(), np.split(order, at[1:]), strict=True):
                table = places[x]
                k = np.searchsorted(table[:, 0], rank[rows], side="right") - 1
                sequence[rows] = table[k, 1] + rank[rows] - table[k, 0]
                offset[rows] = table[k, 2]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    kind = cut.schema["doc_id"].dataType.simpleString()
    return ranked.select(*columns, "rank").mapInArrow(place, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END, **cols) -> DataFrame:
    with text_batches(docs.sparkSession):
        cut = written(pieces(docs, tokenizer or public(TOKENIZER), capacity=capacity, end=end, **cols), "pieces")
    return packed(cut, capacity)


def op7_best_fit_packing(spark, sf_dir):
    """Every piece of every document with its place in the packed sequences."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), specials=True)
