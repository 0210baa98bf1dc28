"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters slide over the bytes of the whole text. The text is covered by
overlapping chunks (CHUNK bytes, half a chunk apart); each filter is max-pooled in each
chunk, a small hidden layer reads the pooled chunk, and the mean and the maximum over
all chunks are combined into one probability. A filter of WIDTH bytes is a table of
weights by (position, byte), so a convolution is WIDTH / 2 look-ups by byte pair, and
training only has to follow the positions that won the pooling.

The network is trained on the driver on a bounded sample (SAMPLE_ROWS labelled rows of
at most SAMPLE_BYTES each, chosen by a hash of the id, half of each label where there
are as many), scored in Arrow batches on the executors, and travels as about 0.2 MB of
tables in the closure. It is trained for at least LEAST_STEPS steps, and both labels weigh the
same in all, however many rows each has: a score is the probability of label 1 where both are
as frequent, so THRESHOLD means the same for few labelled rows and many. Texts of any length are scored in slabs of bounded memory.

Defined results: null and empty texts are one chunk of padding and get a score; labels
that are null, or not 0 or 1, are not learnt from, nor are ids with both labels; without
labelled rows every score is 0.5, and with rows of one label alone scores lean to it; a score
equal to THRESHOLD is label 1; repeated rows get equal scores; further columns are kept."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_ROWS = 4000
SAMPLE_BYTES = 1 << 15
FILTERS, WIDTH, HIDDEN = 24, 4, 16
HALF = 128
CHUNK = 2 * HALF
EPOCHS, BATCH, RATE = 12, 64, 0.01
#: Steps of training, whatever the number of rows.
LEAST_STEPS = 750
THRESHOLD = 0.3
#: Bytes scored at once: FILTERS floats each.
SLAB = 1 << 17


@dataclass
class Model:
    conv: np.ndarray  # WIDTH x 256 x FILTERS
    hid: np.ndarray  # FILTERS x HIDDEN
    hid_b: np.ndarray
    out: np.ndarray  # 2 * HIDDEN
    out_b: float

    def pairs(self) -> list[np.ndarray]:
        """Tables by byte pair: 65,536 rows of FILTERS floats for each two positions."""
        c = self.conv
        return [(c[k][:, None, :] + c[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, WIDTH, 2)]


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each padded with zeros to whole half-chunks with at least
    WIDTH - 1 zeros, and the half-chunks of each."""
    halves = np.array([(len(t) + WIDTH - 1 + HALF - 1) // HALF for t in texts], np.int64)
    buf = bytearray(int(halves.sum()) * HALF + WIDTH)
    at = 0
    for t, n in zip(texts, halves.tolist(), strict=True):
        buf[at : at + len(t)] = t
        at += n * HALF
    return np.frombuffer(buf, np.uint8), halves


def half_maxima(data: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Max-pooled filters of each half-chunk: (halves, FILTERS)."""
    n = len(data) - WIDTH
    out = np.empty((n // HALF, tables[0].shape[1]), np.float32)
    for at in range(0, n, SLAB):
        end = min(n, at + SLAB)
        pair = (data[at : end + WIDTH - 1].astype(np.int32) << 8) | data[at + 1 : end + WIDTH]
        m = end - at
        conv = tables[0].take(pair[:m], axis=0)
        for k, table in enumerate(tables[1:], 1):
            conv += table.take(pair[2 * k : 2 * k + m], axis=0)
        conv.reshape(-1, HALF, conv.shape[1]).max(axis=1, out=out[at // HALF : end // HALF])
    return out


def chunks(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second half of each chunk, and the first chunk of each text: chunk i of
    a text covers its halves i and i + 1; a text of one half is one chunk."""
    per = np.maximum(halves - 1, 1)
    first_half = np.concatenate([[0], np.cumsum(halves)[:-1]])
    first_chunk = np.concatenate([[0], np.cumsum(per)[:-1]])
    a = np.repeat(first_half - first_chunk, per) + np.arange(per.sum())
    b = np.where(np.repeat(halves, per) > 1, a + 1, a)
    return a, b, first_chunk


def score_texts(model: Model, texts: list[bytes], tables=None) -> np.ndarray:
    if not texts:
        return np.empty(0)
    data, halves = padded(texts)
    top = half_maxima(data, tables or model.pairs())
    a, b, first = chunks(halves)
    pooled = np.maximum(top[a], top[b])
    h = np.maximum(pooled @ model.hid + model.hid_b, 0)
    per = np.diff(np.append(first, len(a)))[:, None]
    doc = np.concatenate([np.add.reduceat(h, first, axis=0) / per, np.maximum.reduceat(h, first, axis=0)], axis=1)
    z = doc.astype(np.float64) @ model.out + model.out_b
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(texts: list[bytes], labels: list[int], epochs=EPOCHS, seed=7) -> Model | None:
    """Adam on the cross-entropy; the same rows in the same order give the same model."""
    if not texts:
        return None
    rng = np.random.default_rng(seed)
    y_all = np.array(labels, np.float64)
    p = {
        "conv": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        "hid": rng.normal(0, (2 / FILTERS) ** 0.5, (FILTERS, HIDDEN)).astype(np.float32),
        "hid_b": np.zeros(HIDDEN, np.float32),
        "out": rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32),
        "out_b": np.zeros(1, np.float32),
    }
    # each label has half of the weight
    counts = np.bincount(y_all.astype(int), minlength=2)
    weight = (len(y_all) / (2 * np.maximum(counts, 1)) if counts.all() else np.ones(2)).astype(np.float32)
    epochs = max(epochs, -(-LEAST_STEPS // -(-len(texts) // BATCH)))
    m1, m2, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    total = epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            data, halves = padded([texts[i] for i in pick])
            y = y_all[pick]
            n = len(data) - WIDTH
            model = Model(p["conv"], p["hid"], p["hid_b"], p["out"], 0.0)
            tables = model.pairs()
            # forward, keeping the winning position of each filter in each half
            pair = (data[: n + WIDTH - 1].astype(np.int32) << 8) | data[1 : n + WIDTH]
            conv = tables[0].take(pair[:n], axis=0)
            for k, table in enumerate(tables[1:], 1):
                conv += table.take(pair[2 * k : 2 * k + n], axis=0)
            conv = conv.reshape(-1, HALF, FILTERS)
            win = conv.argmax(axis=1)
            top = np.take_along_axis(conv, win[:, None, :], 1)[:, 0]
            a, b, first = chunks(halves)
            left = top[a] >= top[b]
            pooled = np.where(left, top[a], top[b])
            pre = pooled @ p["hid"] + p["hid_b"]
            h = np.maximum(pre, 0)
            per = np.diff(np.append(first, len(a)))
            mean = np.add.reduceat(h, first, axis=0) / per[:, None]
            high = np.maximum.reduceat(h, first, axis=0)
            doc = np.concatenate([mean, high], axis=1)
            z = doc @ p["out"] + p["out_b"][0]
            dz = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight[y.astype(int)] / len(y)).astype(np.float32)
            # backward
            g = {"out": doc.T @ dz, "out_b": np.array([dz.sum()], np.float32)}
            ddoc = dz[:, None] * p["out"][None, :]
            owner = np.repeat(np.arange(len(per)), per)
            is_high = h == high[owner]
            ties = np.add.reduceat(is_high.astype(np.float32), first, axis=0)
            dh = ddoc[owner, :HIDDEN] / per[owner, None] + is_high * ddoc[owner, HIDDEN:] / ties[owner]
            dpre = dh * (pre > 0)
            g["hid"], g["hid_b"] = pooled.T @ dpre, dpre.sum(axis=0)
            dpool = dpre @ p["hid"].T
            dtop = np.zeros_like(top)
            np.add.at(dtop, a, dpool * left)
            np.add.at(dtop, b, dpool * ~left)
            where = win + np.arange(len(win))[:, None] * HALF
            g["conv"] = np.zeros_like(p["conv"])
            cols = np.broadcast_to(np.arange(FILTERS), where.shape)
            for k in range(WIDTH):
                np.add.at(g["conv"][k], (data[where + k], cols), dtop)
            t += 1
            rate = RATE * (1 - (t - 1) / total)
            for k in p:
                m1[k] += 0.1 * (g[k] - m1[k])
                m2[k] += 0.001 * (g[k] * g[k] - m2[k])
                p[k] = (p[k] - rate * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return Model(p["conv"], p["hid"], p["hid_b"], p["out"], float(p["out_b"][0]))


def sample(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", rows=SAMPLE_ROWS, most_bytes=SAMPLE_BYTES) -> tuple[list[bytes], list[int]]:
    """At most `rows` labelled rows of at most `most_bytes`, by a hash of the id.

    The ids and labels are ranked first, without texts, with room for texts that turn out
    too long; then the texts of those ids alone are brought to the driver."""
    marked = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y")).filter("y in (0, 1) and k is not null")
    marked = marked.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("y2")).filter("y = y2")
    h = F.xxhash64(F.lit("quality"), "k")
    ids = None
    for y in (0, 1):  # two top-k reports, each bounded
        part = marked.filter(F.col("y") == y).select("k", "y").orderBy(h, "k").limit(rows)
        ids = part if ids is None else ids.union(part)
    ids = [(r["k"], r["y"]) for r in ids.collect()]
    if not ids:
        return [], []
    picked = docs.sparkSession.createDataFrame(ids, T.StructType([T.StructField("k", docs.schema[id_col].dataType), T.StructField("y", T.IntegerType())]))
    text = F.coalesce(F.col(text_col), F.lit(""))
    short = docs.select(F.col(id_col).alias("k"), text.alias("text")).filter(F.octet_length("text") <= most_bytes)
    found = short.join(F.broadcast(picked), "k").groupBy("k", "y").agg(F.min("text").alias("text"))
    per = []
    for y in (0, 1):
        per.append([(r["text"], y) for r in found.filter(F.col("y") == y).orderBy(h, "k").limit(rows // 2).collect()])
    # a label that is short of its half leaves the room unused: classes stay as even as they can be
    got = per[0] + per[1]
    return [t.encode("utf-8", "surrogatepass") for t, _ in got], [y for _, y in got]


def scored(docs: DataFrame, model: Model | None, text_col="text", to="score") -> DataFrame:
    """docs with a column `to`: the probability of label 1 of every whole text."""

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series([0.5] * len(texts))
        tables, out, held, size = model.pairs(), [], [], 0
        for t in texts:
            raw = (t or "").encode("utf-8", "surrogatepass")
            held.append(raw)
            size += len(raw)
            if size > 4_000_000:
                out.append(score_texts(model, held, tables))
                held, size = [], 0
        out.append(score_texts(model, held, tables))
        return pd.Series(np.concatenate(out))

    return docs.withColumn(to, probability(F.col(text_col).cast("string")))


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def fitted(docs: DataFrame, labels: DataFrame, **cols) -> Model | None:
    """The model, learnt from labelled rows that are not held out."""
    id_col = cols.get("id_col", "doc_id")
    return train(*sample(docs, labels.filter(~held_out(id_col)), **cols))


def op4_quality(spark, sf_dir):
    """Every document with its probability of quality 1, whether it was held out, and the prediction."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    got = scored(docs.select("doc_id", "text"), model)
    return got.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
