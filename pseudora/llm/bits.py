"""Token-id files: fixed-width bit packing with block offsets.

A shard holds ids packed in the fewest bits that the vocabulary needs, least significant
bit first, in blocks of BLOCK ids. Layout, all integers little-endian:

    blocks     each ceil(ids * width / 64) words of 64 bits
    index      offset of each block, and of the end: uint64[blocks + 1]
               per document: id int64, whether the id is null uint8, first token uint64,
               with the end of the last: uint64[documents + 1]
    footer     width uint32, ids in a block uint32, blocks, documents, ids, offset of the
               index: uint64 each, magic PSBITS01

Any document is read by its first token: block = first // BLOCK, then numpy shifts unpack
64 ids at a time. Shards are written by tasks straight to the shared folder under names of
their own; only shards named in the committed manifest count, so repeated or lost tasks
leave nothing that is read.

Defined results: null and empty texts have the end id alone; texts of any length are written
whole, one text's ids in memory at a time; null document ids come first; rows equal in id are
ordered by a hash of their text; repeated rows are written as often as they stand; an empty
table gives no shards; an id that the width cannot hold is an error, not another id."""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held, new_path, scratch, text_batches, written
from .tokens import encoder, public

TOKENIZER, END = "byte_bpe_50k.json", 2
BLOCK = 1 << 16
MAGIC = b"PSBITS01"
FOOTER = "<IIQQQQ8s"


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Lanes of 64 ids fill `width` words; each lane is shifted into place at once."""
    lanes = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(lanes), width), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[:, word] |= lanes[:, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= lanes[:, i] >> np.uint64(64 - shift)
    return out.astype("<u8").tobytes()[: -(-len(ids) * width // 64) * 8]


def unpack(raw: bytes, n: int, width: int) -> np.ndarray:
    rows = -(-n // 64)
    words = np.zeros(rows * width, np.uint64)
    got = np.frombuffer(raw, "<u8")
    words[: len(got)] = got
    words = words.reshape(rows, width)
    out = np.empty((rows, 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        x = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, i] = x & mask
    return out.reshape(-1)[:n]


class Writer:
    """Streams documents into one shard; holds one block and the index."""

    def __init__(self, sink, width: int, block: int = BLOCK):
        self.sink, self.width, self.block = sink, width, block
        self.held, self.n_held, self.at, self.n = [], 0, 0, 0
        self.offsets, self.ids, self.nulls, self.firsts = [0], [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.firsts.append(self.n)
        self.n += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            all_ = np.concatenate(self.held)
            whole = len(all_) // self.block * self.block
            for k in range(0, whole, self.block):
                self._put(all_[k : k + self.block])
            self.held, self.n_held = [all_[whole:]], len(all_) - whole

    def _put(self, ids: np.ndarray) -> None:
        if int(ids.max()) >> self.width:
            raise ValueError(f"token id {int(ids.max())} does not fit {self.width} bits")
        raw = pack(ids, self.width)
        self.sink.write(raw)
        self.at += len(raw)
        self.offsets.append(self.at)

    def close(self) -> None:
        if self.n_held:
            self._put(np.concatenate(self.held))
        self.sink.write(np.array(self.offsets, "<u8").tobytes())
        self.sink.write(np.array(self.ids, "<i8").tobytes())
        self.sink.write(np.array(self.nulls, np.uint8).tobytes())
        self.sink.write(np.array([*self.firsts, self.n], "<u8").tobytes())
        self.sink.write(struct.pack(FOOTER, self.width, self.block, len(self.offsets) - 1, len(self.ids), self.n, self.at, MAGIC))


class Reader:
    """Random access to a shard: ids(i) of its i-th document, block by block."""

    def __init__(self, source):
        self.source = source
        size, tail = source.size(), struct.calcsize(FOOTER)
        self.width, self.block, blocks, docs, self.n, at, magic = struct.unpack(FOOTER, self._read(size - tail, tail))
        if magic != MAGIC:
            raise ValueError("not a token-id shard")
        raw = self._read(at, size - tail - at)
        self.offsets = np.frombuffer(raw, "<u8", blocks + 1)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, 8 * (blocks + 1))
        self.nulls = np.frombuffer(raw, np.uint8, docs, 8 * (blocks + 1 + docs))
        self.firsts = np.frombuffer(raw, "<u8", docs + 1, 8 * (blocks + 1 + docs) + docs).astype(np.int64)
        self.held = (-1, np.empty(0, np.uint32))

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _block(self, k: int) -> np.ndarray:
        if self.held[0] != k:
            lo, hi = int(self.offsets[k]), int(self.offsets[k + 1])
            self.held = (k, unpack(self._read(lo, hi - lo), min(self.block, self.n - k * self.block), self.width))
        return self.held[1]

    def ids(self, i: int) -> np.ndarray:
        lo, hi = int(self.firsts[i]), int(self.firsts[i + 1])
        parts = [self._block(k)[max(0, lo - k * self.block) : hi - k * self.block] for k in range(lo // self.block, -(-hi // self.block))]
        return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, np.uint32), *parts])


def open_at(path: str):
    """The pyarrow file system and path of a URI as Spark has it; new_path() gives a scheme."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme in ("s3a", "s3n"):
        path = f"s3:{rest}"
    elif scheme == "dbfs":  # mounted on every node
        path = f"file:///dbfs/{rest.lstrip('/')}"
    elif scheme == "file":
        path = f"file:///{rest.lstrip('/')}"
    elif path.startswith("/"):
        raise ValueError(f"{path}: which file system? Give a scheme, as new_path() does")
    return fs.FileSystem.from_uri(path)


def vocabulary_of(tokenizer: str) -> int:
    """Ids of a tokenizer file, added tokens included."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer).get_vocab().values()) + 1


def write_shards(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int | None = None, end=END, id_col="doc_id", text_col="text", shards: int | None = None, specials=False) -> DataFrame:
    """Writes whole texts in ascending id order; returns the manifest: shard, path,
    n_docs, n_tokens, start (ids in all shards before). One shuffle, of the texts."""
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = width_of(max(vocabulary or vocabulary_of(tokenizer), end + 1))

    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        enc, writer, last = encoder(tokenizer, specials=specials), None, struct.pack("<I", end)
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.bits"
        for b in batches:
            if writer is None and b.num_rows:
                where, at = open_at(folder)
                where.create_dir(at, recursive=True)
                sink = where.open_output_stream(open_at(path)[1], compression=None)
                writer = Writer(sink, width)
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.stream(t.as_py() for t in b.column(1)), strict=True):
                writer.add(doc_id, np.frombuffer(ids + last, "<u4"))
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([path]), pa.array([len(writer.ids)], pa.int64()), pa.array([writer.n], pa.int64())],
                names=["shard", "path", "n_docs", "n_tokens"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # equal ids are ordered, and may be parted, by a hash of their text
    order = ["doc_id", F.xxhash64("text")]
    made = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(run, "shard int, path string, n_docs bigint, n_tokens bigint")
    with text_batches(spark):
        made = written(made, "manifest")
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # one row a shard
    return written(made.withColumn("start", F.coalesce(before, F.lit(0)).cast("bigint")), "manifest", rows=n)


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shards, a task a shard."""

    def run(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                where, at = open_at(path)
                with where.open_input_file(at) as source:
                    r = Reader(source)
                    docs = len(r.doc_ids)
                    for lo in range(0, docs, 4096):
                        hi = min(docs, lo + 4096)
                        crc = [zlib.crc32(r.ids(i).astype("<u4", copy=False)) for i in range(lo, hi)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(r.doc_ids[lo:hi], mask=r.nulls[lo:hi].astype(bool)),
                                pa.array(r.firsts[lo:hi] + start),
                                pa.array(np.diff(r.firsts[lo : hi + 1])),
                                pa.array(crc, pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    n = max(1, manifest.count())
    return manifest.repartition(n, F.col("shard")).select("path", "start").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op9_token_ids(spark, sf_dir):
    """Every document's place and checksum, read back from the shards that were written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch() as keep:
        folder = new_path(spark, "tokens")
        manifest = write_shards(docs, folder, public(TOKENIZER), specials=True)
        keep(manifest)
        got = read_shards(manifest)
    held(spark, folder)
    return got
