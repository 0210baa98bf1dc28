"""Seekable Zstandard bundles of WARC records.

Records are gathered in frames that decompress on their own. A bundle ends with two
skippable frames, which any Zstandard reader passes over: an index that maps record
identifiers to (frame, offset in the frame, length), and the seek table of the seekable
format (sizes of all frames). One record is read by its seek-table entry and one frame.

Records with equal payloads of at least `least_bytes` bytes are told by SHA-1 and length.
That with the smallest page id is the response, the others are revisits of it. Digests
are grouped without payloads, and only groups of two or more reach the join; those are
broadcast if they are few by count, else adaptive execution splits a hot digest.

Defined results: a null payload is empty; payloads of any length are one record, held whole
while it is written or read; a null URL is empty; rows that share the smallest page id of their
group are all responses; null page ids are never the smallest unless a group has no
other; an empty table gives no bundles."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import open_at
from .common import held, new_path, scratch, small, text_batches, written

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 1 << 27, 3
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: Pages that go to a Python worker at once.
PAGE_ROWS = 200
#: All records carry the same date, so that equal inputs give equal bundles.
DATE = "1970-01-01T00:00:00Z"


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}|{digest}'.encode()).digest())}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record; digest is bare base32."""
    kind = "revisit" if revisit else "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + "".join((url or "").split("\r")).replace("\n", ""),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        f"WARC-Page-ID: {json.dumps(page_id)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"WARC-Refers-To-Page: {json.dumps(refers_to)}",
        ]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at `at`, and where the next begins."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    n = int(headers["Content-Length"])
    return headers, raw[end + 4 : end + 4 + n], end + 8 + n


class Bundle:
    """Writes one bundle: holds one frame, the index and the frame sizes."""

    def __init__(self, sink):
        import zstandard

        self.sink, self.zstd = sink, zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.held, self.n_held, self.sizes, self.index, self.bytes = [], 0, [], [], 0

    def add(self, rid: str, raw: bytes) -> None:
        self.index.append((rid, len(self.sizes), self.n_held, len(raw)))
        self.held.append(raw)
        self.n_held += len(raw)
        if self.n_held >= FRAME_BYTES:
            self._frame()

    def _frame(self) -> None:
        if self.held:
            out = self.zstd.compress(b"".join(self.held))
            self.sink.write(out)
            self.sizes.append((len(out), self.n_held))
            self.bytes += len(out)
            self.held, self.n_held = [], 0

    def close(self) -> None:
        self._frame()
        index = self.zstd.compress(json.dumps(self.index).encode())
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        self.sizes.append((len(index) + 8, 0))
        table = b"".join(struct.pack("<II", c, d) for c, d in self.sizes)
        foot = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(foot)) + table + foot)


class BundleReader:
    def __init__(self, source):
        import zstandard

        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        size = source.size()
        n, _, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        table = self._read(size - 9 - 8 * n, 8 * n)
        self.frames, at = [], 0
        for k in range(n):
            c, d = struct.unpack_from("<II", table, 8 * k)
            self.frames.append((at, c, d))
            at += c

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def frame(self, k: int) -> bytes:
        at, c, d = self.frames[k]
        return self.zstd.decompress(self._read(at, c), max_output_size=d) if d else b""

    def index(self) -> dict[str, tuple[int, int, int]]:
        at, c, _ = self.frames[-1]
        return {r: (f, o, n) for r, f, o, n in json.loads(self.zstd.decompress(self._read(at + 8, c - 8)))}

    def record(self, rid: str) -> tuple[dict[str, str], bytes]:
        frame, offset, _ = self.index()[rid]
        return parse(self.frame(frame), offset)[:2]

    def records(self):
        for k in range(len(self.frames)):
            raw, at = self.frame(k), 0
            while at < len(raw):
                headers, block, at = parse(raw, at)
                yield headers, block


def decided(pages: DataFrame, least_bytes: int = 0, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """page_id, url, html, digest (hex), first: the response's page id where a group has one."""
    body = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("bytes", F.octet_length("html"))
    groups = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = written(groups.filter("n > 1").select("digest", "bytes", "first"), "payloads")
    return rows.join(small(groups), ["digest", "bytes"], "left").select("page_id", "url", "html", "digest", "first")


def write_bundles(rows: DataFrame, folder: str) -> DataFrame:
    """Writes bundles of at most about BUNDLE_BYTES; returns the manifest: path, n_records."""

    def run(batches):
        bundle = sink = None
        done: list[tuple[str, int]] = []

        def close():
            bundle.close()
            sink.close()
            done.append((path, len(bundle.index)))

        for b in batches:
            for page_id, url, html, digest, first in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "first")], strict=True):
                if bundle is None:
                    where, at = open_at(folder)
                    where.create_dir(at, recursive=True)
                    path = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
                    sink = where.open_output_stream(open_at(path)[1], compression=None)
                    bundle = Bundle(sink)
                base32 = base64.b32encode(bytes.fromhex(digest)).decode()
                bundle.add(record_id(page_id, base32), record(page_id, url, html, base32, first, first is not None and first != page_id))
                if bundle.bytes >= BUNDLE_BYTES:
                    close()
                    bundle = None
        if bundle is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "n_records"])

    with text_batches(rows.sparkSession, PAGE_ROWS):
        return written(rows.mapInArrow(run, "path string, n_records bigint"), "bundles")


def read_bundles(manifest: DataFrame, id_type: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record.

    Payloads of responses are measured and digested again; a difference is an error."""

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                where, at = open_at(path)
                with where.open_input_file(at) as source:
                    out: list[tuple] = []
                    for h, block in BundleReader(source).records():
                        digest, n = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["WARC-Payload-Length"])
                        if h["WARC-Type"] == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            if len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                                raise ValueError(f"{path}: a payload does not match its digest")
                        refers = h.get("WARC-Refers-To-Page")
                        out.append((json.loads(h["WARC-Page-ID"]), n, digest, h["WARC-Type"], None if refers is None else json.loads(refers)))
                        if len(out) == 4096:
                            yield batch(out)
                            out = []
                    if out:
                        yield batch(out)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def batch(rows):
        # types follow the declared schema when all values of a column are null
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
        own = kinds.get(id_type, pa.string())
        types = [own, pa.int64(), pa.string(), pa.string(), own]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    n = max(1, min(10_000, manifest.count()))
    return manifest.repartition(n, F.col("path")).select("path").mapInArrow(
        run, f"page_id {id_type}, payload_bytes bigint, payload_digest string, record_type string, refers_to {id_type}"
    )


def op10_warc(spark, sf_dir):
    """Every page as read back from the bundles it was written to."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    with scratch() as keep:
        folder = new_path(spark, "warc")
        manifest = write_bundles(decided(pages), folder)
        keep(manifest)
    held(spark, folder)
    return read_bundles(manifest, pages.schema["page_id"].dataType.simpleString())


ORACLE = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (
  SELECT html, min(page_id) AS first FROM p GROUP BY html),
x AS (
  SELECT p.page_id, strlen(p.html) AS payload_bytes, sha1(p.html) AS hex, first FROM p JOIN g ON p.html = g.html),
b AS (
  SELECT page_id, payload_bytes, first, list_reduce(
    list_prepend('', list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      (('0x' || substr(hex || '0', CAST((i * 5) // 4 AS INT) + 1, 2))::INT >> (8 - (i * 5) % 4 - 5)) & 31 AS INT), 1))),
    lambda a, c: a || c) AS payload_digest FROM x)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM b
"""
