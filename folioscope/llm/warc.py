"""WARC writing, and reading by boundary-chain verification.

Writing: each task writes one file of its pages. Of pages with equal payloads of at least 100 bytes, that with the
least page_id is a response and the others are revisits without a payload.

Reading: files are cut into ranges, a task each. A task finds every ``WARC/1.0`` line of its range, reads the header
there, and so gets the candidate's successor, the offset after its block; chains inside the range are contracted to
their first offset beyond it. Pointer jumping over (file, offset) from offset 0, doubling the jump each round, keeps the
candidates that are reachable from the file's start; one range has at most one such entry, from which a second task
walks the records. The magic inside a payload is never reached. Rounds: log2 of the ranges per file.

Tasks write a new file per attempt; only files named by successful tasks are read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan, skew

MAGIC = b"WARC/1.0\r\n"
RANGE = 8 << 20
#: Revisits are broadcast up to this many (under 100 bytes each in memory); beyond it, the pages are shuffled by page_id.
MOST_REVISITS = 500_000
LEAST = 100  # bytes of a payload from which it is deduplicated
SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")
_CONTROL = re.compile(r"[\x00-\x20\x7f%]")  # written as %XX in a header, and read back from that
_ESCAPED = re.compile(r"%([0-9A-F]{2})")


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    number = "" if page_id is None else str(page_id)
    block = _HTTP % len(payload) + (payload if refers is None else b"")
    lines = [
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{number}:{digest}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Page-ID: {number}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers}:{digest}')}>")
        lines.append(f"WARC-Refers-To-Page-ID: {refers}")
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return MAGIC + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, key, refers_to) of the pages that revisit another; key is 64 bits of the digest, for pages of one id.

    Narrow: payloads are hashed where they are read.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    meta = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("bytes"))
    meta = scan.checkpointed(meta.where(F.col("bytes") >= least).drop("bytes"))
    first = meta.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1")
    found = skew.lookup(meta, scan.checkpointed(first), ["digest"], "copies", meta.count())
    return found.where(F.col("refers_to").isNotNull() & ~F.col("refers_to").eqNullSafe(F.col("page_id"))).select("page_id", F.xxhash64("digest").alias("key"), "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Writes a record per row and returns the manifest: file, size, records.

    Null html is an empty payload; a null page_id is written as an empty field and refers to nothing smaller. Repeated rows
    are a record each; rows that repeat the least page_id of their payload are all responses. Extra columns are dropped. An
    empty table writes no file.
    """
    folder = folder or scan.shared_dir(pages.sparkSession, "warc")
    again = scan.checkpointed(revisits(pages, least))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    side = again.select(F.coalesce("page_id", F.lit(0)).alias("_p"), F.col("page_id").isNull().alias("_n"), F.col("key").alias("_k"), "refers_to")
    side = F.broadcast(side) if again.count() <= MOST_REVISITS else side
    same = (F.coalesce(F.col("page_id"), F.lit(0)) == F.col("_p")) & (F.col("page_id").isNull() == F.col("_n")) & (F.xxhash64("digest") == F.col("_k"))
    rows = rows.join(side, same, "left")
    rows = rows.select("page_id", "url", "html", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = scan.filesystem(folder)
        fs.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.warc"
        stream, size, number = None, 0, 0
        for batch in batches:
            payloads = batch.column(2).cast(pa.binary()).to_pylist()
            columns = [batch.column(k).to_pylist() for k in (0, 1, 3, 4)]
            for page_id, url, digest, refers, payload in zip(*columns, payloads):
                stream = stream or fs.open_output_stream(f"{path}/{name}")
                record = _record(page_id, url, payload, digest, refers)
                stream.write(record)
                size, number = size + len(record), number + 1
        if stream is not None:
            stream.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "size": [size], "records": [number]})

    scan.small_batches(rows.sparkSession)
    return scan.checkpointed(rows.mapInArrow(write, "file string, size long, records long"))


class _Range:
    """Bytes of a file from ``lo``; grows when a header or block reaches further."""

    def __init__(self, file: str, lo: int, hi: int) -> None:
        fs, path = scan.filesystem(file)
        self.f = fs.open_input_file(path)
        self.size, self.lo = self.f.size(), lo
        self.data = self.f.read_at(min(self.size, hi + len(MAGIC) - 1) - lo, lo)

    def upto(self, end: int) -> bool:
        """Whether the file has bytes up to ``end``; reads them."""
        if end > self.size:
            return False
        have = self.lo + len(self.data)
        if end > have:
            self.data += self.f.read_at(min(self.size, max(end, have + (64 << 10))) - have, have)
        return True

    def header(self, at: int) -> tuple[bytes, int, int] | None:
        """(header, offset of the block, offset of the next record), or None if no whole header begins here."""
        k = at - self.lo
        if not self.data.startswith(MAGIC, k):
            return None
        end, seen = self.data.find(b"\r\n\r\n", k), k
        while end < 0:
            have = self.lo + len(self.data)
            seen = max(k, len(self.data) - 3)
            if have >= self.size or not self.upto(min(self.size, have + (64 << 10))):
                return None
            end = self.data.find(b"\r\n\r\n", seen)
        head = self.data[k : end + 2]
        if not (m := _LENGTH.search(head)):
            return None
        block = self.lo + end + 4
        after = block + int(m[1]) + 4
        return (head, block, after) if after <= self.size else None


def _exits(file: str, lo: int, hi: int) -> list[tuple[int, int]]:
    """(candidate, first offset at or beyond ``hi`` on its chain) for the candidates of a range."""
    r = _Range(file, lo, hi)
    found = []
    k = r.data.find(MAGIC)
    while 0 <= k < hi - lo:
        found.append(lo + k)
        k = r.data.find(MAGIC, k + 1)
    leave: dict[int, int] = {}
    for at in reversed(found):
        h = r.header(at)
        if h and (to := h[2] if h[2] >= hi else leave.get(h[2], -1)) >= 0:
            leave[at] = to
    return list(leave.items())


def _walk(file: str, at: int, hi: int) -> Iterator[tuple]:
    """The records from a reachable offset up to the end of its range."""
    r = _Range(file, at, hi)
    while at < min(hi, r.size):
        h = r.header(at)
        if h is None:
            raise ValueError(f"{file}: no record at {at}")
        head, block, after = h
        r.upto(after)
        body = r.data[block - r.lo : after - 4 - r.lo]
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
        payload = body[body.find(b"\r\n\r\n") + 4 :]
        digest, number, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["WARC-Payload-Length"]), fields["WARC-Type"]
        if kind == "response" and (len(payload) != number or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"{file}: payload at {at} does not match its digest")
        page = fields["WARC-Page-ID"]
        refers = fields.get("WARC-Refers-To-Page-ID")
        url = fields.get("WARC-Target-URI")
        yield int(page) if page else None, None if url is None else _ESCAPED.sub(lambda m: chr(int(m[1], 16)), url), number, digest, kind, int(refers) if refers else None
        at = after


def _ranges(manifest: DataFrame, width: int) -> DataFrame:
    return manifest.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(width).cast("long"))).alias("lo"))


def read_archives(manifest: DataFrame, width: int = RANGE) -> DataFrame:
    """One row per record of the files of ``manifest`` (file, size), the payloads checked against their digests.

    Page ids, urls and payload sizes come back as they were written, nulls included. A file whose chain of records from
    offset 0 breaks before its end is an error.
    """

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [(file, lo, at, to) for file, lo in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for at, to in _exits(file, lo, lo + width)]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=["file", "lo", "at", "to"])

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [x for file, at, lo in zip(*(batch.column(k).to_pylist() for k in range(3))) for x in _walk(file, at, lo + width)]
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], names=[c.split()[0] for c in SCHEMA.split(", ")])

    ranges = scan.checkpointed(_ranges(manifest, width))
    n, most = ranges.count(), (manifest.agg(F.max("size")).first()[0] or 0) // width + 1
    # one range a task: the ranges are numbered evenly over the tasks
    spread = ranges.repartitionByRange(max(1, min(n, 20_000)), "file", "lo")
    jump = scan.checkpointed(scan.map_arrow(spread, find, "file string, lo long, at long, to long").select("file", "at", "to"))
    reach = manifest.select("file", F.lit(0).cast("long").alias("at"))
    for k in range(int(most).bit_length()):
        if k:
            after = jump.select("file", F.col("at").alias("to"), F.col("to").alias("then"))
            jump = scan.checkpointed(jump.join(after, ["file", "to"]).select("file", "at", F.col("then").alias("to")))
        reach = scan.checkpointed(reach.union(reach.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))).distinct())
    entries = reach.join(manifest.select("file", "size"), "file").where("at < size").drop("size")
    entries = entries.withColumn("lo", (F.floor(F.col("at") / width) * width).cast("long"))
    return scan.map_arrow(entries.repartitionByRange(max(1, min(n, 20_000)), "file", "lo").select("file", "at", "lo"), read, SCHEMA)


SQL = """
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to, url
FROM f
"""
