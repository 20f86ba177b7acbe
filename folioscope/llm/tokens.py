r"""Token-ID output: byte-level BPE ids in Simple-8b files.

Tokenising: the BPE's splitting rule is applied to whole buffers with NumPy; the library encodes each distinct piece
once per worker and the ids are gathered by the piece's hash. Texts with characters outside the classes known here, or
with the string of an added token, are encoded whole by the library, so ids always equal the library's.

Files: documents in ascending doc_id order (nulls first, ties by text hash), range-partitioned, one file each. A file
has the blocks of ids, then the block offsets, then doc_ids, and ids per document. A task writes a new file per
attempt and returns its name; only files named by successful tasks are read, so lost executors do no harm.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scan, simple8b

MAGIC = b"FSTOK1\n\0"
_FOOT = struct.Struct("<qqqq")
_SAFE = 0x250
_LETTER, _NUMBER, _OTHER, _WHITE, _UNKNOWN = 1, 2, 0, 3, 9


def _classes() -> np.ndarray:
    import unicodedata

    out = np.full(_SAFE, _OTHER, np.int8)
    for k in range(_SAFE):
        kind = unicodedata.category(chr(k))
        if chr(k).isspace() and k not in (0x1C, 0x1D, 0x1E, 0x1F):
            out[k] = _WHITE
        elif kind[0] == "L":
            out[k] = _LETTER
        elif kind[0] == "N":
            out[k] = _NUMBER
    return out


_CLASS = _classes()


def pieces(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""Byte starts of the pieces of all texts, their number before each text, and texts with unknown characters.

    The rule: ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``.
    """
    point = (data & 0xC0) != 0x80
    byte = np.flatnonzero(point)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(cp)
    edges = np.searchsorted(byte, offs)  # each text's first character
    odd = cp >= _SAFE
    unknown = scan.per_text(odd, edges) > 0
    g = _CLASS[np.where(odd, 0, cp)]
    begin = np.zeros(n + 1, bool)
    begin[edges] = True
    start = begin[:n].copy()
    start[1:] |= g[1:] != g[:-1]
    # white space before something else: its last character stands alone, or goes with it if it is a space
    last = np.zeros(n, bool)
    last[:-1] = (g[:-1] == _WHITE) & (g[1:] != _WHITE) & ~begin[1:n]
    end = np.flatnonzero(last)
    start[end] = True
    start[end + 1] = cp[end] != 32
    # contractions: an apostrophe that begins a piece
    q = np.flatnonzero(start & (cp == 39))
    if len(q):
        stop = edges[np.searchsorted(edges, q, "right")]
        ahead = lambda k: np.where(q + k < stop, cp[np.minimum(q + k, n - 1)], 0)
        a, b = ahead(1), ahead(2)
        one = np.isin(a, [ord(x) for x in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        size = np.where(one, 2, np.where(two, 3, 0))
        q, size, stop = q[size > 0], size[size > 0], stop[size > 0]
        start[q + 1] = False
        start[q[size == 3] + 2] = False
        after = q + size
        start[after[after < stop]] = True
    at = np.flatnonzero(start)
    return byte[at], np.searchsorted(at, edges), unknown


class Encoder:
    """Ids of texts; remembers the ids of up to ``most`` distinct pieces."""

    def __init__(self, path: str, most: int = 2_000_000) -> None:
        # a task has one core; threads of the library would only add memory
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _library(self, batch: list[str]) -> list[list[int]]:
        # few at a time: the library's results hold far more than the ids
        return [e.ids for k in range(0, len(batch), 1024) for e in self.tokenizer.encode_batch_fast(batch[k : k + 1024], add_special_tokens=False)]

    def _with_added(self, raw: bytes, offs: np.ndarray) -> np.ndarray:
        """Texts that hold the string of an added token, which no piece shows."""
        out = np.zeros(len(offs) - 1, bool)
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                k = int(np.searchsorted(offs, at, "right")) - 1
                inside = at + len(token) <= offs[k + 1]
                out[k] |= inside
                at = raw.find(token, int(offs[k + 1]) if inside else at + 1)
        return out

    def _learn(self, key: np.ndarray, strings: list[str]) -> None:
        found = self._library(strings)
        count = np.fromiter(map(len, found), np.int32, len(found))
        begin = np.cumsum(count) - count + len(self.ids)
        flat = np.fromiter((x for ids in found for x in ids), np.uint32, int(count.sum()))
        self.ids = np.concatenate([self.ids, flat])
        at = np.searchsorted(self.keys, key)
        self.keys, self.begin, self.count = np.insert(self.keys, at, key), np.insert(self.begin, at, begin), np.insert(self.count, at, count)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a buffer and the number of ids of each."""
        rows = len(offs) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
        start, bounds, unknown = pieces(data, offs)
        unknown |= self._with_added(data.tobytes(), offs)
        end = np.append(start[1:], len(data))
        if unknown.any():
            known = np.repeat(~unknown, np.diff(bounds))
            start, end = start[known], end[known]
            bounds = np.concatenate([[0], np.cumsum(np.where(unknown, 0, np.diff(bounds)))])
        h = scan.span_hash(scan.prefix_sums(data), start, end)
        distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self._clear()
        at = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != distinct[inside]
        if new.any():
            raw = data.tobytes()
            self._learn(distinct[new], [raw[a:b].decode() for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            at = np.searchsorted(self.keys, distinct)
        at = at[back]
        size = self.count[at].astype(np.int64)
        total = np.cumsum(size)
        where = np.repeat(self.begin[at] - (total - size), size) + np.arange(total[-1] if len(total) else 0)
        ids = self.ids[where]
        number = scan.per_text(size, bounds)
        if unknown.any():
            raw = data.tobytes()
            rest = np.flatnonzero(unknown)
            whole = self._library([raw[offs[k] : offs[k + 1]].decode() for k in rest])
            cuts = np.concatenate([[0], np.cumsum(number)])
            parts: list[np.ndarray] = []
            done = 0
            for k, x in zip(rest, whole):
                parts += [ids[cuts[done] : cuts[k]], np.array(x, np.uint32)]
                done = k
                number[k] = len(x)
            ids = np.concatenate([*parts, ids[cuts[done] :]])
        return ids, number


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    """The byte-level BPE file of the installed public tokenizers; other files are passed by path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def with_end(ids: np.ndarray, number: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(number), end_id), number + 1


class Writer:
    """Writes ids as they come; keeps only block offsets and the document index."""

    def __init__(self, stream) -> None:
        self.stream, self.words = stream, 0
        self.rest = np.zeros(0, np.uint32)
        self.offsets: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        stream.write(MAGIC)

    def add(self, doc_ids: np.ndarray, ids: np.ndarray, number: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.counts.append(number)
        ids = np.concatenate([self.rest, ids])
        full = len(ids) // simple8b.BLOCK * simple8b.BLOCK
        self._write(ids[:full])
        self.rest = ids[full:]

    def _write(self, ids: np.ndarray) -> None:
        words, offsets = simple8b.encode(ids)
        self.stream.write(words.astype("<u8").tobytes())
        self.offsets.append(offsets[:-1] + self.words)
        self.words += len(words)

    def close(self) -> tuple[int, int]:
        self._write(self.rest)
        counts = np.concatenate(self.counts or [np.zeros(0, np.int64)])
        offsets = np.concatenate([*self.offsets, [self.words]])
        docs = np.concatenate(self.docs or [np.zeros(0, np.int64)])
        for x in (offsets, docs, counts):
            self.stream.write(x.astype("<i8").tobytes())
        self.stream.write(_FOOT.pack(self.words, len(offsets) - 1, len(docs), int(counts.sum())))
        self.stream.close()
        return len(docs), int(counts.sum())


def read_file(fs, path: str, blocks: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, ids, ids per document) of consecutive whole documents of a file."""
    with fs.open_input_file(path) as f:
        size = f.size()
        if f.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path}: not a token file")
        words, count, docs, total = _FOOT.unpack(f.read_at(_FOOT.size, size - _FOOT.size))
        at = len(MAGIC) + 8 * words
        index = np.frombuffer(f.read_at(8 * (count + 1 + 2 * docs), at), "<i8")
        offsets, doc_ids, number = index[: count + 1], index[count + 1 : count + 1 + docs], index[count + 1 + docs :]
        ends = np.cumsum(number)
        rest, done, read = np.zeros(0, np.uint32), 0, 0
        for lo in range(0, count, blocks):
            hi = min(count, lo + blocks)
            n = min(total, hi * simple8b.BLOCK) - lo * simple8b.BLOCK
            raw = np.frombuffer(f.read_at(8 * int(offsets[hi] - offsets[lo]), len(MAGIC) + 8 * int(offsets[lo])), "<u8")
            rest = np.concatenate([rest, simple8b.decode(raw, offsets[lo : hi + 1] - offsets[lo], n).astype(np.uint32)])
            read += n
            upto = int(np.searchsorted(ends, read, "right"))
            if upto > done:
                m = int(ends[upto - 1] - (ends[done - 1] if done else 0))
                yield doc_ids[done:upto], rest[:m], number[done:upto]
                rest, done = rest[m:], upto


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Writes all documents' ids and returns the manifest: part, file, n_docs, n_ids, base (ids in parts before).

    Null texts are empty: they have the end id only. A null doc_id is stored as the least 64-bit number.
    """
    spark = docs.sparkSession
    folder = folder or scan.shared_dir(spark, "tokens")
    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    names = ["part", "file", "n_docs", "n_ids"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = scan.filesystem(folder)
        fs.create_dir(path, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
        writer, enc = None, encoder(tokenizer)
        for batch in batches:
            doc_ids = batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
            for lo, hi in scan.slices(batch.column(1)):
                if writer is None:
                    writer = Writer(fs.open_output_stream(f"{path}/{name}"))
                ids, number = with_end(*enc.encode(*scan.texts(batch.column(1), lo, hi)), end_id)
                writer.add(doc_ids[lo:hi], ids, number)
            scan.trim()
        if writer is not None:
            yield pa.RecordBatch.from_pydict(dict(zip(names, ([x] for x in (part, name, *writer.close())))))

    scan.small_batches(spark)
    manifest = scan.checkpointed(rows.mapInArrow(write, "part long, file string, n_docs long, n_ids long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("file", F.concat(F.lit(folder + "/"), "file")).withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fs, path = scan.filesystem(file)
            for doc_ids, ids, number in read_file(fs, path):
                raw = memoryview(ids.astype("<u4").tobytes())
                end = np.cumsum(number)
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((end - number).tolist(), end.tolist())]
                out.append((doc_ids, base + end - number, number, np.array(crc, np.int64)))
                base += int(end[-1])
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        null = columns[0] == np.iinfo(np.int64).min
        return pa.RecordBatch.from_arrays([pa.array(columns[0], mask=null), *map(pa.array, columns[1:])], names=names)

    files = manifest.select("file", "base", "part")
    spread = files.repartitionByRange(max(1, files.count()), "part").select("file", "base")
    return scan.map_arrow(spread, read, "doc_id long, start long, n_tokens long, ids_crc32 long")
