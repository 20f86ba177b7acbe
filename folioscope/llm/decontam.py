r"""Benchmark decontamination by Wu-Manber search over words.

Words are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z. The patterns are the windows of 13
consecutive words of the items (an item of 1 to 12 words is one window). Windows of one length m form one table:
a block of two words (one if m = 1) hashes to a shift, the least distance from the block to the end of any
window that holds it; where the shift is 0 the block's bucket lists the windows that end so, a second hash of
their first words selects, then the codes of all m words, and comparing the words themselves, byte by byte, confirms.
Texts are cut into lanes of end positions that advance in lockstep, so that one NumPy step moves thousands of positions.

The benchmark is written to the shared folder in blocks of bounded size; each task loads a block at a time, so
nothing that grows is broadcast. Null or wordless texts and items match nothing. Repeated items all count.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan

SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
WINDOW = 13
LANE = 256
#: Bytes of text of a benchmark block (its tables take about 40 bytes a byte), of a slice of texts, and
#: slices in a group, and blocks that a worker keeps.
BLOCK, SLICE, GROUP, KEPT = 2 << 20, 1 << 19, 32, 4
_K = np.uint64(0x9E3779B97F4A7C15)
_PREFIX = np.uint64(0xC2B2AE3D27D4EB4F)


class Table:
    """Shift table, suffix buckets and windows of one length: rows of search codes, one code a word."""

    def __init__(self, windows: np.ndarray) -> None:
        count, self.m = windows.shape
        self.block = min(2, self.m)
        self.bits = int(min(22, max(12, 2 + (count * self.m).bit_length())))
        self.shift = np.full(1 << self.bits, self.m - self.block + 1, np.int64)
        for end in range(self.block, self.m + 1):
            np.minimum.at(self.shift, self._slot(windows, end - 1), self.m - end)
        slot = self._slot(windows, self.m - 1)
        self.order = np.argsort(slot, kind="stable")  # the row of ``windows`` at each place of the buckets
        self.windows, slot = windows[self.order], slot[self.order]
        self.prefix = self._prefix(self.windows[:, 0], self.windows[:, min(1, self.m - 1)])
        self.bucket = np.searchsorted(slot, np.arange((1 << self.bits) + 1))

    def _mixed(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        return ((last.astype(np.uint64) * _PREFIX + before.astype(np.uint64)) * _K) >> np.uint64(64 - self.bits)

    def _slot(self, windows: np.ndarray, at: int) -> np.ndarray:
        return self._mixed(windows[:, at], windows[:, at - 1] if self.block == 2 else windows[:, at]).astype(np.int64)

    def _prefix(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return (first.astype(np.uint64) * _K + second.astype(np.uint64)) * _PREFIX

    def search(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, start) of every window whose codes occur; ``bounds`` are those of the texts in ``ids``."""
        m = self.m
        first = bounds[:-1] + m - 1  # the first possible end position of each text
        span = np.maximum(bounds[1:] - first, 0)
        lanes = (span + LANE - 1) // LANE
        of = np.repeat(np.arange(len(span)), lanes)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        pos = first[of] + nth * LANE
        stop = np.minimum(pos + LANE, bounds[1:][of])
        previous = ids if self.block == 1 else np.concatenate([ids[:1], ids[:-1]])
        slots = self._mixed(ids, previous).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
        ends = []
        while len(pos):
            step = self.shift[slots[pos]]
            zero = step == 0
            if zero.any():
                ends.append(pos[zero])
            pos = pos + np.maximum(step, 1)
            live = pos < stop
            pos, stop = pos[live], stop[live]
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        end = np.concatenate(ends)
        low, high = self.bucket[slots[end]], self.bucket[slots[end] + 1]
        start = end - m + 1
        mine = self._prefix(ids[start], ids[start + min(1, m - 1)])
        found_w, found_s = [], []
        k = 0
        while True:  # one candidate window of each bucket at a time
            live = low + k < high
            if not live.any():
                break
            low, high, start, mine = low[live], high[live], start[live], mine[live]
            w, s = low + k, start
            same = self.prefix[w] == mine
            w, s = w[same], s[same]
            if len(w):
                equal = (self.windows[w] == ids[s[:, None] + np.arange(m)]).all(axis=1)
                found_w.append(w[equal])
                found_s.append(s[equal])
            k += 1
        if not found_w:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return self.order[np.concatenate(found_w)], np.concatenate(found_s)


class Words(NamedTuple):
    """The words of a buffer: its bytes with A-Z folded, where the words stand, their hashes, bounds of the texts."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    h: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offs: np.ndarray) -> Words:
        starts, ends, bounds = scan.words(data, offs, scan.ALNUM)
        data = scan.FOLD[data]
        return cls(data, starts, ends, scan.span_hash(scan.prefix_sums(data), starts, ends), bounds)


def _equal(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether the words i of one buffer are, byte by byte, the words j of the other."""
    size = a.ends[i] - a.starts[i]
    out = size == b.ends[j] - b.starts[j]
    k = np.flatnonzero(out)
    size = size[k]
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    same = a.data[np.repeat(a.starts[i[k]], size) + within] == b.data[np.repeat(b.starts[j[k]], size) + within]
    out[k[np.repeat(np.arange(len(k)), size)[~same]]] = False
    return out


class Matcher:
    """All windows of a block of benchmark items.

    Words have two codes: of their bytes, and, for the search, of their hash; these differ only where hashes collide.
    """

    def __init__(self, items: pa.Table) -> None:
        ids = items.column("item_id").combine_chunks()
        self.items = np.array([str(x) for x in ids.to_pylist()], dtype=object)
        column = items.column("text").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        self.words = words = Words.of(*scan.texts(column))
        raw = words.data.tobytes()
        spelled = pa.array([raw[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())], pa.binary())
        code = spelled.dictionary_encode().indices.to_numpy()
        _, self.sample = np.unique(code, return_index=True)  # a word of each code
        of_code = words.h[self.sample]
        self.vocabulary = np.unique(of_code)
        by_hash = (np.searchsorted(self.vocabulary, of_code) + 1).astype(np.int32)
        at = np.argsort(by_hash, kind="stable")  # the codes of each hash
        self.code_of, self.begin = at, np.searchsorted(by_hash[at], np.arange(len(self.vocabulary) + 2))
        n = np.diff(words.bounds)
        self.tables: list[tuple[Table, np.ndarray, np.ndarray, np.ndarray]] = []
        for m in np.unique(np.minimum(n[n > 0], WINDOW)):
            chosen = np.flatnonzero(n == m if m < WINDOW else n >= m)
            number = n[chosen] - m + 1
            of = np.repeat(chosen, number)
            first = np.repeat(words.bounds[:-1][chosen], number) + np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
            windows, which = np.unique(code[first[:, None] + np.arange(m)], axis=0, return_inverse=True)
            pair = np.unique(np.stack([which.ravel(), of]), axis=1)
            self.tables.append((Table(by_hash[windows]), windows, np.searchsorted(pair[0], np.arange(len(windows) + 1)), pair[1]))

    def _codes(self, text: Words, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The code of the benchmark word that each of the words ``at`` is, by direct comparison; -1 if it is none."""
        out = np.full(len(at), -1, np.int64)
        k = 0
        while True:  # words of one hash, one after the other: more than one where hashes collide
            live = np.flatnonzero((out < 0) & (self.begin[ids[at]] + k < self.begin[ids[at] + 1]))
            if not len(live):
                return out
            code = self.code_of[self.begin[ids[at[live]]] + k]
            same = _equal(text, at[live], self.words, self.sample[code])
            out[live[same]] = code[same]
            k += 1

    def match(self, text: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(coverage edges of the words, occurrences of full windows by text, text of each found item, item)."""
        edge, full = np.zeros(len(text.h) + 1, np.int64), np.zeros(len(text.bounds) - 1, np.int64)
        none = np.zeros(0, np.int64)
        if not len(self.vocabulary) or not len(text.h):
            return edge, full, none, none
        at = np.minimum(np.searchsorted(self.vocabulary, text.h), len(self.vocabulary) - 1)
        ids = np.where(self.vocabulary[at] == text.h, at + 1, 0).astype(np.int32)
        texts, found = [], []
        for table, windows, begin, item in self.tables:
            w, s = table.search(ids, text.bounds)
            if not len(w):
                continue
            span = np.bincount(s, minlength=len(edge)) - np.bincount(s + table.m, minlength=len(edge))
            place = np.flatnonzero(np.cumsum(span)[:-1] > 0)
            code = np.full(len(text.h), -1, np.int64)
            code[place] = self._codes(text, ids, place)
            ok = np.ones(len(w), bool)
            for k in range(table.m):
                ok &= windows[w, k] == code[s + k]
            w, s = w[ok], s[ok]
            edge += np.bincount(s, minlength=len(edge)) - np.bincount(s + table.m, minlength=len(edge))
            of = np.searchsorted(text.bounds, s, "right") - 1
            if table.m == WINDOW:
                full += np.bincount(of, minlength=len(full))
            number = begin[w + 1] - begin[w]
            k = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
            pair = np.unique(np.stack([np.repeat(of, number), item[np.repeat(begin[w], number) + k]]), axis=1)
            texts.append(pair[0])
            found.append(pair[1])
        return edge, full, np.concatenate(texts or [none]), np.concatenate(found or [none])


_LOADED: OrderedDict[str, Matcher] = OrderedDict()


def _matcher(path: str) -> Matcher:
    if path not in _LOADED:
        fs, name = scan.filesystem(path)
        while len(_LOADED) >= KEPT:
            _LOADED.popitem(last=False)
        _LOADED[path] = Matcher(pq.read_table(name, filesystem=fs, columns=["item_id", "text"]))
    else:
        _LOADED.move_to_end(path)
    return _LOADED[path]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int) -> list[str]:
    """Writes the items to the shared folder in files of about ``block_bytes`` of text and returns their paths."""
    items = benchmark.selectExpr("cast(item_id as bigint) item_id", "cast(text as string) text")
    total = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    folder = scan.shared_dir(items.sparkSession, "benchmark")
    items.repartition(1 + int(total // block_bytes), F.xxhash64("item_id", "text")).write.parquet(folder)
    from pyarrow import fs as arrow_fs

    fs, path = scan.filesystem(folder)
    found = fs.get_file_info(arrow_fs.FileSelector(path))
    prefix = folder[: len(folder) - len(path)] if folder.endswith(path) else ""
    return sorted(prefix + f.path for f in found if f.path.endswith(".parquet"))


def _hits(column: pa.Array, paths: list[str]) -> dict[str, list]:
    """Per text: words, words hit, occurrences of full windows, ids of the found items.

    With more blocks of the benchmark than a worker keeps, texts are searched in groups of slices, each block for a whole
    group, so that blocks are built once a group.
    """
    size = GROUP if len(paths) > KEPT else 1
    out: dict[str, list] = {"n_words": [], "n_hit": [], "n_full": [], "items": []}
    cuts = list(scan.slices(column, SLICE))
    for g in range(0, len(cuts), size):
        group = [Words.of(*scan.texts(column, lo, hi)) for lo, hi in cuts[g : g + size]]
        edges = [np.zeros(len(x.h) + 1, np.int64) for x in group]
        full = [np.zeros(len(x.bounds) - 1, np.int64) for x in group]
        items: list[dict[int, set[str]]] = [{} for _ in group]
        for path in paths:
            matcher = _matcher(path)
            for k, x in enumerate(group):
                e, f, text, item = matcher.match(x)
                edges[k] += e
                full[k] += f
                for t, i in zip(text.tolist(), item.tolist()):
                    items[k].setdefault(t, set()).add(matcher.items[i])
        for x, e, f, found in zip(group, edges, full, items):
            out["n_words"].append(np.diff(x.bounds))
            out["n_hit"].append(scan.per_text(np.cumsum(e[:-1]) > 0, x.bounds))
            out["n_full"].append(f)
            out["items"] += [sorted(found[k]) if k in found else [] for k in range(len(f))]
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK) -> DataFrame:
    """One row per document: words, words inside any occurrence of a window, items found, and the verdict.

    ``contaminated``: some word is hit and at least 5 % of the words are. Null, empty or wordless text: no words, not
    contaminated. Items with the same id count once; items without words match nothing; an empty benchmark hits nothing.
    Repeated rows give repeated results; extra columns are dropped. A narrow map over the documents: no shuffle.
    """
    paths = benchmark_blocks(benchmark, block_bytes)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = _hits(batch.column(1), paths)
        n, hit = np.concatenate(v["n_words"]), np.concatenate(v["n_hit"])
        digest = [hashlib.sha256(",".join(x).encode()).hexdigest() if x else _NONE for x in v["items"]]
        count = [len(x) for x in v["items"]]
        arrays = [batch.column(0), pa.array(n), pa.array(hit), pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array((hit > 0) & (20 * hit >= n))]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return scan.map_arrow(docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text"), run, SCHEMA)


_NONE = hashlib.sha256(b"").hexdigest()


def clean_documents(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, all columns kept, that hold no passage of the benchmark.

    A row goes if a full window of 13 words occurs in it, however long its text is, or if 5 % or more of its words are hit:
    items of fewer words may be common phrases, so one of these alone does not condemn a long text. Null, empty and
    wordless texts stay. Rows are judged one by one, so repeated rows and ties of ids all stay or all go.
    """
    paths = benchmark_blocks(benchmark, block_bytes)
    where = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = _hits(batch.column(where), paths)
        n, hit, full = (np.concatenate(v[k]) for k in ("n_words", "n_hit", "n_full"))
        return batch.filter(pa.array((full == 0) & ~((hit > 0) & (20 * hit >= n))))

    return scan.map_arrow(docs, run, docs.schema)


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT m FROM win),
doc AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)
), hit AS (SELECT doc_id, i, doc.m, item_id FROM doc JOIN win ON doc.m = win.m AND doc.s = win.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
