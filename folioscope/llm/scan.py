"""Vectorised word scanning over Arrow string buffers, and batch helpers shared by the operators.

Texts are handled as the UTF-8 bytes of an Arrow batch; one NumPy pass finds the words of many
texts at once and gives each a 64-bit hash (a polynomial over random byte values, taken from
prefix sums), so that no Python object is made per word.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..functions.batches import small_batches, trim

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15 | 1)
_INV = _U(pow(int(_MULT), -1, 1 << 64))
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 64, 256, dtype=np.uint64)
_LEN = _U(0xD6E8FEB86659FD93)

#: `[^\x20\x09-\x0D]`: everything but ASCII white space.
NONSPACE = np.ones(256, bool)
NONSPACE[[9, 10, 11, 12, 13, 32]] = False
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after folding A-Z: digits, a-z and all non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x41:0x5B] = ALNUM[0x80:] = True
#: Lower-cases A-Z only.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = h ^ (h >> _U(33))
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def _table_of_powers(m: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.full(_STEP, m, np.uint64)
    low[0] = 1
    np.cumprod(low, out=low)
    high = np.full(_STEP, pow(m, _STEP, 1 << 64), np.uint64)
    high[0] = 1
    np.cumprod(high, out=high)
    return low, high


#: Powers of the multiplier and of its inverse, as two factors each: exponents up to 2^32 from two small tables.
_STEP = 1 << 16
_UP, _DOWN = _table_of_powers(int(_MULT)), _table_of_powers(int(_INV))


def texts(column: pa.Array, lo: int = 0, hi: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of rows lo..hi of a string column; a null counts as empty."""
    part = column.slice(lo, None if hi is None else hi - lo)
    if part.null_count:
        part = part.fill_null("" if pa.types.is_string(part.type) or pa.types.is_large_string(part.type) else b"")
    wide = pa.types.is_large_string(part.type) or pa.types.is_large_binary(part.type)
    _, offs, data = part.buffers()
    n = len(part)
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[part.offset : part.offset + n + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b[o[0] : o[-1]], o - o[0]


def slices(column: pa.Array, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes are about ``most``; a longer single row is a range of its own."""
    n = len(column)
    if n == 0:
        return
    _, offs = texts(column)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + most, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def prefix_sums(data: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    table = _TABLE if fold is None else _TABLE[fold]
    out = np.zeros(len(data) + 1, np.uint64)
    for lo in range(0, len(data), _STEP):
        part = data[lo : lo + _STEP]
        terms = table[part]
        terms *= _UP[0][: len(part)]
        if lo:
            terms *= _UP[1][lo >> 16]
        to = out[lo + 1 : lo + 1 + len(part)]
        np.cumsum(terms, out=to)
        to += out[lo]
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans; equal bytes have equal hashes, wherever they stand."""
    out = sums[ends]
    out -= sums[starts]
    out *= _DOWN[0][starts & (_STEP - 1)]
    if len(sums) > _STEP:
        out *= _DOWN[1][starts >> 16]
    out += (ends - starts).astype(np.uint64) * _LEN
    return mix(out)


def hash_bytes(b: bytes) -> int:
    """The hash that ``span_hash`` gives these bytes (after any folding)."""
    data = np.frombuffer(b, np.uint8)
    return int(span_hash(prefix_sums(data), np.array([0]), np.array([len(data)]))[0])


def words(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of words before it (length n + 1)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    w = table[data]
    start = w.copy()
    start[1:] &= ~w[:-1]
    end = np.zeros(n + 1, bool)
    end[1:n] = w[:-1] & ~w[1:]
    end[n] = w[n - 1]
    inner = offs[(offs > 0) & (offs < n)]
    start[inner] = w[inner]
    end[inner] |= w[inner - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end)
    return s, e, np.searchsorted(s, offs)


def owner(bounds: np.ndarray) -> np.ndarray:
    """For each item, the index of the text it lies in."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the bounds."""
    if values.dtype == bool:  # by the places that hold, which are often few
        at = np.flatnonzero(values)
        return np.searchsorted(at, bounds[1:]) - np.searchsorted(at, bounds[:-1])
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[bounds[1:]] - c[bounds[:-1]]


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out
            trim()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, in spark.checkpoint.dir; where that is unset, a local session's temporary one."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        base = "file://" + tempfile.gettempdir() + "/folioscope"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the folder that the session names (one of our own only where none is set)."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def filesystem(uri: str):
    """pyarrow's file system and path for a URI or plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)
