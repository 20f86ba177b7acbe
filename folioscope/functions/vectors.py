"""Vector functions: cosine in double precision, deterministic embedders."""

from __future__ import annotations

import hashlib
import math
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_similarity(vector: Column, query: list[float]) -> Column:
    """1 - cosine distance to a fixed query, as a Column; null for a zero vector or another dimension.

    For single values; searches score whole batches by ``similarities``.
    """
    q = F.array(*(F.lit(float(x)) for x in query))
    norm = math.sqrt(sum(float(x) * float(x) for x in query))
    both = F.struct(dot(vector, q).alias("d"), F.sqrt(dot(vector, vector)).alias("n"))  # bound once: see let
    return F.when(F.size(vector) == len(query), let(both, lambda x: F.when(x["n"] * norm > 0, x["d"] / (x["n"] * norm))))


def similarities(column: pa.Array, query: np.ndarray) -> np.ndarray:
    """Cosine similarity of each vector of a list column to a unit query: one matrix product a batch.

    NaN for a null, a zero vector, another dimension, or a null inside.
    """
    offsets = np.asarray(column.offsets)
    size = np.diff(offsets)
    fits = np.flatnonzero((size == len(query)) & np.asarray(column.is_valid()))
    x = np.asarray(column.values.to_numpy(zero_copy_only=False))
    if len(fits) == len(size) and len(size):
        x = x[offsets[0] : offsets[-1]].reshape(-1, len(query))
    else:
        x = x[(offsets[:-1][fits][:, None] + np.arange(len(query)))]
    x = x.astype(np.float64)
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    out = np.full(len(size), np.nan)
    with np.errstate(invalid="ignore", divide="ignore"):
        out[fits] = np.where(norm > 0, x @ query / norm, np.nan)
    return out


def unit(query: list[float]) -> np.ndarray:
    q = np.asarray(query, np.float64)
    return q / (np.linalg.norm(q) or 1.0)


def hash_embedding(key: str, size: int) -> list[float]:
    """A unit vector from a chain of sha256 digests of the key, read as big-endian 32-bit integers."""
    links, raw = [key.encode()], bytearray()
    while len(raw) < 4 * size:
        links.append(hashlib.sha256(links[-1]).digest())
        raw += links[-1]
    values = [x / 2**31 for x in struct.unpack_from(f">{size}i", raw)]
    length = math.hypot(*values) or 1.0
    return [v / length for v in values]


def hash_embedding_udf(dimensions: int):
    """``hash_embedding`` over Arrow batches."""

    @F.pandas_udf("array<double>")
    def embed(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: None if k is None else hash_embedding(k, dimensions))

    return embed


def axis_embedding(query: Column, axes: list[tuple[str, ...]], dimensions: int) -> Column:
    """A unit vector along the axis of the first group of words one of which the text contains; else the zero vector."""
    zero = F.array_repeat(F.lit(0.0), dimensions)
    q, out = F.lower(F.coalesce(query, F.lit(""))), zero
    for axis, group in reversed(list(enumerate(axes))):
        hit = F.lit(False)
        for w in group:
            hit = hit | F.contains(q, F.lit(w))
        unit = F.array(*(F.lit(1.0 if i == axis else 0.0) for i in range(dimensions)))
        out = F.when(hit, unit).otherwise(out)
    return out
