"""Top-k vector search, exact and by an index, merged and hybrid ranking.

Vectors are scored in Arrow batches, one matrix product each; a task returns its k best rows, of which ``orderBy.limit``
(TakeOrderedAndProject) keeps k, so only k rows per task move. A set of queries is scored in one pass. An index cuts the
vectors into cells, so that a search reads few of them: see ``build_index``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..functions import text as T
from ..functions import vectors as V


def _without(df: DataFrame, vector: str, *more: StructField) -> StructType:
    return StructType([f for f in df.schema if f.name != vector] + list(more))


def _scored(df: DataFrame, query: list[float], vector: str, best: tuple[int, str] | None) -> DataFrame:
    """The rows with their similarity and without the vector; with ``best`` (k, key) only the k best of each task.

    Rows without a similarity have null, or, among the best, are left out.
    """
    schema = _without(df, vector, StructField("similarity", DoubleType()))
    q = V.unit(query)
    ordered = df.select(*[f.name for f in schema][:-1], vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            s = V.similarities(batch.column(batch.num_columns - 1), q)
            rows = pa.Table.from_batches([batch]).drop_columns([vector])
            if best is None:
                yield from rows.append_column("similarity", pa.array(s, mask=np.isnan(s))).to_batches()
                continue
            k, key = best
            at = np.flatnonzero(~np.isnan(s))
            if len(at) > k:  # all ties of the last place stay, the key decides below
                at = at[s[at] >= np.partition(s[at], len(at) - k)[len(at) - k]]
            rows = rows.take(pa.array(at)).append_column("similarity", pa.array(s[at]))
            held = rows if held is None else pa.concat_tables([held, rows])
            held = held.take(pc.sort_indices(held, [("similarity", "descending"), (key, "ascending")])[:k])
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return ordered.mapInArrow(run, schema)


def scored(df: DataFrame, query: list[float], vector: str = "embedding") -> DataFrame:
    """Adds the similarity and drops the vector; null for rows that have none."""
    return _scored(df, query, vector, None)


def top_k(df: DataFrame, query: list[float], k: int, key: str, vector: str = "embedding", where: Column | None = None, least: float | None = None) -> DataFrame:
    """The k most similar rows, ties by key; ``where`` filters before the limit, ``least`` is a similarity threshold."""
    rows = _scored(df if where is None else df.where(where), query, vector, (k, key))
    top = rows.orderBy(F.desc("similarity"), key).limit(k)
    # in descending order, a threshold after the limit keeps the same rows as one before it
    return top if least is None else top.where(F.col("similarity") >= least)


def best_per_group(df: DataFrame, query: list[float], k: int, group: str, key: str, vector: str = "embedding") -> DataFrame:
    """The k groups whose best row is most similar, with that row: partial maxima, no window."""
    best = F.max_by(F.struct("similarity", key), F.struct(F.col("similarity"), -F.col(key))).alias("_b")
    rows = scored(df, query, vector).groupBy(group).agg(best)
    return rows.select(group, F.col(f"_b.{key}").alias(key), F.col("_b.similarity").alias("similarity")).where("similarity is not null").orderBy(F.desc("similarity"), group).limit(k)


def overfetch_groups(df: DataFrame, query: list[float], k: int, group: str, key: str, factor: int = 5, vector: str = "embedding") -> DataFrame:
    """Groups of the k * factor most similar rows, by their best one, cut to k: the limit before grouping is meant."""
    near = top_k(df, query, k * factor, key, vector)
    out = near.groupBy(group).agg(F.max("similarity").alias("similarity"))
    return out.orderBy(F.desc("similarity"), group).limit(k)


def first_groups(df: DataFrame, query: list[float], rows: int, groups: int, group: str, key: str, vector: str = "embedding") -> DataFrame:
    """The best row of each group among the ``rows`` most similar, the first ``groups`` of them."""
    near = top_k(df, query, rows, key, vector)
    rn = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("similarity"), key))
    return near.withColumn("_rn", rn).where("_rn = 1").drop("_rn").orderBy(F.desc("similarity"), key).limit(groups)


def merged(indexes: list[tuple[str, DataFrame]], query: list[float], k: int, key: str, vector: str = "embedding") -> DataFrame:
    """The k best of several indexes' top k; on ties, the earlier index first. An index that is missing is None."""
    hits = None
    for place, (name, df) in enumerate(indexes):
        if df is None:
            continue
        part = top_k(df, query, k, key, vector).withColumn("source_kind", F.lit(name)).withColumn("_place", F.lit(place))
        hits = part if hits is None else hits.unionByName(part, allowMissingColumns=True)
    return hits.orderBy(F.desc("similarity"), "_place", key).limit(k).drop("_place")


def ranked_hits(hits: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """0-based ranks of a list of at most a few thousand hits (already limited)."""
    return hits.withColumn(name, (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)) - 1).cast("bigint"))


def keyword_top_k(df: DataFrame, terms: list[str], k: int, key: str, text: Column) -> DataFrame:
    """Documents by distinct terms matched, then occurrences: our own scorer, as the reference's is not shipped.

    A term counts where it is a whole word of ``text``, which has its case folded by the caller. One pass finds the terms
    alone: white space is looked for only around what has matched.
    """
    other = T.SPACE.replace("[", "[^", 1)
    words = "|".join(f"{q}(?<!{other}{q})(?!{other})" for q in map(re.escape, sorted(terms, key=len, reverse=True)))
    found = F.regexp_extract_all(text, F.lit(f"(?U)({words})"), 1)
    count = lambda f: F.struct(F.size(F.array_distinct(f)).alias("t"), F.size(f).cast("bigint").alias("h"))
    rows = df.select(key, T.let(found, count).alias("_c")).select(key, F.col("_c.t").alias("n_terms"), F.col("_c.h").alias("n_hits"))
    return rows.orderBy(F.desc("n_terms"), F.desc("n_hits"), key).limit(k).where("n_hits > 0")


def fuse(rankings: list[DataFrame], key: str, k: int = 60, first: int = 0) -> DataFrame:
    """Reciprocal rank fusion of (key, rank) lists: the sum of 1 / (k + rank), ranks from ``first``."""
    union = rankings[0]
    for r in rankings[1:]:
        union = union.unionByName(r)
    return union.groupBy(key).agg(F.sum(1.0 / (F.lit(float(k + first)) + F.col("rank"))).alias("score")).orderBy(F.desc("score"), key)


def batch_top_k(df: DataFrame, queries: dict[int, list[float]], k: int, key: str, extra: str, vector: str = "embedding") -> DataFrame:
    """(query_id, key, extra, similarity, rank) of the k nearest rows of each of a stated set of queries.

    The queries are a matrix in the closure (bounded by the caller's list); each Arrow batch is one product, and a task
    returns its best k per query. A query's own row (key = query_id) is no answer.
    """
    names = np.array(sorted(queries))
    q = np.array([V.unit(queries[n]) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(names)
        for batch in batches:
            ids, other = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            for j, n in enumerate(names):
                s = np.where(ids == n, np.nan, V.similarities(batch.column(2), q[j]))
                at = np.flatnonzero(~np.isnan(s))
                s, i, o = (np.concatenate(x) for x in zip(held[j], (s[at], ids[at], other[at])))
                by = np.lexsort((i, -s))[:k]
                held[j] = s[by], i[by], o[by]
        cols = [np.concatenate(c) for c in zip(*((np.full(len(s), n), i, o, s) for n, (s, i, o) in zip(names, held)))] if len(names) else [np.zeros(0)] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["query_id", key, extra, "similarity"])

    part = df.select(F.col(key).cast("long").alias(key), F.col(extra).cast("long").alias(extra), vector).mapInArrow(run, f"query_id long, {key} long, {extra} long, similarity double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), key))
    return part.withColumn("rank", rank).where(F.col("rank") <= k)


def within_groups(df: DataFrame, hits: DataFrame, query: list[float], per_group: int, group: str, key: str, vector: str = "embedding") -> DataFrame:
    """For each group among ``hits`` (at most the top k), its ``per_group`` best rows of another index."""
    rows = scored(df.join(F.broadcast(hits.select(group).distinct()), group, "left_semi"), query, vector)
    rn = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("similarity"), key))
    return rows.withColumn("_rn", rn).where((F.col("_rn") <= per_group) & F.col("similarity").isNotNull()).drop("_rn")


def hydrated(hits: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Hits with their details; a hit without any stays. ``hits`` is a limited list, so it is the broadcast side."""
    found = details.join(F.broadcast(hits.select(key).distinct()), key, "left_semi")
    return hits.join(found, key, "left")


@dataclass
class Index:
    """Vectors in Parquet, a folder per cell, with the cells' unit centers and the least similarity of a member to its own."""

    path: str
    schema: StructType
    vector: str
    centers: np.ndarray
    least: np.ndarray

    def rows(self, spark: SparkSession, cells: list[int]) -> DataFrame:
        """The rows of the given cells: other cells' files are not read."""
        return spark.read.schema(self.schema).parquet(self.path).where(F.col("cell").isin(cells)).drop("cell", "_near")


def _centers(sample: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Unit centers by k-means on unit vectors; starts from evenly spaced rows of the sample."""
    centers = sample[np.linspace(0, len(sample) - 1, cells).astype(int)]
    for _ in range(rounds):
        own = (sample @ centers.T).argmax(axis=1)
        total = np.zeros_like(centers)
        np.add.at(total, own, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centers = np.where(norm > 0, total / np.maximum(norm, 1e-300), centers)
    return centers


def build_index(df: DataFrame, path: str, key: str, vector: str = "embedding", cells: int = 64, sample: int = 8192, files: int = 16) -> Index:
    """Writes every row that has a vector into its nearest cell.

    The centers are fitted on a bounded sample, the ``sample`` rows with the least hash of their key; all rows are
    assigned and written by cell, up to ``files`` files each. Rows without a usable vector are left out:
    no search can return them.
    """
    spark = df.sparkSession
    drawn = df.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(key), key).select(vector).limit(sample).collect()
    sizes = [len(r[0]) for r in drawn]
    size = max(set(sizes), key=sizes.count) if sizes else 0
    x = np.array([r[0] for r in drawn if len(r[0]) == size and None not in r[0]], np.float64).reshape(-1, max(size, 1))
    norm = np.linalg.norm(x, axis=1)
    x = x[norm > 0] / norm[norm > 0][:, None]
    centers = _centers(x, max(1, min(cells, len(x)))) if len(x) else np.zeros((0, 1))
    schema = StructType([*df.schema, StructField("cell", IntegerType()), StructField("_near", DoubleType())])
    at = df.columns.index(vector)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.stack([V.similarities(batch.column(at), c) for c in centers], axis=1) if len(centers) else np.full((batch.num_rows, 1), np.nan)
            ok = ~np.isnan(near[:, 0])
            near = near[ok]
            cell = near.argmax(axis=1) if len(near) else np.zeros(0, int)
            rows = pa.Table.from_batches([batch]).filter(pa.array(ok))
            rows = rows.append_column("cell", pa.array(cell, pa.int32())).append_column("_near", pa.array(near[np.arange(len(near)), cell]))
            yield from rows.to_batches()

    spread = F.pmod(F.xxhash64(key), F.lit(files))  # a hot cell is written by several tasks
    df.mapInArrow(assign, schema).repartition("cell", spread).write.partitionBy("cell").parquet(path)
    least = np.ones(len(centers))
    if len(centers):
        for r in spark.read.schema(schema).parquet(path).groupBy("cell").agg(F.min("_near").alias("m")).collect():  # a row per cell
            least[r["cell"]] = r["m"]
    return Index(path, schema, vector, centers, least)


def indexed_top_k(spark: SparkSession, index: Index, query: list[float], k: int, key: str, probes: int = 4, exact: bool = True) -> DataFrame:
    """The k most similar rows of an index, ties by key.

    The ``probes`` nearest cells are searched first. Exact: their k-th similarity bounds what is still missing, and of the
    other cells those are read that may hold something as near: a member is at most its cell's widest angle from the center.
    Without ``exact`` the first cells alone answer, which misses some rows (tests hold the recall).
    """
    q = V.unit(query)
    if not len(index.centers):
        return top_k(index.rows(spark, []), query, k, key, index.vector)
    near = index.centers @ q
    order = np.argsort(-near, kind="stable")
    cells = [int(c) for c in order[:probes]]
    found = top_k(index.rows(spark, cells), query, k, key, index.vector)
    if not exact:
        return found
    have = found.select("similarity").collect()  # k numbers
    if len(have) < k:
        cells = [int(c) for c in order]
    else:
        bound = math.acos(max(-1.0, min(1.0, have[-1][0])))
        angle = np.arccos(np.clip(near, -1, 1)) - np.arccos(np.clip(index.least, -1, 1))
        cells = [int(c) for c in order if c in cells or angle[c] <= bound + 1e-7]
    return top_k(index.rows(spark, cells), query, k, key, index.vector)
