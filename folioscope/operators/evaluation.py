"""Retrieval metrics and latency percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import folds


def metrics(retrieved: DataFrame, expected: DataFrame, k: int, item: str) -> DataFrame:
    """(query_id, recall, precision, mrr) at k; ``retrieved`` has 1-based ranks, ``expected`` (query_id, item) pairs.

    Queries without an expectation are left out; one that retrieves nothing scores 0.
    """
    want = expected.select("query_id", item).distinct()
    n = want.groupBy("query_id").agg(F.count("*").alias("_n"))
    top = retrieved.where(F.col("rank") <= k).join(want.withColumn("_hit", F.lit(True)), ["query_id", item], "left")
    found = top.groupBy("query_id").agg(
        F.count("*").alias("_top"), F.count("_hit").alias("_hits"), F.count_distinct(F.when(F.col("_hit"), F.col(item))).alias("_found"), F.min(F.when(F.col("_hit"), F.col("rank"))).alias("_first")
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return n.join(found, "query_id", "left").select(
        "query_id", zero(F.col("_found") / F.col("_n")).alias("recall"), zero(F.col("_hits") / F.greatest(F.col("_top"), F.lit(1))).alias("precision"), zero(1.0 / F.col("_first")).alias("mrr")
    )


def by_category(per_query: DataFrame, category: str, overall: str = "OVERALL") -> DataFrame:
    """Means per category and over all queries."""
    means = [F.avg(c).alias(c) for c in ("recall", "precision", "mrr")]
    rows = per_query.groupBy(category).agg(F.count("*").alias("n_queries"), *means)
    return rows.unionByName(per_query.agg(F.count("*").alias("n_queries"), *means).withColumn(category, F.lit(overall)))


def index_percentiles(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, p50, p95) by index into the sorted values: n // 2 and min(n - 1, int(0.95 n)). Balanced for hot keys."""
    rows = df.where(F.col(value).isNotNull()).select(key, value)
    numbered = folds.number_within(rows, [key], [value])
    n = rows.groupBy(key).agg(F.count("*").alias("n"))
    at50, at95 = F.floor(F.col("n") / 2), F.least(F.col("n") - 1, F.floor(F.col("n") * F.lit(0.95)))
    pick = lambda at: F.max(F.when(F.col("rn") - 1 == at, F.col(value)))
    return numbered.join(n, key).groupBy(key).agg(F.max("n").alias("n"), pick(at50).alias("p50"), pick(at95).alias("p95"))
