"""Shards and request batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import folds


def fixed_shards(df: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """Adds shard_id: ``size`` rows each within the keys, in order; one shard if size <= 0. Balanced for hot keys."""
    if size <= 0:
        return df.withColumn("shard_id", F.lit(1).cast("bigint"))
    numbered = folds.number_within(df, keys, order)
    return numbered.withColumn("shard_id", (F.floor((F.col("rn") - 1) / size) + 1).cast("bigint")).drop("rn")


def greedy_shards(counts: DataFrame, key: str, order: list[str], bill: str, chunks: str, most_bills: int = 500, most_chunks: int = 40_000) -> DataFrame:
    """(key, bill, chunks, shard_id): bills in order, never split; a shard ends at ``most_bills``, or where the next bill
    would bring it over ``most_chunks``. Parallel within a key; without a limit of bills, its rows are one stream."""
    narrow = counts.select(key, bill, chunks, *[c for c in order if c not in (key, bill, chunks)])
    if most_bills > 0:
        return folds.greedy_segments(narrow, key, order, chunks, most_bills, most_chunks, "shard_id").select(key, bill, chunks, "shard_id")

    def make():
        state = {"shard": 1, "chunks": None}

        def step(row: tuple) -> list[tuple]:
            _, b, n = row[:3]
            if state["chunks"] is not None and 0 < most_chunks < state["chunks"] + n:
                state.update(shard=state["shard"] + 1, chunks=None)
            state["chunks"] = (state["chunks"] or 0) + n
            return [(b, n, state["shard"])]

        return step

    types = dict(counts.dtypes)
    return folds.ordered_fold(narrow, key, order, make, f"{key} {types[key]}, {bill} {types[bill]}, {chunks} {types[chunks]}, shard_id long")


def pack_batches(rows: DataFrame, key: str, order: list[str], item: str, tokens: str, most_items: int = 500, most_tokens: int = 250_000) -> DataFrame:
    """(key, item, tokens, batch_id): next-fit batches under a count and a token limit; a larger single item is an error."""
    if most_items <= 0 or most_tokens <= 0:
        raise ValueError("limits must be above 0")
    narrow = rows.select(key, item, tokens, *[c for c in order if c not in (key, item, tokens)])
    said = F.concat(F.lit("item "), F.col(item).cast("string"), F.lit(" has "), F.col(tokens).cast("string"), F.lit(f" tokens, over the limit of {most_tokens} a request"))
    narrow = narrow.withColumn(tokens, F.when(F.col(tokens) > most_tokens, F.raise_error(said)).otherwise(F.col(tokens)))
    return folds.greedy_segments(narrow, key, order, tokens, most_items, most_tokens, "batch_id").select(key, item, tokens, "batch_id")


def shard_manifest(shards: DataFrame, keys: list[str], bill: str, chunks: str, bill_order: list[str]) -> DataFrame:
    """One row per shard: bills, chunks, first and last bill."""
    order = F.struct(*bill_order)
    return shards.groupBy(*keys, "shard_id").agg(
        F.count("*").alias("bill_count"), F.sum(chunks).alias("chunk_count"), F.min_by(bill, order).alias("first_bill"), F.max_by(bill, order).alias("last_bill")
    )
