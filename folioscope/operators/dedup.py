"""Exact deduplication of documents and sections, keeping every alias.

Aliases and document hashes come as rows, not as arrays: a group may hold a third of all rows, and no task or value
should have to hold a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical(df: DataFrame, group: list[str], key: Column, names: list[str]) -> DataFrame:
    """One row per group: ``names`` of its row with the least key, its size, and its duplicates (size - 1)."""
    first = F.min_by(F.struct(*names), key).alias("first")
    out = df.groupBy(*group).agg(first, F.count("*").alias("n_members"))
    return out.select(*group, *(F.col(f"first.{n}").alias(f"canonical_{n}") for n in names), "n_members", (F.col("n_members") - 1).alias("n_duplicates"))


def first_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row of each key that comes first by ``order``: partial minima, then one per key; never ``dropDuplicates``."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row")).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))


def aliases(df: DataFrame, group: list[str], key: Column, names: list[str]) -> DataFrame:
    """One row per member of each group of two or more, with the group's canonical row: the alias list in rows."""
    heads = canonical(df, group, key, names).where("n_members > 1").drop("n_duplicates")
    return df.join(heads, group)


def group_values(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The distinct values of each group that has at least two, as rows: a sorted set in rows."""
    pairs = df.select(*group, value).distinct()
    several = pairs.groupBy(*group).agg(F.count("*").alias("n_values")).where("n_values > 1")
    return pairs.join(several, group)
