"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan

#: A key is hot when it has more than 1/HOT of all rows, so fewer than HOT keys are ever broadcast.
HOT = 1000
#: Ids are broadcast up to this many (16 bytes each: 64 MB); beyond it, the join shuffles.
MOST_IDS = 4_000_000


def lookup(left: DataFrame, right: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Left join to ``right`` (one row per key, ``count``: its rows in ``left``, of ``total``).

    Hot keys, fewer than HOT by definition, are broadcast; no other key has over total/HOT rows in a shuffle.
    """
    hot = F.broadcast(right.where(F.col(count) * HOT > total))
    cold = right.where(F.col(count) * HOT <= total)
    spread = left.join(hot.select(*keys), keys, "left_anti").join(cold, keys, "left")
    return left.join(hot, keys).select(*spread.columns).unionByName(spread)


def by_ids(rows: DataFrame, key: str, ids: DataFrame, n_ids: int, how: str) -> DataFrame:
    """Semi or anti join to a table of ids: broadcast up to MOST_IDS ids, shuffled beyond."""
    return rows.join(F.broadcast(ids) if n_ids <= MOST_IDS else ids, key, how)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, comp): the least node of each connected component, for all nodes of ``edges`` (a, b).

    Alternating large and small stars; each round is checkpointed, and stops when it changes nothing. Where a node has over
    1/HOT of all edges, its least neighbour is broadcast, so that its edges stay where they are; no node's edges are gathered.
    """
    e = scan.checkpointed(edges.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct())
    mark, n = None, e.count()
    for _ in range(rounds):
        both = e.union(e.selectExpr("b a", "a b"))
        least = scan.checkpointed(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("c")))
        large = lookup(both, least.selectExpr("a", "least(a, m) m", "c"), ["a"], "c", 2 * n).where("b > a")
        large = scan.checkpointed(large.selectExpr("b a", "m b").distinct())
        parent = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("c"))
        small = lookup(large, parent, ["a"], "c", n).where("b <> m").selectExpr("b a", "m b").union(parent.selectExpr("a", "m b")).distinct()
        e = scan.checkpointed(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            return e.selectExpr("a node", "b comp").union(e.selectExpr("b node", "b comp").distinct())
        mark, n = now, now[0]
    raise RuntimeError("components: no fixed point")
