"""Change detection, reconciliation with a desired state, upserts, manifests and audit.

Tables are Parquet snapshots: an upsert makes the next snapshot by joins, to be written beside the old one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import folds


def detect_changes(current: DataFrame, previous: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, status): new, modified, unchanged or deleted, by the hashes of two manifests."""
    a, b = current.select(key, F.col(digest).alias("_now")), previous.select(key, F.col(digest).alias("_was"))
    joined = a.withColumn("_here", F.lit(True)).join(b.withColumn("_there", F.lit(True)), key, "full_outer")
    status = (
        F.when(F.col("_here").isNull(), "deleted").when(F.col("_there").isNull(), "new").when(F.col("_now").eqNullSafe(F.col("_was")), "unchanged").otherwise("modified")
    )
    return joined.select(key, status.alias("status"))


def change_summary(changes: DataFrame) -> DataFrame:
    is_ = lambda s: F.col("status").isin(*s)
    return changes.agg(
        F.count_if(is_(["new", "modified"])).alias("changed_count"), F.count_if(is_(["unchanged"])).alias("unchanged_count"),
        F.count_if(is_(["deleted"])).alias("deleted_count"), F.count_if(~is_(["deleted"])).alias("total_count"),
    )


def reconcile_plan(desired: DataFrame, actual: DataFrame, bill: str = "bill_uid", digest: str = "source_hash") -> DataFrame:
    """One row per bill: its action (new, replace, delete, keep) and how many hashes to add, to keep and to drop.

    One aggregation by (bill, hash) of both sides together, then one by bill: equality of hash sets without building them.
    """
    a = desired.select(bill, digest, F.lit(1).alias("_want"), F.lit(None).cast("int").alias("_have"))
    b = actual.select(bill, digest, F.lit(None).cast("int").alias("_want"), F.lit(1).alias("_have"))
    j = a.union(b).groupBy(bill, digest).agg(F.max("_want").alias("_want"), F.max("_have").alias("_have"))
    out = j.groupBy(bill).agg(
        F.count_if(F.col("_want").isNotNull() & F.col("_have").isNull()).alias("n_add"),
        F.count_if(F.col("_want").isNotNull() & F.col("_have").isNotNull()).alias("n_reuse"),
        F.count_if(F.col("_want").isNull()).alias("n_drop"),
        F.count("_want").alias("_w"), F.count("_have").alias("_h"),
    )
    action = F.when(F.col("_w") == 0, "delete").when(F.col("_h") == 0, "new").when((F.col("n_add") > 0) | (F.col("n_drop") > 0), "replace").otherwise("keep")
    return out.select(bill, action.alias("action"), "n_add", "n_reuse", "n_drop")


def delete_fraction(plan: DataFrame) -> DataFrame:
    """Bills to delete, bills there now, and their ratio (0 where there are none)."""
    out = plan.agg(F.count_if(F.col("action") == "delete").alias("n_delete"), F.count_if(F.col("action") != "new").alias("n_actual"))
    return out.withColumn("fraction", F.when(F.col("n_actual") > 0, F.col("n_delete") / F.col("n_actual")).otherwise(0.0))


def guard_deletes(plan: DataFrame, most: float = 0.2) -> None:
    """Refuses a plan that deletes over ``most`` of the bills: a partial scrape looks just so."""
    row = delete_fraction(plan).first()
    if row["n_delete"] and row["fraction"] > most:
        raise ValueError(f"the plan deletes {row['n_delete']} of {row['n_actual']} bills, over {most:.0%}")


def reconcile_apply(desired: DataFrame, actual: DataFrame, computed: DataFrame, bill: str = "bill_uid", digest: str = "source_hash", vector: str = "embedding") -> DataFrame:
    """The next snapshot: the desired rows, each with the embedding its bill already has, else the computed one."""
    have = actual.select(bill, digest, F.col(vector).alias("_have"))
    new = computed.select(digest, F.col(vector).alias("_new"))
    joined = desired.join(have, [bill, digest], "left").join(new, digest, "left")
    return joined.select(*desired.columns, F.coalesce("_have", "_new").alias(vector), F.when(F.col("_have").isNotNull(), "reused").otherwise("added").alias("origin"))


def upsert_by_count(staged: DataFrame, live: DataFrame, bill: str) -> DataFrame:
    """How the count-based upsert treats each staged bill: ``upsert`` where counts agree, else ``replace``.

    Documented emulation: equal counts with other hashes leave old rows behind; ``reconcile_plan`` compares sets instead.
    """
    s = staged.groupBy(bill).agg(F.count("*").alias("staged_count"))
    n = live.groupBy(bill).agg(F.count("*").alias("live_count"))
    out = s.join(n, bill, "left").withColumn("live_count", F.coalesce("live_count", F.lit(0)))
    return out.withColumn("strategy", F.when(F.col("staged_count") == F.col("live_count"), "upsert").otherwise("replace"))


def upsert_snapshot(staged: DataFrame, live: DataFrame, bill: str, digest: str, update: list[str]) -> DataFrame:
    """The table after a count-based upsert: replaced bills lose their rows; upserted rows take ``update`` from staging."""
    plan = upsert_by_count(staged, live, bill).select(bill, "strategy")
    kept = live.join(plan.where("strategy = 'replace'"), bill, "left_anti")
    new = staged.select(digest, *(F.col(c).alias(f"_{c}") for c in update), F.lit(True).alias("_s"))
    values = [F.when(F.col("_s"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in live.columns]
    updated = kept.join(new, digest, "left").select(*values)
    return updated.unionByName(staged.join(kept.select(digest), digest, "left_anti").select(*live.columns))


def replace_by_key(staged: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """The table after every staged key's rows have been replaced (votes: by vote_id, so that no old row is left)."""
    return live.join(staged.select(key).distinct(), key, "left_anti").unionByName(staged)


def manifest_md5(df: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, n, manifest_md5): md5 of the key's sorted hashes, comma-joined.

    The digest is sequential, so a key is one stream of sorted rows; it is never held as a list or string.
    """

    def make():
        md, state = hashlib.md5(), {"n": 0}

        def step(row: tuple | None) -> list[tuple]:
            if row is None:
                return [(state["n"], md.hexdigest())]
            if state["n"]:
                md.update(b",")
            md.update((row[1] or "").encode())
            state["n"] += 1
            return []

        return step

    kind = dict(df.dtypes)[key]
    return folds.ordered_fold(df.select(key, digest), key, [digest], make, f"{key} {kind}, n long, manifest_md5 string", finish=True)


def manifest_tree(df: DataFrame, key: str, digest: str, digits: int = 2) -> DataFrame:
    """(key, part, n, hash_sum): a manifest that is parallel within a key, where ``manifest_md5`` is one stream.

    Parts are the digest's first hex digits; a part's value is the order-free sum of the first 60 bits of its digests, so two
    manifests differ just in the parts whose digests do.
    """
    bits = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)")
    return df.groupBy(key, F.substring(digest, 1, digits).alias("part")).agg(F.count("*").alias("n"), F.sum(bits).cast("decimal(38,0)").alias("hash_sum"))


def manifest_mismatches(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, part) of the parts in which two trees differ."""
    x, y = (t.select(key, "part", F.struct("n", "hash_sum").alias(n)) for t, n in ((a, "_a"), (b, "_b")))
    return x.join(y, [key, "part"], "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(key, "part")


def require_counts(expected: int, found: int, what: str) -> None:
    """Refuses a load whose numbers of rows do not agree."""
    if expected != found:
        raise ValueError(f"{what}: {expected} rows expected, {found} found")


def latest(events: DataFrame, key: str, order: list[str], names: list[str]) -> DataFrame:
    """The last row of each key: audit states are appended, never updated."""
    last = F.max_by(F.struct(*names), F.struct(*order)).alias("_l")
    return events.groupBy(key).agg(last, F.count("*").alias("n_events")).select(key, *(F.col(f"_l.{n}").alias(n) for n in names), "n_events")


def violations(checks: DataFrame) -> DataFrame:
    """Rows of an invariants table that do not hold."""
    return checks.where(~F.col("ok"))


def validate_embedded(df: DataFrame, digest: str, vector: str, dimensions: int) -> DataFrame:
    """Counts of rows without a hash, without an embedding, and with one of another dimension."""
    return df.agg(
        F.count_if(F.coalesce(F.col(digest), F.lit("")) == "").alias("no_hash"), F.count_if(F.col(vector).isNull()).alias("no_embedding"),
        F.count_if(F.size(vector) != dimensions).alias("wrong_dimension"),
    )
