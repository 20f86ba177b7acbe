"""Incremental runs over arriving files: each available batch is merged into a keyed snapshot, exactly once.

The modern form of a nightly job: the checkpoint knows which files were taken, ``foreachBatch`` writes a snapshot
named by its epoch, and a repeated epoch overwrites its own, so a restart changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_files(spark: SparkSession, folder: str, schema, glob: str, **options) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.parquet(folder)


def run_available(stream: DataFrame, out: str, key: str, digest: str) -> int:
    """Takes all files that are there; keeps each key's row with its hash in ``out/epoch=N``. Returns the epochs run."""
    done = []

    def merge(batch: DataFrame, epoch: int) -> None:
        one = batch.groupBy(key).agg(F.max(F.struct(*[c for c in batch.columns if c != key])).alias("_r")).select(key, "_r.*")
        one.withColumn("_digest", F.sha2(F.col(digest).cast("string"), 256)).write.mode("overwrite").parquet(f"{out}/data/epoch={epoch}")
        done.append(epoch)

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)


def snapshot(spark: SparkSession, out: str, key: str) -> DataFrame:
    """The latest epoch's row of each key."""
    rows = spark.read.parquet(f"{out}/data")
    rest = [c for c in rows.columns if c not in (key, "epoch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "epoch").alias("_r")).select(key, "_r.*")


def changed_since(spark: SparkSession, out: str, key: str, previous: DataFrame) -> DataFrame:
    """(key, status) of the snapshot against an earlier manifest (key, _digest)."""
    from ..operators.state import detect_changes

    return detect_changes(snapshot(spark, out, key), previous, key, "_digest")


def choose_path(changed: int, missing: int, most: int = 1000) -> str:
    """delta for 1 to ``most`` changes; retry where only embeddings are missing; nothing; else full."""
    if 0 < changed <= most:
        return "delta"
    if changed == 0:
        return "retry" if missing else "nothing"
    return "full"
