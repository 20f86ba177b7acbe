"""Ordered computations that keep no group in memory.

``number_within`` gives row numbers without a window over a whole group: rows are range-partitioned over all executors,
numbered within partitions, and offset by the counts before. ``ordered_fold`` streams the sorted rows of each key
through a Python fold, for logic that carries state from row to row; a task holds one batch and the state.
``greedy_segments`` cuts each key's rows greedily, in parallel within a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the one that all executors share (spark.checkpoint.dir); where it is unset, a local session's own."""
    import tempfile
    import uuid

    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(base or 'file://' + tempfile.gettempdir() + '/folioscope').rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialized(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the folder that the session names; one of our own only where none is set."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def number_within(df: DataFrame, keys: list[str], order: list[str], name: str = "rn") -> DataFrame:
    """Adds the 1-based place of each row within its keys, by ``order``. Balanced however many rows a key has.

    ``order`` must not leave ties, unless any order of tied rows will do.
    """
    ranged = materialized(df.repartitionByRange(*keys, *order).withColumn("_p", F.spark_partition_id()))
    local = F.row_number().over(Window.partitionBy("_p", *keys).orderBy(*order))
    counts = ranged.groupBy("_p", *keys).agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    names = [f"_k{i}" for i in range(len(keys))]
    offsets = counts.withColumn("_before", before).select(F.col("_p").alias("_q"), *(F.col(k).alias(n) for k, n in zip(keys, names)), "_before")
    same = F.col("_p") == F.col("_q")
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return ranged.withColumn(name, local).join(offsets, same).select(*df.columns, (F.col(name) + F.col("_before")).cast("bigint").alias(name))


def ordered_fold(df: DataFrame, key: str, order: list[str], make: Callable[[], Callable[[tuple], list[tuple]]], schema: str, finish: bool = False) -> DataFrame:
    """For each key, calls ``make()`` for a step function, and the step with each row in order; its rows are returned.

    With ``finish``, the step is also called with None after the key's last row. The first column must be the key.
    """
    columns = df.columns
    assert columns[0] == key
    names = [x.split()[0] for x in schema.split(", ")]
    fields = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, now, begun = None, None, False
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or row[0] != now:
                    if begun and finish:
                        out += [(now, *r) for r in step(None)]
                    step, now, begun = make(), row[0], True
                out += [(now, *r) for r in step(row)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], arrow.field(k).type) for k in range(len(names))], schema=arrow)
        if begun and finish and (rest := [(now, *r) for r in step(None)]):
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rest], arrow.field(k).type) for k in range(len(names))], schema=arrow)

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in their first ``n`` columns, as tables."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(n))))
        at = 0
        for k in range(1, len(keys) + 1):
            if k < len(keys) and keys[k] == keys[at]:
                continue
            if held and now != keys[at]:
                yield pa.Table.from_batches(held)
                held = []
            now = keys[at]
            held.append(batch.slice(at, k - at))
            at = k
    if held:
        yield pa.Table.from_batches(held)


def _next_starts(amounts: np.ndarray, n: int, most_rows: int, most: int) -> np.ndarray:
    """For each of the first ``n`` rows, where the next segment begins if one begins there."""
    i = np.arange(n)
    total = np.concatenate([[0], np.cumsum(amounts)])
    to = np.searchsorted(total, total[:n] + most, "right") - 1 if most > 0 else np.full(n, len(amounts))
    return np.minimum(np.maximum(to, i + 1), np.minimum(i + most_rows, len(amounts)))


def greedy_segments(df: DataFrame, key: str, order: list[str], amount: str, most_rows: int, most: int, name: str, width: int = 100_000) -> DataFrame:
    """Adds ``name``, the number of each row's segment in its key: a segment ends at ``most_rows`` rows, or where the next row
    would bring its amounts over ``most`` (0: no such limit); a row that is over by itself is a segment.

    Rows are numbered and cut into ranges of ``width``; a task takes a range, and the first ``most_rows`` rows of the next one,
    and finds for each possible first start the start at which its chain of segments leaves the range. These few entries are
    chained in order, one per range and possible start, and a second pass numbers the rows of each range from its true entry.
    Amounts must not be negative; ``order`` must not leave ties. Nulls count as 0.
    """
    if most_rows <= 0:
        raise ValueError("most_rows must be above 0")
    width = max(width, most_rows)
    numbered = number_within(df, [key], order, "_rn").withColumn("_part", F.expr(f"(_rn - 1) div {width}"))
    ahead = numbered.where((F.col("_part") > 0) & ((F.col("_rn") - 1) % width < most_rows)).withColumn("_part", F.col("_part") - 1)
    narrow = numbered.union(ahead).select(key, "_part", "_rn", F.coalesce(F.col(amount), F.lit(0)).cast("long").alias("_n"))
    ranges = narrow.repartition(key, "_part").sortWithinPartitions(key, "_part", "_rn")
    kind = df.schema[key].dataType
    long = lambda *names: StructType([StructField(key, kind), *(StructField(n, LongType()) for n in names)])

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 2):
            part, rn, amounts = g["_part"][0].as_py(), g["_rn"].to_numpy(), g["_n"].to_numpy()
            base = part * width
            n = int(np.searchsorted(rn, base + width, "right"))
            to = _next_starts(amounts, n, most_rows, most).tolist()
            leave, count = list(to), [1] * n
            for i in range(n - 1, -1, -1):
                if to[i] < n:
                    leave[i], count[i] = leave[to[i]], count[to[i]] + 1
            m = 1 if part == 0 else min(n, most_rows)
            # a first row for the range itself, then its possible entries
            entry, to = np.append(-1, base + 1 + np.arange(m)), np.append(0, base + 1 + np.array(leave[:m], np.int64))
            columns = [np.full(m + 1, part), entry, to, np.append(0, count[:m])]
            same = g[key].combine_chunks().take(pa.array(np.zeros(m + 1, np.int64)))
            yield pa.RecordBatch.from_arrays([same, *map(pa.array, columns)], names=[key, "_part", "_entry", "_exit", "_count"])

    def make():
        at = {"start": 1, "done": 0}

        def step(row: tuple) -> list[tuple]:
            _, part, entry, leave, count = row
            if entry == at["start"]:
                at.update(start=leave, done=at["done"] + count)
            return [(part, at["start"], at["done"] + 1)] if entry < 0 else []

        return step

    entries = ranges.mapInArrow(chains, long("_part", "_entry", "_exit", "_count"))
    kinds = f"{key} {dict(df.dtypes)[key]}, _part long, _entry long, _first long"
    chosen = materialized(ordered_fold(entries, key, ["_part", "_entry"], make, kinds))  # a row per range

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 2):
            part, rn = g["_part"][0].as_py(), g["_rn"].to_numpy()
            base = part * width
            n = int(np.searchsorted(rn, base + width, "right"))
            to = _next_starts(g["_n"].to_numpy(), n, most_rows, most).tolist()
            # the range's first start, which may lie beyond its end
            starts, at = np.zeros(n, np.int64), g["_entry"][0].as_py() - base - 1
            while at < n:
                starts[at] = 1
                at = to[at]
            number = g["_first"][0].as_py() - 1 + np.cumsum(starts)
            yield pa.RecordBatch.from_arrays([g[key].slice(0, n).combine_chunks(), pa.array(rn[:n]), pa.array(number)], names=[key, "_rn", name])

    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in (key, "_part")]
    joined = narrow.alias("r").join(chosen.alias("e"), same[0] & same[1]).select(f"r.{key}", "r._part", "r._rn", "r._n", "e._entry", "e._first")
    segments = joined.repartition(key, "_part").sortWithinPartitions(key, "_part", "_rn").mapInArrow(number, long("_rn", name))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (key, "_rn")]
    return numbered.alias("l").join(segments.alias("s"), same[0] & same[1]).select(*(f"l.{c}" for c in df.columns), f"s.{name}")
