"""Most frequent values by space-saving summaries, counted exactly in a second pass.

A summary has at most `counters` values. It is kept in the form that merges: for each value a lower
count, and one deduction for the whole summary; lower + deduction is the space-saving counter, an
upper bound of the count, and the deduction bounds the error of every value, absent ones included.
A merge adds both and deducts the largest dropped count from all, so that the deduction never
exceeds rows / (counters + 1) whatever the order of merging.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCHEMA = "kind string, node bigint, value string, low bigint, deducted bigint"
_ARROW = pa.schema([("kind", pa.string()), ("node", pa.int64()), ("value", pa.string()), ("low", pa.int64()), ("deducted", pa.int64())])

#: Summaries merged by one task.
FAN_IN = 32


def _shrink(values: pa.Array, low: np.ndarray, counters: int) -> tuple[pa.Array, np.ndarray, int]:
    """At most `counters` values and the count deducted from each of them."""
    if len(low) <= counters:
        return values, low, 0
    cut = int(np.partition(low, len(low) - counters - 1)[len(low) - counters - 1])
    keep = np.flatnonzero(low > cut)
    return values.take(pa.array(keep)), low[keep] - cut, cut


def _add(parts: list[tuple[pa.Array, np.ndarray]], counters: int) -> tuple[pa.Array, np.ndarray, int]:
    values = pa.concat_arrays([v for v, _ in parts])
    summed = pa.table({"v": values, "n": np.concatenate([n for _, n in parts])}).group_by("v").aggregate([("n", "sum")])
    return _shrink(summed["v"].combine_chunks(), summed["n_sum"].to_numpy(), counters)


def _rows(kind: str, node: int, values: pa.Array, low: np.ndarray, deducted: int) -> pa.RecordBatch:
    """The values, and a row without one that keeps the deduction where no value is left."""
    values, low = pa.concat_arrays([values, pa.nulls(1, pa.string())]), np.append(low, 0)
    n = len(low)
    return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.string()), pa.array(np.full(n, node)), values, pa.array(low), pa.array(np.full(n, deducted))], schema=_ARROW)


def _leaf(columns: dict[str, str], counters: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        node = TaskContext.get().partitionId()
        held = {kind: (pa.array([], pa.string()), np.zeros(0, np.int64), 0) for kind in columns}
        waiting: dict[str, list] = {kind: [] for kind in columns}

        def fold(kind: str) -> None:
            values, low, deducted = held[kind]
            values, low, cut = _add([(values, low), *waiting[kind]], counters)
            held[kind] = values, low, deducted + cut
            waiting[kind] = []

        for batch in batches:
            for kind, column in columns.items():
                seen = pc.value_counts(batch.column(column).drop_null())
                waiting[kind].append((seen.field("values").cast(pa.string()), seen.field("counts").to_numpy(zero_copy_only=False).astype(np.int64)))
                if sum(len(n) for _, n in waiting[kind]) > 4 * counters:
                    fold(kind)
        for kind in columns:
            fold(kind)
            values, low, deducted = held[kind]
            yield _rows(kind, node, values, low, deducted)

    return summarise


def _merge(counters: int):
    def merge(key: tuple, parts: pa.Table) -> pa.Table:
        kind, node = (k.as_py() for k in key)
        by_source = parts.group_by("source").aggregate([("deducted", "max")])
        named = parts.filter(pc.is_valid(parts["value"]))
        values, low, cut = _add([(named["value"].combine_chunks(), named["low"].to_numpy())], counters)
        return pa.Table.from_batches([_rows(kind, node, values, low, cut + int(pc.sum(by_source["deducted_max"]).as_py()))])

    return merge


def summary(df: DataFrame, columns: dict[str, str], counters: int) -> DataFrame:
    """One merged space-saving summary per kind: `kind`, `value`, `low`, `high`.

    columns: kind -> column of strings. Null is no value; the empty text is one. The true count of a
    value lies from `low` to `high`, that of an absent value is at most rows / (counters + 1).
    Partitions are summarised where they are; only summaries are shuffled, FAN_IN to a task.
    """
    rows = df.select(*[F.col(c).cast("string").alias(k) for k, c in columns.items()])
    nodes = rows.rdd.getNumPartitions()
    out = rows.mapInArrow(_leaf({k: k for k in columns}, counters), _SCHEMA)
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        up = out.select("kind", F.expr(f"node div {FAN_IN}").alias("node"), "value", "low", "deducted", F.col("node").alias("source"))
        out = up.groupBy("kind", "node").applyInArrow(_merge(counters), _SCHEMA)
    return out.filter("value is not null").select("kind", "value", "low", (F.col("low") + F.col("deducted")).alias("high"))


def frequent(df: DataFrame, columns: dict[str, str], one_in: int, counters: int | None = None) -> DataFrame:
    """Values in at least one of `one_in` rows: `kind`, `value`, `n` (exact), `low`, `high` (first pass).

    All rows count for the share, those with a null value too. Repeated rows count each time. An
    empty table gives no rows; columns not named in `columns` are not read. No value is missed:
    with `counters` >= one_in (10 * one_in by default) an absent value is too rare.

    The candidates whose upper bound reaches the share (at most `counters` per kind) are counted
    exactly in one more scan, by a broadcast join whose groups are summed map-side before the shuffle.
    """
    counters = counters or 10 * one_in
    if counters < one_in:
        raise ValueError("fewer counters than one_in can miss a frequent value")
    total = df.count()
    first = summary(df, columns, counters).filter(F.col("high") * one_in >= total)
    # at most `counters` rows per kind, so the list has a bound of its own
    found = df.sparkSession.createDataFrame(first.collect(), "kind string, value string, low bigint, high bigint")
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in columns.items()])).alias("v")
    counted = df.select(values).select("v.*").join(F.broadcast(found), ["kind", "value"]).groupBy("kind", "value", "low", "high").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") * one_in >= total).select("kind", "value", "n", "low", "high")
