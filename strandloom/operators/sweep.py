"""Covered periods and gaps of intervals that overlap, nest, touch or lie apart.

Sweep line: an interval is a +1 event at its start and a -1 event at its end; the prefix sum of the
events is the number of active intervals. A period begins where it leaves zero and ends where it
returns to zero; the stretch up to the next event is a gap.

A group is swept by one window. Groups too large for that (found by sketch on a hash of the key)
are swept in blocks of positions: each block's prefix sum starts from the sum of the blocks before
it, which is a table of one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.skew import heavy_values, split_heavy
from strandloom.storage import materialise

#: Positions in a block of a heavy group; at most twice as many events, once they are summed by position.
BLOCK = 1 << 20


def _edges(active: Column, delta: Column) -> Column:
    return (active == 0) | (active == delta)


def _light(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One shuffle on the keys; events, their sums and the sweep stay in the partition."""
    events = (
        rows.repartition(*keys)
        .select(*keys, F.explode(F.array(F.struct(F.col("_lo").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("_hi").alias("pos"), F.lit(-1).alias("d")))).alias("e"))
        .groupBy(*keys, F.col("e.pos").alias("_pos"))
        .agg(F.sum("e.d").alias("_delta"))
        .filter("_delta <> 0")
    )
    w = Window.partitionBy(*keys).orderBy("_pos")
    return (
        events.withColumn("_active", F.sum("_delta").over(w))
        .filter(_edges(F.col("_active"), F.col("_delta")))
        .withColumn("_next", F.lead("_pos").over(w))
    )


def _heavy(rows: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Blocked prefix sums; no task sees more than one block of a group."""
    both = rows.select(*keys, F.explode(F.array(F.struct(F.col("_lo").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("_hi").alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    events = (
        both.select(*keys, F.expr(f"(e.pos - pmod(e.pos, {block}L)) div {block}L").alias("_block"), F.col("e.pos").alias("_pos"), F.col("e.d").alias("_d"))
        .groupBy(*keys, "_block", "_pos")
        .agg(F.sum("_d").alias("_delta"))
        .filter("_delta <> 0")
    )
    blocks = Window.partitionBy(*keys).orderBy("_block")
    inside = Window.partitionBy(*keys, "_block").orderBy("_pos")
    carried = (
        events.groupBy(*keys, "_block")
        .agg(F.sum("_delta").alias("_sum"))
        .withColumn("_carry", F.sum("_sum").over(blocks) - F.col("_sum"))
        .drop("_sum")
    )
    edges = (
        events.join(carried, [*keys, "_block"])
        .withColumn("_active", F.col("_carry") + F.sum("_delta").over(inside))
        .filter(_edges(F.col("_active"), F.col("_delta")))
    )
    first = edges.groupBy(*keys, "_block").agg(F.min("_pos").alias("_first")).withColumn("_after", F.lead("_first").over(blocks)).drop("_first")
    return (
        edges.withColumn("_next", F.lead("_pos").over(inside))
        .join(first, [*keys, "_block"])
        .withColumn("_next", F.coalesce("_next", "_after"))
        .select(*keys, "_pos", "_delta", "_active", "_next")
    )


def sweep(df: DataFrame, keys: list[str], start: str, end: str, support: float | None = None, block: int = BLOCK) -> DataFrame:
    """Periods and gaps of each group: columns keys, `kind` ('period' or 'gap'), `start_pos`, `end_pos` (bigint).

    An interval runs from the smaller to the larger of the two positions, half-open. Intervals with
    a null position, of length 0, or with a null key are left out. Touching intervals make one
    period. Repeated rows and other columns make no difference; an empty table gives no rows.

    The intervals are written once, for the sketch and the two kinds of groups that read them.
    """
    lo, hi = F.least(start, end), F.greatest(start, end)
    rows = (
        df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
        .select(*keys, lo.cast("bigint").alias("_lo"), hi.cast("bigint").alias("_hi"))
        .filter("_lo < _hi")
        .dropna(subset=keys)
    )
    hashed = materialise(rows.withColumn("_group", F.xxhash64(*keys)), "intervals")
    values = heavy_values(hashed, "_group", support)
    out = _light(hashed.drop("_group"), keys)
    if values:
        hot, cold = split_heavy(hashed, "_group", values=values)
        out = _light(cold.drop("_group"), keys).unionByName(_heavy(hot.drop("_group"), keys, block))
    return out.filter("_next is not null").select(*keys, F.when(F.col("_active") > 0, "period").otherwise("gap").alias("kind"), F.col("_pos").alias("start_pos"), F.col("_next").alias("end_pos"))
