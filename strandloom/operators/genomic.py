"""Coverage, peaks, overlaps and contact bins."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions of a block of the prefix sums along a chromosome.
BLOCK = 1 << 20
#: Pairs of bins that a task works on at once.
SLICE = 1 << 20
#: Bases of a band of left bins, where groups have up to HELD bins; rows that a task returns at once.
BAND, HELD, BATCH = 10_000_000, 20_000_000, 1 << 17
#: Of each bin of a group: fragments; for spans also the least sum of start and end and how far those lie apart.
_COUNTED, _SPANNED = ("bin", "n"), ("bin", "n", "lo", "wide")


def coverage(df: DataFrame, keys: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """Maximal runs of equal depth above 0: keys, chr, start_pos, end_pos, depth.

    Intervals are half-open; those without length or with nulls count nothing. Depth is a prefix sum
    of +1 and -1 events in blocks of positions, each with the sum of the blocks before it, so that a
    chromosome is worked on by many tasks.
    """
    keys = [*(keys or []), "chr"]
    rows = df.filter("start_pos < end_pos and chr is not null")
    events = (
        rows.select(*keys, F.explode(F.array(F.struct(F.col("start_pos").alias("p"), F.lit(1).alias("d")), F.struct(F.col("end_pos").alias("p"), F.lit(-1).alias("d")))).alias("e"))
        .select(*keys, F.expr(f"(e.p - pmod(e.p, {block}L)) div {block}L").alias("_block"), F.col("e.p").alias("p"), F.col("e.d").alias("d"))
        .groupBy(*keys, "_block", "p")
        .agg(F.sum("d").alias("d"))
        .filter("d <> 0")
    )
    along = Window.partitionBy(*keys).orderBy("_block")
    totals = events.groupBy(*keys, "_block").agg(F.sum("d").alias("_sum"), F.min("p").alias("_first"))
    totals = totals.withColumn("_carry", F.sum("_sum").over(along) - F.col("_sum")).withColumn("_after", F.lead("_first").over(along)).select(*keys, "_block", "_carry", "_after")
    inside = Window.partitionBy(*keys, "_block").orderBy("p")
    runs = events.withColumn("_depth", F.sum("d").over(inside)).withColumn("_next", F.lead("p").over(inside)).join(totals, [*keys, "_block"])
    depth = F.col("_depth") + F.col("_carry")
    return runs.select(*keys, F.col("p").alias("start_pos"), F.coalesce("_next", "_after").alias("end_pos"), depth.alias("depth")).filter("depth > 0")


def peaks(runs: DataFrame, keys: list[str] | None = None, cutoff: int = 5, min_length: int = 200, max_gap: int = 30, block: int = BLOCK) -> DataFrame:
    """Stretches of depth >= cutoff, joined over gaps of up to max_gap, at least min_length long.

    Columns: keys, chr, start_pos, end_pos, summit (largest depth). Runs are joined inside blocks of
    positions, of which only the joined stretches are written; from the blocks before, a block takes
    where the last run ends and where the last stretch begins, so that a chromosome is worked on by
    many tasks.
    """
    from strandloom.storage import materialise

    keys = [*(keys or []), "chr"]
    high = runs.filter(F.col("depth") >= cutoff).select(*keys, "start_pos", "end_pos", "depth", F.expr(f"(start_pos - pmod(start_pos, {block}L)) div {block}L").alias("_block"))
    along = Window.partitionBy(*keys).orderBy("_block")
    inside = Window.partitionBy(*keys, "_block").orderBy("start_pos")
    # where stretches begin inside a block; its first one is told by the block before
    begun = high.withColumn("_begin", F.when(F.col("start_pos") - F.lag("end_pos").over(inside) > max_gap, F.col("start_pos"))).withColumn("_at", F.max("_begin").over(inside))
    whole = [F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.max("summit").alias("summit")]
    parts = materialise(begun.withColumnRenamed("depth", "summit").groupBy(*keys, "_block", "_at").agg(*whole), "stretches")
    blocks = parts.groupBy(*keys, "_block").agg(F.min("start_pos").alias("_first"), F.max("end_pos").alias("_end"), F.max("_at").alias("_last"))
    apart = F.coalesce(F.col("_first") - F.lag("_end").over(along) > max_gap, F.lit(True))
    blocks = blocks.withColumn("_opens", F.when(apart, F.col("_first"))).withColumn("_m", F.coalesce("_last", "_opens"))
    carried = blocks.select(*keys, "_block", F.coalesce("_opens", F.max("_m").over(along.rowsBetween(Window.unboundedPreceding, -1))).alias("_carry"))
    placed = parts.join(carried, [*keys, "_block"]).withColumn("_at", F.coalesce("_at", "_carry"))
    found = placed.groupBy(*keys, "_at").agg(*whole)
    return found.filter(F.col("end_pos") - F.col("start_pos") >= min_length).drop("_at")


def _binned(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    first, last = F.expr(f"{start} div {width}"), F.expr(f"({end} - 1) div {width}")
    return df.withColumn("_bin", F.explode(F.sequence(first, last)))


def overlaps(left: DataFrame, right: DataFrame, width: int = 1 << 16) -> DataFrame:
    """Rows of `left` with each row of `right` (columns suffixed _b) that shares a base with it.

    Both have chr, start_pos, end_pos. Equi-join on (chr, bin); a pair is kept only in the bin of
    the later start, so it comes once. Empty and reversed intervals overlap nothing.
    """
    a = _binned(left.filter("start_pos < end_pos"), "start_pos", "end_pos", width)
    b = _binned(right.filter("start_pos < end_pos").select(*[F.col(c).alias(f"{c}_b") for c in right.columns]), "start_pos_b", "end_pos_b", width)
    joined = a.join(b, (a["chr"] == b["chr_b"]) & (a["_bin"] == b["_bin"]) & (a["start_pos"] < b["end_pos_b"]) & (b["start_pos_b"] < a["end_pos"]) & (a["_bin"] == F.expr(f"greatest(start_pos, start_pos_b) div {width}")))
    return joined.select(*[a[c] for c in left.columns], *[b[f"{c}_b"] for c in right.columns])


def without_overlap(left: DataFrame, right: DataFrame, key: str, width: int = 1 << 16) -> DataFrame:
    """Rows of `left` that share no base with any row of `right`; `key` tells its rows apart."""
    hit = overlaps(left.select(key, "chr", "start_pos", "end_pos"), right.select("chr", "start_pos", "end_pos"), width).select(key).distinct()
    return left.join(hit, key, "left_anti")


def contact_bins(pairs: DataFrame, resolutions: list[int]) -> DataFrame:
    """Contacts (chr_1, mid_1, chr_2, mid_2) counted per pair of bins at each resolution."""
    at = pairs.withColumn("resolution", F.explode(F.array(*[F.lit(r).cast("bigint") for r in resolutions])))
    return at.groupBy("resolution", "chr_1", F.expr("mid_1 div resolution").alias("bin_1"), "chr_2", F.expr("mid_2 div resolution").alias("bin_2")).agg(F.count(F.lit(1)).alias("n"))


def group_bins(df: DataFrame, keys: list[str], width: int) -> DataFrame:
    """All pairs of fragments of one group and chromosome, by the bins of their midpoints.

    Columns chr, bin_1 <= bin_2, n (pairs) and span (largest floor of the distance of the midpoints).
    Fragments with a null position count nothing.
    """
    return _cells(df, keys, [width], F.col("chr"), spans=True).select("chr", "bin_1", "bin_2", "n", "span")


def group_contacts(df: DataFrame, keys: list[str], resolutions: list[int], placed: bool = False) -> DataFrame:
    """Contacts of all pairs of fragments of a group and chromosome per pair of bins at each resolution.

    Columns as of contact_bins, with bin_1 <= bin_2, as the map is symmetric; no list of pairs is
    made and none is left out for its distance. `placed`: all rows of a group and chromosome lie in one
    partition already, so that they need no shuffle here.
    """
    cells = _cells(df, keys, resolutions, F.expr("trim(both 'chr' from chr)"), placed=placed)
    return cells.select("resolution", F.col("chr").alias("chr_1"), "bin_1", F.col("chr").alias("chr_2"), "bin_2", "n")


def _cells(df: DataFrame, keys: list[str], resolutions: list[int], name: Column, spans: bool = False, placed: bool = False) -> DataFrame:
    """resolution, chr (`name`), bin_1, bin_2, n, with `spans` also span of the pairs of fragments of one group and chr.

    Fragments are counted per group and bin. What is shuffled are those counts, not the pairs: a task
    gets bands of a chromosome, with the bins of each group from its first one in the band on, and so
    holds all pairs whose left bin lies there. A band is a multiple of all resolutions. Bands get
    narrower with the number of bins, so that a task holds about as many; a group's counts on a
    chromosome go to each band in which it has bins.
    """
    from strandloom.storage import materialise

    levels = sorted({int(r) for r in resolutions})
    base, common = math.gcd(*levels), math.lcm(*levels)
    columns = _SPANNED if spans else _COUNTED
    both = df.dropna(subset=["chr", "start_pos", "end_pos"]).select(*keys, "chr", (F.col("start_pos") + F.col("end_pos")).alias("_mids"))
    both = both if placed else both.repartition(*keys, "chr")
    ends = [F.min("_mids").alias("lo"), (F.max("_mids") - F.min("_mids")).alias("wide")] if spans else []
    bins = both.groupBy(*keys, "chr", F.floor(F.col("_mids") / (2 * base)).alias("bin")).agg(F.count(F.lit(1)).alias("n"), *ends)
    groups = bins.groupBy(*keys, "chr").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("b"))
    several = groups.filter("size(b) > 1 or b[0].n > 1").select(name.alias("chr"), *[F.col(f"b.{c}").alias(c) for c in columns])
    written = materialise(several, "groups")
    held = written.agg(F.coalesce(F.sum(F.size("bin")), F.lit(0))).first()[0]
    band = common * max(1, round(BAND / max(1, held / HELD) / common)) // base
    tasks, at_once = 8 * df.sparkSession.sparkContext.defaultParallelism, SLICE
    lists = ", ".join(f"{c} array<bigint>" for c in columns)
    sent = written.mapInArrow(lambda batches: _to_bands(batches, columns, band, at_once), f"chr string, band bigint, k bigint, {lists}").repartition(tasks, "chr", "band").sortWithinPartitions("chr", "band")
    return sent.mapInArrow(lambda batches: _count_bands(batches, columns, base, levels, at_once), "resolution bigint, chr string, bin_1 bigint, bin_2 bigint, n bigint" + ", span bigint" * spans)


def _flat(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (count of them) for each place, one behind the other."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _to_bands(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], band: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """A row for each group and band in which it has bins: `k` bins of the band, then all behind them."""
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            flat = {c: _flat(batch, c) for c in columns}
            sizes = pc.list_value_length(batch.column("bin")).to_numpy(zero_copy_only=False).astype(np.int64)
            group, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
            at_band = np.floor_divide(flat["bin"], band)
            new = np.ones(len(group), bool)
            new[1:] = (group[1:] != group[:-1]) | (at_band[1:] != at_band[:-1])
            first = np.flatnonzero(new)
            k, count = np.diff(np.append(first, len(group))), ends[group[first]] - first
            for part in np.split(np.arange(len(first)), np.searchsorted(np.cumsum(count), np.arange(at_once, count.sum(), at_once))):
                if len(part):
                    places, offsets = _ranges(first[part], count[part]), pa.array(np.append(0, np.cumsum(count[part])), pa.int32())
                    lists = [pa.ListArray.from_arrays(offsets, pa.array(flat[c][places])) for c in columns]
                    yield pa.RecordBatch.from_arrays([batch.column("chr").take(pa.array(group[first[part]])), pa.array(at_band[first[part]]), pa.array(k[part]), *lists], names=["chr", "band", "k", *columns])


def _count_bands(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], base: int, levels: list[int], at_once: int) -> Iterator[pa.RecordBatch]:
    held, now = [], None
    for batch in batches:
        names, bands = batch.column("chr").to_pylist(), batch.column("band").to_pylist()
        first = 0
        for i in range(len(bands) + 1):
            if i < len(bands) and (names[i], bands[i]) == now:
                continue
            if i > first:
                held.append(batch.slice(first, i - first))
            if i < len(bands):
                if held:
                    yield from _count_band(held, columns, now[0], base, levels, at_once)
                held, now, first = [], (names[i], bands[i]), i
    if held:
        yield from _count_band(held, columns, now[0], base, levels, at_once)


def _summed(one: np.ndarray, two: np.ndarray, n: np.ndarray, *span: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (one, two) in order, with the sum of n and, if given, the largest span."""
    if not len(one):
        return one, two, n, *span
    least, most = min(one.min(), two.min()), max(one.max(), two.max()) + 1
    key = (one - least) * (most - least) + (two - least)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return one[order[first]], two[order[first]], np.add.reduceat(n[order], first), *(np.maximum.reduceat(x[order], first) for x in span)


def _count_band(held: list[pa.RecordBatch], columns: tuple[str, ...], name: str, base: int, levels: list[int], at_once: int) -> Iterator[pa.RecordBatch]:
    """The cells of one band at each of the `levels`, from the left bins in order.

    At most `at_once` pairs are held (or those of one bin of a group) and, at each level, the cells of the
    left bin that isn't whole yet. A level is summed from the coarsest one before it that divides it.
    """
    bins, n, *ends_of = (np.concatenate([_flat(x, c) for x in held]) for c in columns)
    sizes, k = (np.concatenate([y(x) for x in held]).astype(np.int64) for y in (lambda x: pc.list_value_length(x.column("bin")).to_numpy(zero_copy_only=False), lambda x: x.column("k").to_numpy(zero_copy_only=False)))
    ends = np.cumsum(sizes)
    left, end = _ranges(ends - sizes, k), np.repeat(ends, k)
    order = np.argsort(bins[left], kind="stable")
    left, end = left[order], end[order]
    count = end - left
    total, at = np.cumsum(count), 0
    chain = sorted({base, *levels})
    source = {r: max(x for x in chain if x < r and r % x == 0) for r in chain if r != base}
    names = ["resolution", "chr", "bin_1", "bin_2", "n", *["span"] * bool(ends_of)]
    pending: dict[int, tuple[np.ndarray, ...]] = {r: (np.zeros(0, np.int64),) * (len(names) - 2) for r in chain}
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + at_once, "right")))
        i, j = np.repeat(left[at:to], count[at:to]), _ranges(left[at:to], count[at:to])
        pairs = np.where(i == j, n[i] * (n[i] - 1) // 2, n[i] * n[j])
        i, j, pairs = i[pairs > 0], j[pairs > 0], pairs[pairs > 0]
        span = [(ends_of[0][j] + ends_of[1][j] - ends_of[0][i]) // 2] if ends_of else []
        whole = {}
        for r in chain:
            f = r // base
            new = (bins[i], bins[j], pairs, *span) if r == base else (whole[source[r]][0] // (r // source[r]), whole[source[r]][1] // (r // source[r]), *whole[source[r]][2:])
            cells = _summed(*(np.concatenate(x) for x in zip(pending[r], new)))
            cut = len(cells[0]) if to == len(left) else int(np.searchsorted(cells[0], bins[left[to]] // f))
            whole[r], pending[r] = tuple(x[:cut] for x in cells), tuple(x[cut:] for x in cells)
            if cut and r in levels:
                for p in range(0, cut, BATCH):
                    own = [pa.array(x[p : p + BATCH]) for x in whole[r]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own[0]), r)), pa.array([name] * len(own[0]), pa.string()), *own], names=names)
        at = to
