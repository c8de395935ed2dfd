"""Cells: count matrices, empty droplets, doublets, barcode ranks, synchronisation and UMIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.genomic import overlaps

PEAK = ["chr", "start_pos", "end_pos"]


def peak_cell_counts(frags: DataFrame, peaks: DataFrame) -> DataFrame:
    """Fragments of each cell over each peak: chr, start_pos, end_pos (of the peak), cell, n."""
    hits = overlaps(frags.select(*PEAK, "cell"), peaks.select(*PEAK))
    return hits.groupBy(F.col("chr_b").alias("chr"), F.col("start_pos_b").alias("start_pos"), F.col("end_pos_b").alias("end_pos"), "cell").agg(F.count(F.lit(1)).alias("n"))


def _ids(distinct: DataFrame, by: list[str], name: str) -> DataFrame:
    """1, 2, ... in the order of `by`, as sums over the sizes of hash-free ranges of the order.

    Rows are ranked inside range partitions (one per task, by sampling), to which the sizes of the
    partitions before are added, so no task holds all of them.
    """
    from strandloom.storage import materialise

    ordered = materialise(distinct.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id()), "ids")
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.withColumn("_before", F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).drop("_size")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*by))
    return ordered.withColumn("_row", inside).join(F.broadcast(before), "_part").select(*distinct.columns, (F.col("_before") + F.col("_row")).alias(name))


def matrix(counts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries i, j, v; peaks with i; cells with j) of the counts, ids 1.. in the order of the keys."""
    peaks = _ids(counts.select(*PEAK).distinct(), PEAK, "i")
    cells = _ids(counts.select("cell").distinct(), ["cell"], "j")
    entries = counts.join(peaks, PEAK).join(cells, "cell").select("i", "j", F.col("n").alias("v"))
    return entries, peaks, cells


def matrix_dims(counts: DataFrame) -> DataFrame:
    """Header of the matrix: peaks, cells, nnz."""
    return counts.agg(F.countDistinct(*PEAK).alias("peaks"), F.countDistinct("cell").alias("cells"), F.count(F.lit(1)).alias("nnz"))


def filtered(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Counts of the cells of a list only (semi join)."""
    return counts.join(cells.select("cell"), "cell", "left_semi")


def similarity(df: DataFrame) -> DataFrame:
    """Pairs of cells (a, b) and how many distinct starts of a are ends of b plus the reverse.

    An equi-join of distinct starts with distinct ends on (chr, position); only pairs that meet
    appear. A cell with itself counts each meeting twice. Where many cells start and end at one
    position, all their pairs are part of the result; AQE splits such a position over tasks.
    """
    starts = df.select("cell", "chr", F.col("start_pos").alias("p")).distinct()
    ends = df.select(F.col("cell").alias("other"), "chr", F.col("end_pos").alias("p")).distinct()
    met = starts.join(ends, ["chr", "p"]).groupBy("cell", "other").agg(F.count(F.lit(1)).alias("n"))
    ways = F.array(F.struct(F.col("cell").alias("a"), F.col("other").alias("b")), F.struct(F.col("other").alias("a"), F.col("cell").alias("b")))
    return met.select(F.explode(ways).alias("w"), "n").groupBy("w.a", "w.b").agg(F.sum("n").alias("n"))


def keep_singlets(df: DataFrame) -> DataFrame:
    """Cells more like themselves than like any other; among equals the smallest cell counts.

    A cell that meets nothing is kept only if it is the first cell, as its row of zeros has its
    maximum there.
    """
    cells = df.select("cell").distinct()
    best = similarity(df).groupBy("a").agg(F.max_by("b", F.struct("n", (-F.col("b").cast("bigint")).alias("o"))).alias("best"))
    first = cells.agg(F.min("cell").alias("first"))
    return cells.join(best, cells["cell"] == best["a"], "left").join(F.broadcast(first)).filter(F.coalesce("best", "first") == F.col("cell")).select("cell")


def rank_curve(totals: DataFrame, lower: int = 100, exclude: int = 50) -> DataFrame:
    """The curve of log10 total over log10 tie-averaged rank, with the slope to the next point.

    totals: `total` per cell. A point per distinct total above `lower`: total, rank, x, y, slope, and
    `skipped` for the first points (those up to the rank `exclude`, but never the last one).
    The table of distinct totals is small against the cells: its size is bounded by the square
    root of twice the number of fragments.
    """
    points = totals.filter(F.col("total") > lower).groupBy("total").agg(F.count(F.lit(1)).alias("k"))
    w = Window.orderBy(F.desc("total"))
    ranked = points.withColumn("rank", F.sum("k").over(w) - (F.col("k") - 1) / 2.0)
    curve = ranked.withColumn("x", F.log10("rank")).withColumn("y", F.log10(F.col("total").cast("double")))
    step = (F.lead("y").over(w) - F.col("y")) / (F.lead("x").over(w) - F.col("x"))
    place = F.row_number().over(w)
    steps = F.count(F.lit(1)).over(Window.partitionBy()) - 1
    early = F.sum((F.col("x") <= F.log10(F.lit(float(exclude)))).cast("int")).over(Window.partitionBy())
    return curve.withColumn("slope", step).withColumn("skipped", place <= F.least(steps - 1, early)).select("total", "k", "rank", "x", "y", "slope", "skipped")


def inflection(totals: DataFrame, lower: int = 100, exclude: int = 50) -> DataFrame:
    """The total where the curve falls most steeply (one row, null where there are under 3 points)."""
    curve = rank_curve(totals, lower, exclude)
    steepest = F.min_by("total", F.struct("slope", F.col("rank"))).alias("inflection")
    enough = curve.withColumn("_points", F.count(F.lit(1)).over(Window.partitionBy()))
    return enough.filter("slope is not null and not skipped and _points >= 3").agg(steepest)


def knee(totals: DataFrame, lower: int = 100, exclude: int = 50) -> DataFrame:
    """The total of least curvature between the flattest and the steepest step of the curve (one row).

    Slope and curvature are differences over neighbouring points. Where fewer than four points lie
    from the flattest step up to the steepest one, it is the total of the flattest.
    """
    by_x, all_ = Window.orderBy("x"), Window.partitionBy()
    curve = rank_curve(totals, lower, exclude).withColumn("i", F.row_number().over(by_x)).withColumn("before", F.lag("slope").over(by_x)).withColumn("wide", (F.lead("x").over(by_x) - F.lag("x").over(by_x)) / 2)
    usable = F.when(F.col("slope").isNotNull() & ~F.col("skipped"), F.col("i"))
    left, right = F.max_by(usable, F.when(usable.isNotNull(), F.struct("slope", -F.col("i")))), F.min_by(usable, F.when(usable.isNotNull(), F.struct("slope", "i")))
    inside = curve.withColumn("l", left.over(all_)).withColumn("r", right.over(all_)).filter("i >= l and i < greatest(r, l + 1)")
    bend = ((F.col("slope") - F.col("before")) / F.col("wide")) / F.pow(1 + F.pow((F.col("slope") + F.col("before")) / 2, 2), 1.5)
    bent = inside.withColumn("bend", F.when(F.col("r") - F.col("l") >= 4, bend))
    return bent.agg(F.coalesce(F.min_by("total", F.when(F.col("bend").isNotNull(), F.struct("bend", "i"))), F.min_by("total", "i")).alias("knee"))


def called(totals: DataFrame, lower: int = 100, exclude: int = 50) -> DataFrame:
    """Cells with at least the total of the inflection."""
    return totals.join(F.broadcast(inflection(totals, lower, exclude))).filter("total >= inflection").select("cell", "total")


def empty_droplets(counts: DataFrame, ambient: int = 100, rounds: int = 10_000, fdr: float = 0.001, seed: int = 1) -> DataFrame:
    """Cells unlike the ambient profile: cell, total, p, q, called.

    counts: cell, feature, n; materialised, as it is read several times. The profile is the share of
    each feature among cells of up to `ambient` molecules (each feature gets one more, so none is
    impossible). A cell's statistic is the multinomial log-likelihood of its counts; its p-value comes
    from `rounds` draws of the same total from the profile; q is by Benjamini and Hochberg. As p is
    1 / (rounds + 1) at least, a smaller `fdr` than that is refused.

    A draw goes on to the largest total, and its first molecules are the draw of each smaller total.
    Features of equal share are alike to a draw, so tasks need only how many there are of each share
    (whose number is bounded by the square root of twice the ambient molecules), not the features.
    """
    if fdr * (rounds + 1) < 1:
        raise ValueError(f"{rounds} rounds can't call a cell at fdr {fdr}")
    from strandloom.storage import materialise

    totals = counts.groupBy("cell").agg(F.sum("n").alias("total"))
    low = counts.join(totals.filter(F.col("total") <= ambient), "cell", "left_semi")
    profile = materialise(counts.select("feature").distinct().join(low.groupBy("feature").agg(F.sum("n").alias("k")), "feature", "left").select("feature", (F.coalesce("k", F.lit(0)) + 1).cast("bigint").alias("k")), "profile")
    alike = [(r.k, r.features) for r in profile.groupBy("k").agg(F.count(F.lit(1)).alias("features")).orderBy("k").collect()]
    whole = sum(k * m for k, m in alike)
    big = totals.filter(F.col("total") > ambient)
    term = F.col("n") * F.log(F.col("k") / F.lit(float(whole or 1))) - F.expr("aggregate(sequence(1, cast(n as int)), 0D, (a, x) -> a + ln(x))")
    seen = materialise(counts.join(big, "cell").join(profile, "feature").groupBy("cell", "total").agg(F.sum(term).alias("ll")), "seen")
    sizes = [int(r.total) for r in seen.select("total").distinct().orderBy("total").collect()]

    def draw(batches):
        import numpy as np
        import pyarrow as pa

        if not sizes:
            return
        k, features = (np.array(x, np.int64) for x in zip(*alike))
        upto, first = np.cumsum(k * features), np.cumsum(features) - features
        weight, logs = np.log(k / whole), np.log(np.arange(1, sizes[-1] + 1))
        ends = np.array(sizes)
        for batch in batches:
            for r in batch.column(0).to_pylist():
                at = np.random.default_rng([seed, r]).integers(0, whole, sizes[-1])
                kind = np.searchsorted(upto, at, side="right")
                feature = first[kind] + (upto[kind] - 1 - at) // k[kind]
                order = np.argsort(feature, kind="stable")
                new = np.flatnonzero(np.diff(feature[order], prepend=-1))
                again = np.empty(len(at), np.int64)
                again[order] = np.arange(len(at)) - np.repeat(new, np.diff(new, append=len(at)))
                ll = np.cumsum(weight[kind] - logs[again])
                yield pa.RecordBatch.from_arrays([pa.array(ends), pa.array(ll[ends - 1])], ["total", "ll"])

    spark = counts.sparkSession
    draws = spark.range(0, rounds, 1, min(rounds, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(draw, "total bigint, ll double")
    # a draw as likely as the cell counts as below it; the sums differ in their last digits
    both = seen.select("cell", F.col("total").cast("bigint").alias("total"), (F.col("ll") + 1e-7).alias("ll"), F.lit(0).alias("drawn")).unionByName(draws.withColumn("drawn", F.lit(1)), allowMissingColumns=True)
    below = F.sum("drawn").over(Window.partitionBy("total").orderBy("ll", F.desc("drawn")).rowsBetween(Window.unboundedPreceding, 0))
    tested = materialise(both.withColumn("below", below).filter("drawn = 0").select("cell", "total", ((F.col("below") + 1) / F.lit(rounds + 1.0)).alias("p")), "tested")
    # Benjamini and Hochberg over the distinct p-values, of which there are rounds + 1 at most
    levels = tested.groupBy("p").agg(F.count(F.lit(1)).alias("k"))
    upto, down = Window.orderBy("p"), Window.orderBy(F.desc("p"))
    q = levels.withColumn("upto", F.sum("k").over(upto)).withColumn("m", F.sum("k").over(Window.partitionBy())).withColumn("q", F.least(F.lit(1.0), F.min(F.col("p") * F.col("m") / F.col("upto")).over(down))).select("p", "q")
    return tested.join(F.broadcast(q), "p").select("cell", "total", "p", "q", (F.col("q") <= fdr).alias("called"))


def synchronise(atac: DataFrame, rna: DataFrame, key: str = "idb_key", cell: str = "cell") -> DataFrame:
    """`atac` with the RNA cell of the same barcode key, or ATAC- and its own cell where there is none."""
    other = rna.select(key, F.col(cell).alias("_rna"))
    return atac.join(other, key, "left").withColumn(cell, F.coalesce("_rna", F.concat(F.lit("ATAC-"), F.col(cell)))).drop("_rna")


def synchronised_only(df: DataFrame, cell: str = "cell") -> DataFrame:
    """Rows of cells that were found in both."""
    return df.filter(~F.col(cell).startswith("ATAC-"))


def lookup(df: DataFrame, table: DataFrame, on: str, value: str, missing: str = "-") -> DataFrame:
    """`df` with `value` of `table`, or `missing`."""
    return df.join(table.select(on, value), on, "left").withColumn(value, F.coalesce(value, F.lit(missing)))


def umi_counts(reads: DataFrame) -> DataFrame:
    """Distinct UMIs of each (cell, gene)."""
    return reads.groupBy("cell", "gene").agg(F.countDistinct("umi").alias("umis"))


def one_gene_per_umi(reads: DataFrame) -> DataFrame:
    """(cell, umi, gene, n): of the genes of a UMI the one with most reads; a tie drops the UMI."""
    n = reads.groupBy("cell", "umi", "gene").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cell", "umi")
    best = n.withColumn("_best", F.max("n").over(w)).filter("n = _best").withColumn("_ties", F.count(F.lit(1)).over(w))
    return best.filter("_ties = 1").select("cell", "umi", "gene", "n")


def collapse_umis(counted: DataFrame) -> DataFrame:
    """UMIs left of each (cell, gene) after those with a one-mismatch neighbour of higher count go.

    counted: cell, gene, umi, n. Equal counts: the smaller text stays. A UMI is joined to the ones
    that differ in one place by an equi-join on the UMI with that place blanked.
    """
    masked = F.transform(F.sequence(F.lit(1), F.length("umi")), lambda i: F.concat(F.substr("umi", F.lit(1), i - 1), F.lit("_"), F.substr(F.col("umi"), i + 1)))
    keyed = counted.filter(F.length("umi") > 0).select("cell", "gene", "umi", "n", F.explode(masked).alias("mask"))
    w = Window.partitionBy("cell", "gene", "mask").orderBy(F.desc("n"), "umi")
    weaker = keyed.withColumn("_place", F.row_number().over(w)).filter("_place > 1").select("cell", "gene", "umi").distinct()
    return counted.join(weaker, ["cell", "gene", "umi"], "left_anti").groupBy("cell", "gene").agg(F.count(F.lit(1)).alias("umis"))
