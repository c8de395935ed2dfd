"""Loop spans and kernel densities of lengths and spans, per class."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.genomic import group_bins
from strandloom.storage import materialise, maybe_broadcast

#: Reach of the kernel in bandwidths; what lies beyond is below 2e-8 of its height.
REACH = 6


def loop_spans(pairs: DataFrame, anchor: int = 5_000) -> DataFrame:
    """Loops: contacts of one chromosome whose anchors fall into the same two bins of `anchor` bases.

    pairs: chr, start_1, end_1, start_2, end_2. Columns chr, bin_1, bin_2, `pets` (contacts), `span`
    (largest floor of the distance of the midpoints) and `log_span` and `log_pets` (log10; null for a
    span below 1). Pairs with a null position count nothing; an empty table gives no rows.
    """
    at = pairs.dropna(subset=["chr", "start_1", "end_1", "start_2", "end_2"]).select(
        "chr",
        F.expr(f"(start_1 + end_1) div {2 * anchor}").alias("bin_1"),
        F.expr(f"(start_2 + end_2) div {2 * anchor}").alias("bin_2"),
        F.floor((F.col("start_2") + F.col("end_2") - F.col("start_1") - F.col("end_1")) / 2).alias("span"),
    )
    return _logs(at.groupBy("chr", "bin_1", "bin_2").agg(F.count(F.lit(1)).alias("pets"), F.max("span").alias("span")))


def group_loop_spans(df: DataFrame, keys: list[str], anchor: int = 5_000) -> DataFrame:
    """The columns of loop_spans from all pairs of fragments of a group and chromosome, however far apart; bin_1 <= bin_2."""
    return _logs(group_bins(df, keys, anchor).withColumnRenamed("n", "pets"))


def _logs(loops: DataFrame) -> DataFrame:
    return loops.withColumn("log_span", F.when(F.col("span") > 0, F.log10(F.col("span").cast("double")))).withColumn("log_pets", F.log10(F.col("pets").cast("double")))


def density(df: DataFrame, value: str, by: str | None = None, points: int = 512, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density of `value` per class `by`: by, x, density at `points` places.

    The places run from three bandwidths below the smallest value to three above the largest. Without
    `bandwidth` it is 0.9 * min(deviation, quartile range / 1.34) * n ** -0.2 per class (where that is
    0 the deviation alone counts, then 1). Values are first summed map-side into `points` bins, each shared between its two
    neighbours, so that only those sums are smoothed: points * points rows a class at most.

    Null and NaN values and null classes are left out, repeated rows count each, a class with one
    value has one bump. Other columns make no difference; an empty table gives no rows.
    """
    own = F.col(by).alias("_by") if by else F.lit(0).alias("_by")
    rows = df.select(own, F.col(value).cast("double").alias("_v")).filter("_by is not null and _v is not null and not isnan(_v)")
    quartiles = F.percentile_approx("_v", [0.25, 0.75], 10_000)
    facts = rows.groupBy("_by").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"), F.coalesce(F.stddev_samp("_v"), F.lit(0.0)).alias("_sd"), quartiles.alias("_q"))
    spread = F.least("_sd", (F.col("_q")[1] - F.col("_q")[0]) / 1.34)
    spread = F.when(spread > 0, spread).when(F.col("_sd") > 0, F.col("_sd")).otherwise(1.0)
    width = F.lit(float(bandwidth)) if bandwidth else 0.9 * spread * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    scale = facts.withColumn("_bw", width).select("_by", "_n", "_bw", (F.col("_least") - 3 * F.col("_bw")).alias("_lo"), ((F.col("_most") - F.col("_least") + 6 * F.col("_bw")) / (points - 1)).alias("_step"))
    scale = maybe_broadcast(materialise(scale, "density"))
    place = (F.col("_v") - F.col("_lo")) / F.col("_step")
    binned = rows.join(scale.select("_by", "_lo", "_step"), "_by").select("_by", F.floor(place).cast("int").alias("_bin"), (place - F.floor(place)).alias("_upper"))
    sums = binned.groupBy("_by", "_bin").agg(F.count(F.lit(1)).alias("_k"), F.sum("_upper").alias("_u"))
    shared = F.array(F.struct(F.col("_bin").alias("at"), (F.col("_k") - F.col("_u")).alias("w")), F.struct((F.col("_bin") + 1).alias("at"), F.col("_u").alias("w")))
    weights = sums.select("_by", F.explode(shared).alias("s")).groupBy("_by", F.col("s.at").alias("_at")).agg(F.sum("s.w").alias("_w")).join(scale, "_by")
    reach = F.ceil(REACH * F.col("_bw") / F.col("_step")).cast("int")
    touched = F.sequence(F.greatest(F.lit(0), F.col("_at") - reach), F.least(F.lit(points - 1), F.col("_at") + reach))
    smeared = weights.withColumn("_to", F.explode(touched))
    off = (F.col("_to") - F.col("_at")) * F.col("_step") / F.col("_bw")
    height = F.col("_w") * F.exp(-off * off / 2) / (F.col("_n") * F.col("_bw") * math.sqrt(2 * math.pi))
    heights = smeared.groupBy("_by", "_to").agg(F.sum(height).alias("density"))
    # places out of reach of every value have density 0
    places = scale.select("_by", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("_to"), (F.col("_lo") + F.col("_to") * F.col("_step")).alias("x"))
    out = places.join(heights, ["_by", "_to"], "left").withColumn("density", F.coalesce("density", F.lit(0.0)))
    return out.select(*([F.col("_by").alias(by)] if by else []), "x", "density")


def density_mode(dense: DataFrame, by: str | None = None) -> DataFrame:
    """Where each class is densest: by, mode (the smallest such place)."""
    best = F.max_by("x", F.struct("density", -F.col("x"))).alias("mode")
    return dense.groupBy(by).agg(best) if by else dense.agg(best)
