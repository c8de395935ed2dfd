"""The quality report of a method: metric and value, from its reads and what the refinement made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The metrics of each method's report.
_READS = ["Total_read_pairs", "Read_pairs_with_full_barcodes", "Fully_barcode_rate"]
_DUPLICATES = ["Total_fragments", "Duplicated_fragments", "Duplication_rate"]
METRICS = {
    "chiadrop": [*_READS, "Complex_count_at_fastq", *_DUPLICATES, "Refined_complex"],
    "sprite": [*_READS, "Complex_count_at_fastq", *_DUPLICATES, "Total_qualified_fragment"],
    "scsprite": [*_READS, "Cell_count_at_fastq", "Complex_count_at_fastq", *_DUPLICATES, "Total_qualified_fragment"],
    "rdsprite": [*_READS, "Complex_count_at_fastq", *_DUPLICATES, "Total_qualified_fragment"],
    "scatac": [*_READS, "Cell_count_at_fastq", *_DUPLICATES, "Fragments_overlap_peak", "Peak_count", "Cell_count"],
}


def share(part: Column, whole: Column) -> Column:
    """part / whole cut (not rounded) after six digits; null where whole is 0."""
    return F.floor(F.try_divide(part * 1_000_000.0, whole)) / 1_000_000.0


def report(method: str, reads: DataFrame, refined: dict[str, DataFrame]) -> DataFrame:
    """`metric` and `value` (string) of `method`, one row per metric of METRICS.

    reads: `full` (boolean; null is no), and `cell` and `complex` where the method counts them (null
    is none). refined: `dedup` with its `dup`; for chiadrop `regions` or else the groups of dedup;
    for scatac `counts` and `peaks`. Each table is read once. Empty tables give 0, and null rates.
    """
    full = F.coalesce(F.col("full"), F.lit(False))
    wanted = METRICS[method]
    ids = {"Cell_count_at_fastq": "cell", "Complex_count_at_fastq": "complex"}
    n, k = F.count(F.lit(1)), F.count_if(full)
    parts = [(reads, {"Total_read_pairs": n, "Read_pairs_with_full_barcodes": k, "Fully_barcode_rate": share(k, n)} | {m: F.countDistinct(c) for m, c in ids.items() if m in wanted})]
    total, kept = F.coalesce(F.sum("dup"), F.lit(0)), F.count(F.lit(1))
    parts.append((refined["dedup"], {"Total_fragments": total, "Duplicated_fragments": total - kept, "Duplication_rate": share(total - kept, total), "Total_qualified_fragment": kept}))
    if method == "chiadrop":
        groups, key = (refined["regions"], "sub_id") if "regions" in refined else (refined["dedup"], "gid")
        parts.append((groups, {"Refined_complex": F.countDistinct(key)}))
    if method == "scatac":
        parts.append((refined["counts"], {"Fragments_overlap_peak": F.coalesce(F.sum("n"), F.lit(0)), "Cell_count": F.countDistinct("cell")}))
        parts.append((refined["peaks"], {"Peak_count": F.count(F.lit(1))}))
    out = None
    for df, figures in parts:
        named = {m: v for m, v in figures.items() if m in wanted}
        rows = df.agg(*[v.cast("string").alias(m) for m, v in named.items()]).select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in named])).alias("m")).select("m.*")
        out = rows if out is None else out.unionByName(rows)
    return out
