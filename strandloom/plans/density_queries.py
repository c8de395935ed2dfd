"""Queries of loop spans, densities and the figures of RNA libraries with their SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from strandloom.operators import cells as X
from strandloom.operators import cluster as C
from strandloom.operators.density import density, density_mode, group_loop_spans, loop_spans
from strandloom.operators.genomic import coverage, peaks
from strandloom.plans.cluster_queries import ALL_PAIRS_SQL, COVERAGE, GROUP, PAIRS_SQL, PEAK, PEAKS, frag_pairs_within
from strandloom.plans.report import report
from strandloom.plans.views import FRAGS, READS, frags, reads, with_views
from strandloom.storage import materialise

ANCHOR, POINTS, BANDWIDTH = 50_000, 64, 0.1


def loop_span_pets(s, d):
    """Loops with their span and number of contacts."""
    return loop_spans(frag_pairs_within(s, d), ANCHOR).select("chr", "bin_1", "bin_2", "pets", "span", F.round("log_span", 6).alias("log_span"), F.round("log_pets", 6).alias("log_pets"))


def loop_span_pets_all(s, d):
    """Loops of all pairs of a complex on a chromosome, with no reach."""
    return group_loop_spans(frags(s, d), GROUP, ANCHOR).select("chr", "bin_1", "bin_2", "pets", "span", F.round("log_span", 6).alias("log_span"), F.round("log_pets", 6).alias("log_pets"))


def _log_spans(s, d):
    spans = C.spans(frags(s, d), ["gid", "chr"]).filter("span > 0")
    return spans.select(F.least("n", F.lit(16)).alias("class"), F.log10(F.col("span").cast("double")).alias("log_span"))


def span_density(s, d):
    """Density of log10 complex spans by number of fragments (16 stands for more than 15)."""
    return density(_log_spans(s, d), "log_span", "class", POINTS, BANDWIDTH).select("class", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


def span_mode(s, d):
    """Densest log10 span of each class, at the bandwidth by rule."""
    return density_mode(density(_log_spans(s, d), "log_span", "class"), "class")


def fraglen_mode(s, d):
    """Densest length of a fragment."""
    return density_mode(density(frags(s, d).select((F.col("end_pos") - F.col("start_pos")).alias("len")), "len"))


def report_rna(s, d):
    """Genes detected, mean genes and median UMIs of a cell, after UMIs with several genes were settled."""
    cells = X.one_gene_per_umi(reads(s, d)).groupBy("cell").agg(F.countDistinct("gene").alias("genes"), F.count(F.lit(1)).alias("umis"))
    detected = X.one_gene_per_umi(reads(s, d)).agg(F.countDistinct("gene").alias("v"))
    per_cell = cells.agg(F.avg("genes").alias("mean"), F.median("umis").alias("median"))
    figure = lambda df, name, v: df.select(F.lit(name).alias("metric"), F.round(v.cast("double"), 6).alias("value"))
    return figure(detected, "Total_gene_detected", F.col("v")).unionByName(figure(per_cell, "Mean_gene_per_cell", F.col("mean"))).unionByName(figure(per_cell, "Median_UMI_per_cell", F.col("median")))


def _barcoded(s, d):
    return reads(s, d).select((F.col("seq") == F.col("truth")).alias("full"), "cell", F.col("gene").alias("complex"))


def report_scatac(s, d):
    """The report of an ATAC run."""
    own = materialise(frags(s, d).select("cell", "idx", *C.FRAGMENT), "frags")
    found = materialise(peaks(coverage(own), **PEAK), "peaks")
    return report("scatac", _barcoded(s, d), {"dedup": C.dedup(own, ["cell"], C.FRAGMENT), "peaks": found, "counts": X.peak_cell_counts(own, found)})


def report_scsprite(s, d):
    """The report of a run with cells and complexes."""
    return report("scsprite", _barcoded(s, d), {"dedup": C.dedup(frags(s, d).select("gid", "idx", *C.FRAGMENT), ["gid"], C.FRAGMENT)})


QUERIES = {f.__name__: f for f in (loop_span_pets, loop_span_pets_all, span_density, span_mode, fraglen_mode, report_rna, report_scatac, report_scsprite)}

_RD = "rd as (select count(*) n, count_if(seq = truth) k, count(distinct cell) c, count(distinct gene) x from reads)"


def _report_sql(key: str, rest: str) -> str:
    figures = [("Total_read_pairs", "n", "rd"), ("Read_pairs_with_full_barcodes", "k", "rd"), ("Fully_barcode_rate", "cast(floor(k * 1000000.0 / n) / 1000000.0 as double)", "rd")]
    figures += [("Total_fragments", "t", "dd"), ("Duplicated_fragments", "t - q", "dd"), ("Duplication_rate", "cast(floor((t - q) * 1000000.0 / t) / 1000000.0 as double)", "dd")]
    dd = f"dd as (select count(*) t, (select count(*) from (select distinct {key}, chr, start_pos, end_pos from frags)) q from frags)"
    return dd + " " + " union all ".join(f"select '{m}' metric, cast({v} as varchar) \"value\" from {f}" for m, v, f in figures) + rest



_FIGURE = " union all select '{0}', cast({1} as varchar) from {2}"
SQL = {
    "report_scatac": with_views(FRAGS, READS, COVERAGE, PEAKS, _RD, "pc as (select cell from frags f join peaks p on p.chr = f.chr and f.start_pos < p.end_pos and p.start_pos < f.end_pos and f.start_pos < f.end_pos)").rstrip()
    + ", "
    + _report_sql("cell", _FIGURE.format("Cell_count_at_fastq", "c", "rd") + _FIGURE.format("Fragments_overlap_peak", "count(*)", "pc") + _FIGURE.format("Cell_count", "count(distinct cell)", "pc") + _FIGURE.format("Peak_count", "count(*)", "peaks")),
    "report_scsprite": with_views(FRAGS, READS, _RD).rstrip()
    + ", "
    + _report_sql("gid", _FIGURE.format("Cell_count_at_fastq", "c", "rd") + _FIGURE.format("Complex_count_at_fastq", "x", "rd") + _FIGURE.format("Total_qualified_fragment", "q", "dd")),
    "loop_span_pets": PAIRS_SQL + f", l as (select chr, (start_1 + end_1) // {2 * ANCHOR} bin_1, (start_2 + end_2) // {2 * ANCHOR} bin_2, count(*) pets, cast(max(floor((start_2 + end_2 - start_1 - end_1) / 2)) as bigint) span from pr group by all)"
    " select *, round(case when span > 0 then log10(span) end, 6) log_span, round(log10(pets), 6) log_pets from l",
    "loop_span_pets_all": ALL_PAIRS_SQL + f", l as (select chr, s1 // {2 * ANCHOR} bin_1, s2 // {2 * ANCHOR} bin_2, count(*) pets, cast(max((s2 - s1) // 2) as bigint) span from pa group by all)"
    " select *, round(case when span > 0 then log10(span) end, 6) log_span, round(log10(pets), 6) log_pets from l",
    "span_density": with_views(
        FRAGS,
        "sp as (select least(count(*), 16) cls, log10(max(end_pos) - min(start_pos)) v from frags group by gid, chr having max(end_pos) > min(start_pos))",
        f"sc as (select cls, count(*) n, min(v) - {3 * BANDWIDTH!r} lo, (max(v) - min(v) + {6 * BANDWIDTH!r}) / {POINTS - 1} step from sp group by cls)",
        "bi as (select cls, floor((v - lo) / step) j, (v - lo) / step - floor((v - lo) / step) u from sp join sc using (cls))",
        "wt as (select cls, j, sum(w) w from (select cls, j, 1 - u w from bi union all select cls, j + 1, u from bi) group by all)",
    )
    + f"select cls \"class\", round(lo + i * step, 6) x, round(sum(w * exp(-0.5 * ((i - j) * step / {BANDWIDTH}) ** 2)) / (any_value(n) * {BANDWIDTH * math.sqrt(2 * math.pi)!r}), 6) density from wt join sc using (cls), range({POINTS}) r(i) group by cls, i, lo, step",
    "report_rna": with_views(READS, "g as (select cell, umi, gene, count(*) n from reads group by all)", "m as (select *, max(n) over (partition by cell, umi) mx from g)", "t as (select *, count(*) over (partition by cell, umi) k from m where n = mx)", "o as (select * from t where k = 1)", "c as (select cell, count(distinct gene) genes, count(*) umis from o group by cell)")
    + "select 'Total_gene_detected' metric, cast(count(distinct gene) as double) \"value\" from o union all select 'Mean_gene_per_cell', round(avg(genes), 6) from c union all select 'Median_UMI_per_cell', median(umis) from c",
}
