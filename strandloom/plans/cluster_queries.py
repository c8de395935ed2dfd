"""Queries of the cluster, genome and contact operators with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import cluster as C
from strandloom.operators import genomic as G
from strandloom.plans.views import BLACKLIST, FRAGS, blacklist, frags, with_views

GROUP = ["gid"]
#: What a gid is made of.
PARTS = ["lib", "complex"]
#: Reach of the pair queries, in bases.
REACH = 100_000
#: Resolutions of the contact maps, in bases.
COARSE = [2_500_000, 1_000_000, 100_000]
RESOLUTIONS = [2_500_000, 1_000_000, 500_000, 250_000, 100_000, 50_000, 25_000, 10_000, 5_000, 1_000]
PEAK = {"cutoff": 2, "min_length": 60, "max_gap": 30}


def cluster_group_count(s, d):
    return frags(s, d).groupBy("gid").agg(F.count(F.lit(1)).alias("n"))


def cluster_inline_bed(s, d):
    return C.inline_text(frags(s, d), GROUP)


def cluster_hierarchy(s, d):
    return C.hierarchy(frags(s, d), "cell", "gid")


def cluster_dedup_start(s, d):
    return C.dedup(frags(s, d).select("gid", "idx", *C.FRAGMENT), GROUP, ["chr", "start_pos"])


def cluster_dedup_start_end(s, d):
    return C.dedup(frags(s, d).select("gid", "idx", *C.FRAGMENT), GROUP, C.FRAGMENT)


def cluster_dup_stats(s, d):
    return C.duplicate_stats(cluster_dedup_start_end(s, d))


def cluster_split_chr(s, d):
    return C.split_by_chromosome(frags(s, d).select("gid", "idx", "chr"), "gid").groupBy("sub_id", "chr").agg(F.count(F.lit(1)).alias("n"))


def cluster_merge(s, d):
    return C.merge(frags(s, d), GROUP, distance=3000, extend=100)


def cluster_merge_minlen(s, d):
    return C.merge(frags(s, d), GROUP, distance=1000, min_length=100)


def cluster_merge_extra(s, d):
    return C.merge_with(frags(s, d), GROUP, "idx", distance=3000, extend=100)


def cluster_explode_bed(s, d):
    return C.to_bed(frags(s, d), GROUP)


def frag_length(s, d):
    return C.lengths(frags(s, d), "gid")


def frag_next_distance(s, d):
    return C.next_distances(frags(s, d), "gid").select("gid", "i", "chr", "next_chr", "dist")


def frag_pairs_within(s, d):
    return C.pairs_within(frags(s, d), GROUP, REACH)


def juice_pairs(s, d):
    return C.juice(frag_pairs_within(s, d))


def contact_bins(s, d):
    """Contacts of all pairs of a complex on a chromosome, in the maps that show them as a whole."""
    return G.group_contacts(frags(s, d, [*PARTS, "chr"]), PARTS, COARSE, placed=True)


def contact_bins_near(s, d):
    """Contacts of the listed pairs, which lie within REACH of each other."""
    return G.contact_bins(juice_pairs(s, d), COARSE)


def contact_bins_all(s, d):
    """Contacts of all pairs of a complex on a chromosome, at every resolution of the reference."""
    return G.group_contacts(frags(s, d, [*PARTS, "chr"]), PARTS, RESOLUTIONS, placed=True)


def complex_span(s, d):
    return C.spans(frags(s, d), ["gid", "chr"])


def fragcount_hist(s, d):
    return C.count_histogram(frags(s, d), "gid")


def mixed_union(s, d):
    rows = frags(s, d).select("gid", *C.FRAGMENT)
    return C.labelled_union({"DNA": rows.filter("start_pos % 2 = 0"), "RNA": rows.filter("start_pos % 2 = 1")}).groupBy("type", "chr").agg(F.count(F.lit(1)).alias("n"))


def mask_antigrep(s, d):
    return C.without_names(frags(s, d), "chr").groupBy("chr").agg(F.count(F.lit(1)).alias("n"))


def cov_runs(s, d):
    return G.coverage(frags(s, d))


def cov_peaks(s, d):
    return G.peaks(cov_runs(s, d), **PEAK)


def overlap_inner(s, d):
    return G.overlaps(frags(s, d).select("idx", *C.FRAGMENT), blacklist(s, d)).groupBy("chr_b", "start_pos_b").agg(F.count(F.lit(1)).alias("n"), F.sum("idx").alias("idx_sum"))


def overlap_anti(s, d):
    return G.without_overlap(frags(s, d).select("idx", *C.FRAGMENT), blacklist(s, d), "idx")


QUERIES = {
    f.__name__: f
    for f in (
        cluster_group_count, cluster_inline_bed, cluster_hierarchy, cluster_dedup_start, cluster_dedup_start_end, cluster_dup_stats, cluster_split_chr, cluster_merge, cluster_merge_minlen, cluster_merge_extra,
        cluster_explode_bed, frag_length, frag_next_distance, frag_pairs_within, juice_pairs, contact_bins, contact_bins_near, contact_bins_all, complex_span, fragcount_hist, mixed_union, mask_antigrep, cov_runs, cov_peaks, overlap_inner, overlap_anti,
    )
}

_F = with_views(FRAGS)


def _merge_sql(distance: int, extend: int, least: int, extra: bool = False) -> str:
    rest = ", string_agg(cast(idx as varchar), ';' order by start_pos, end_pos, idx) idx" if extra else ""
    return with_views(
        FRAGS,
        f"m as (select gid, chr, idx, start_pos, end_pos + {extend} end_pos from frags where end_pos - start_pos >= {least})",
        "p as (select *, max(end_pos) over (partition by gid, chr order by start_pos, end_pos, idx rows between unbounded preceding and 1 preceding) prev from m)",
        f"q as (select *, sum(case when prev + {distance} >= start_pos then 0 else 1 end) over (partition by gid, chr order by start_pos, end_pos, idx rows unbounded preceding) k from p)",
    ) + f"select gid, chr, min(start_pos) start_pos, max(end_pos) end_pos{rest} from q group by gid, chr, k"


PAIRS_SQL = with_views(FRAGS, f"pr as (select a.gid, a.chr, a.start_pos start_1, a.end_pos end_1, b.start_pos start_2, b.end_pos end_2, b.start_pos - a.end_pos dist from frags a join frags b on a.gid = b.gid and a.chr = b.chr and (b.start_pos, b.idx) > (a.start_pos, a.idx) and b.start_pos - a.start_pos <= {REACH})")
_JUICE = "select trim(chr, 'chr') chr_1, (start_1 + end_1) // 2 mid_1, trim(chr, 'chr') chr_2, (start_2 + end_2) // 2 mid_2 from pr"
ALL_PAIRS_SQL = with_views(FRAGS, "pa as (select a.chr, least(a.start_pos + a.end_pos, b.start_pos + b.end_pos) s1, greatest(a.start_pos + a.end_pos, b.start_pos + b.end_pos) s2 from frags a join frags b on a.gid = b.gid and a.chr = b.chr and (b.start_pos, b.idx, b.end_pos, b.cell) > (a.start_pos, a.idx, a.end_pos, a.cell))")
COVERAGE = (
    "ev as (select chr, p, sum(d) d from (select chr, start_pos p, 1 d from frags where start_pos < end_pos union all select chr, end_pos, -1 from frags where start_pos < end_pos) group by all having sum(d) <> 0),"
    " dp as (select chr, p start_pos, lead(p) over (partition by chr order by p) end_pos, cast(sum(d) over (partition by chr order by p) as bigint) depth from ev), runs as (select * from dp where depth > 0)"
)
PEAKS = (
    f"hi as (select *, case when start_pos - lag(end_pos) over (partition by chr order by start_pos) <= {PEAK['max_gap']} then 0 else 1 end nw from runs where depth >= {PEAK['cutoff']}),"
    " isl as (select *, sum(nw) over (partition by chr order by start_pos) k from hi),"
    f" peaks as (select chr, min(start_pos) start_pos, max(end_pos) end_pos, max(depth) summit from isl group by chr, k having max(end_pos) - min(start_pos) >= {PEAK['min_length']})"
)
_OVER = " join blacklist b on b.chr = f.chr and f.start_pos < b.end_pos and b.start_pos < f.end_pos and f.start_pos < f.end_pos"


def _contacts_sql(resolutions):
    values = ", ".join(f"({r})" for r in resolutions)
    return ALL_PAIRS_SQL + f"select resolution, trim(chr, 'chr') chr_1, s1 // (2 * resolution) bin_1, trim(chr, 'chr') chr_2, s2 // (2 * resolution) bin_2, count(*) n from pa, (values {values}) r(resolution) group by all"


SQL = {
    "cluster_group_count": _F + "select gid, count(*) n from frags group by gid",
    "cluster_inline_bed": with_views(FRAGS, "nu as (select *, (row_number() over (partition by gid order by idx, frags.chr, start_pos, end_pos) - 1) // 1000000 part from frags)") + "select gid, part, gid || chr(9) || count(*) || chr(9) || string_agg(f.chr || chr(9) || start_pos || chr(9) || end_pos, chr(9) order by idx, f.chr, start_pos, end_pos) line from nu f group by gid, part",
    "cluster_hierarchy": _F + "select gid, arg_min(cell, idx) cell, count(*) n from frags group by gid",
    "cluster_dedup_start": _F + "select gid, chr, start_pos, min(idx) idx, arg_min(end_pos, idx) end_pos, count(*) dup from frags group by all",
    "cluster_dedup_start_end": _F + "select gid, chr, start_pos, end_pos, min(idx) idx, count(*) dup from frags group by all",
    "cluster_dup_stats": _F + "select count(*) - (select count(*) from (select distinct gid, chr, start_pos, end_pos from frags)) duplicates, count(*) total_fragments from frags",
    "cluster_split_chr": with_views(FRAGS, "g as (select gid, chr, min(idx) m, count(*) n from frags group by all)") + "select gid || '-' || (row_number() over (partition by gid order by m, chr) - 1) sub_id, chr, n from g",
    "cluster_merge": _merge_sql(3000, 100, 0),
    "cluster_merge_minlen": _merge_sql(1000, 0, 100),
    "cluster_merge_extra": _merge_sql(3000, 100, 0, True),
    "cluster_explode_bed": _F + "select chr, start_pos, end_pos, gid \"name\", row_number() over (partition by gid order by idx, chr, start_pos, end_pos) - 1 i from frags",
    "frag_length": _F + "select chr, start_pos, end_pos, gid || '-' || count(*) over (partition by gid) || '-' || (row_number() over (partition by gid order by idx) - 1) \"name\", end_pos - start_pos len from frags",
    "frag_next_distance": with_views(FRAGS, "w as (select gid, row_number() over (partition by gid order by idx) - 1 i, chr, lead(chr) over (partition by gid order by idx) next_chr, lead(start_pos) over (partition by gid order by idx) - end_pos dist from frags)") + "select * from w where next_chr is not null",
    "frag_pairs_within": PAIRS_SQL + "select * from pr",
    "juice_pairs": PAIRS_SQL + _JUICE,
    "contact_bins_near": PAIRS_SQL + ", j as (" + _JUICE + ") select resolution, chr_1, mid_1 // resolution bin_1, chr_2, mid_2 // resolution bin_2, count(*) n from j, (values (2500000), (1000000), (100000)) r(resolution) group by all",
    "contact_bins": _contacts_sql(COARSE),
    "contact_bins_all": _contacts_sql(RESOLUTIONS),
    "complex_span": _F + "select gid, chr, max(end_pos) - min(start_pos) span, count(*) n from frags group by all",
    "fragcount_hist": with_views(FRAGS, "g as (select least(count(*), 16) k from frags group by gid)") + "select case when r.k > 15 then 'F > 15' else 'F = ' || r.k end \"class\", count(g.k) groups from range(1, 17) r(k) left join g on g.k = r.k group by r.k",
    "mixed_union": _F + "select case when start_pos % 2 = 0 then 'DNA' else 'RNA' end \"type\", chr, count(*) n from frags group by all",
    "mask_antigrep": _F + "select chr, count(*) n from frags where not regexp_matches(chr, 'Het|chrU|chrM') group by chr",
    "cov_runs": with_views(FRAGS, COVERAGE) + "select chr, start_pos, end_pos, depth from runs",
    "cov_peaks": with_views(FRAGS, COVERAGE, PEAKS) + "select * from peaks",
    "overlap_inner": with_views(FRAGS, BLACKLIST) + "select b.chr chr_b, b.start_pos start_pos_b, count(*) n, cast(sum(idx) as bigint) idx_sum from frags f" + _OVER + " group by all",
    "overlap_anti": with_views(FRAGS, BLACKLIST) + "select idx, chr, start_pos, end_pos from frags where idx not in (select idx from frags f" + _OVER + ")",
}
