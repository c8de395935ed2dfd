"""Queries of the cell operators, alignments and report with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import alignments as A
from strandloom.operators import cells as X
from strandloom.operators import genomic as G
from strandloom.plans.cluster_queries import COVERAGE, PEAK, PEAKS
from strandloom.plans.views import ALIGNMENTS, FRAGS, READS, alignments, frags, reads, with_views
from strandloom.storage import materialise, table


def _frags(s, d):
    """The fragments as a table of their own, as they are read several times."""
    return materialise(frags(s, d).select("cell", *X.PEAK), "frags")


def _counts(s, d):
    own = _frags(s, d)
    return X.peak_cell_counts(own, materialise(G.peaks(G.coverage(own), **PEAK), "peaks"))


def _totals(s, d):
    cells = table(s, d, "umi_counts").filter("n_umi >= 0").groupBy("lib", "cell").agg(F.min("n_umi").alias("total"))
    return cells.select(F.concat_ws("/", "lib", "cell").alias("cell"), "total")


def _listed(counts):
    return counts.filter("cell % 3 = 0").select("cell").distinct()


def peak_cell_count(s, d):
    return _counts(s, d)


def matrix_coo(s, d):
    return X.matrix(materialise(_counts(s, d), "counts"))[0]


def matrix_dims(s, d):
    return X.matrix_dims(_counts(s, d))


def matrix_filtered(s, d):
    counts = materialise(_counts(s, d), "counts")
    return X.matrix(X.filtered(counts, _listed(counts)))[0]


def cell_similarity(s, d):
    return X.similarity(frags(s, d))


def cell_doublets(s, d):
    """Cells that the doublet filter keeps."""
    return X.keep_singlets(_frags(s, d))


def cell_rank_curve(s, d):
    return X.rank_curve(_totals(s, d)).select("total", "k", "rank", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), F.round("slope", 5).alias("slope"), "skipped")


def cell_inflection(s, d):
    return X.inflection(_totals(s, d))


def cell_called(s, d):
    return X.called(_totals(s, d))


def cell_knee(s, d):
    return X.knee(_totals(s, d))


def cell_empty_droplets(s, d):
    """Cells told from empty droplets by their counts over peaks."""
    counts = _counts(s, d).select("cell", F.struct(*X.PEAK).alias("feature"), "n")
    return X.empty_droplets(materialise(counts, "counts"), ambient=20)


def _keyed(s, d, odd: int):
    idb = table(s, d, "cell_idb").filter("idb_key is not null")
    return idb.filter(f"id % 3 <> {odd}").select("idb_key", F.concat(F.lit("CELL_" if odd == 1 else "A"), F.col("id").cast("string")).alias("cell"))


def cell_sync(s, d):
    """ATAC cells with the id of the RNA cell of the same key, or ATAC- and their own."""
    return X.synchronise(_keyed(s, d, 0), _keyed(s, d, 1))


def cell_sync_filter(s, d):
    return X.synchronised_only(cell_sync(s, d)).agg(F.count(F.lit(1)).alias("cells"))


def barcode_to_cell(s, d):
    """Barcode of the cell of each complex, - where the identifier table has none."""
    firsts = frags(s, d).groupBy("gid").agg(F.min_by("cell", "idx").alias("id"))
    names = table(s, d, "cell_idb").select("id", F.col("names").alias("barcode"))
    return X.lookup(firsts, names, "id", "barcode")


def umi_count(s, d):
    return X.umi_counts(reads(s, d))


def umi_collapse_1mm(s, d):
    return X.collapse_umis(reads(s, d).groupBy("cell", "gene", "umi").agg(F.count(F.lit(1)).alias("n")))


def umi_one_gene(s, d):
    return X.one_gene_per_umi(reads(s, d))


def cigar_reflen(s, d):
    return alignments(s, d).groupBy("cigar").agg(F.max(A.reference_length(F.col("cigar"))).alias("len"), F.count(F.lit(1)).alias("n"))


def sam_flag_filter(s, d):
    return A.usable(alignments(s, d)).groupBy("rname").agg(F.count(F.lit(1)).alias("n"))


def mate_fragment(s, d):
    """Places of reads from their mates, orphans dropped."""
    return A.fragment(A.mates(alignments(s, d), strict=True))


def mate_one(s, d):
    """Places from mate 1 alone."""
    return A.fragment(A.mates(A.one_mate(alignments(s, d), 1)))


def tn5_shift(s, d):
    return A.tn5_shift(A.fragment(A.mates(alignments(s, d)))).groupBy("chr").agg(F.sum("start_pos").alias("starts"), F.sum("end_pos").alias("ends"))


def name_annotation(s, d):
    """Names written with their barcodes and ids, and read back."""
    r = reads(s, d)
    codes = F.array(*[F.struct(F.lit(k).alias("type"), F.col(c).alias("value")) for k, c in (("BC", "truth"), ("UMI", "umi"))])
    written = r.select(A.annotate_name(F.concat("rid", F.lit("/1")), codes, F.create_map(F.lit("CELL"), F.col("cell").cast("string"))).alias("name"))
    back = written.select("name", A.split_name(F.col("name")).alias("x"))
    return back.select("name", "x.read", A.choose(F.col("x.barcodes"), "2").alias("second"), A.choose(F.col("x.barcodes"), "BC").alias("bc"), A.choose(F.col("x.barcodes"), "1:UMI").alias("none"), F.col("x.ids")["CELL"].alias("cell"))


def report_metrics(s, d):
    """Key figures of the run, in the form of the quality report."""
    f = frags(s, d)
    r = reads(s, d)
    six = lambda a, b: (F.floor(a * 1000000.0 / b) / 1000000.0).cast("string")
    exact = r.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("seq") == F.col("truth")).alias("full"))
    cells = f.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("cells"))
    complexes = f.groupBy("gid").agg(F.countDistinct("chr", "start_pos", "end_pos").alias("k"), F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("c"), F.sum("k").alias("k"), F.sum("n").alias("n"))
    long = lambda df, **m: [df.select(F.lit(k).alias("metric"), v.cast("string").alias("value")) for k, v in m.items()]
    parts = long(exact, Total_read_pairs=F.col("n"), Fully_barcode_rate=six(F.col("full"), F.col("n"))) + long(cells, Cell_count_estimated=F.col("cells"))
    parts += long(complexes, Complex_count=F.col("c"), Fragments_after_dedup=F.col("k"), Duplication_rate=six(F.col("n") - F.col("k"), F.col("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES = {
    f.__name__: f
    for f in (
        peak_cell_count, matrix_coo, matrix_dims, matrix_filtered, cell_similarity, cell_doublets, cell_rank_curve, cell_inflection, cell_called, cell_knee, cell_empty_droplets, cell_sync, cell_sync_filter, barcode_to_cell,
        umi_count, umi_collapse_1mm, umi_one_gene, cigar_reflen, sam_flag_filter, mate_fragment, mate_one, tn5_shift, name_annotation, report_metrics,
    )
}

_PC = "pc as (select p.chr, p.start_pos, p.end_pos, cell, count(*) n from frags f join peaks p on p.chr = f.chr and f.start_pos < p.end_pos and p.start_pos < f.end_pos and f.start_pos < f.end_pos group by all)"
_COO = "select dense_rank() over (order by chr, start_pos, end_pos) i, dense_rank() over (order by cell) j, n v from "
_SIM = (
    "st as (select distinct cell, chr, start_pos p from frags), en as (select distinct cell other, chr, end_pos p from frags), me as (select cell, other, count(*) n from st join en using (chr, p) group by all),"
    " si as (select a, b, cast(sum(n) as bigint) n from (select cell a, other b, n from me union all select other, cell, n from me) group by all)"
)
_CURVE = (
    "to_ as (select min(n_umi) total from umi_counts where n_umi >= 0 group by lib, cell), pt as (select total, count(*) k from to_ where total > 100 group by total),"
    " rk as (select *, sum(k) over (order by total desc) - (k - 1) / 2.0 rank from pt), xy as (select *, log10(rank) x, log10(total) y from rk),"
    " sl as (select *, (lead(y) over (order by total desc) - y) / (lead(x) over (order by total desc) - x) slope, row_number() over (order by total desc) r, count(*) over () - 1 steps, sum(case when x <= log10(50) then 1 else 0 end) over () early from xy),"
    " cu as (select total, k, rank, x, y, slope, r <= least(steps - 1, early) skipped from sl)"
)
_M = (
    "al as (select qname, flag, rname, pos, cigar, pos + len e from alignments{w}), mt as (select qname, min(case when flag & 128 = 0 and rname <> '*' then {{r: rname, s: pos, e: e}} end) m1,"
    " min(case when flag & 128 <> 0 and rname <> '*' then {{r: rname, s: pos, e: e}} end) m2, sum(case when flag & 128 = 0 then 1 else 0 end) a, sum(case when flag & 128 <> 0 then 1 else 0 end) b from al group by qname),"
    " fr as (select qname, case when m2 is null then m1 when m1 is null then m2 when m1.r = m2.r then {{r: m1.r, s: least(m1.s, m2.s), e: greatest(m1.e, m2.e)}} when m1.e - m1.s >= m2.e - m2.s then m1 else m2 end p from mt{h})"
)
_PLACE = "select qname, p.r chr, p.s start_pos, p.e end_pos from fr where p is not null"
_U = "u as (select cell, gene, umi, count(*) n from reads group by all)"

SQL = {
    "peak_cell_count": with_views(FRAGS, COVERAGE, PEAKS, _PC) + "select * from pc",
    "matrix_coo": with_views(FRAGS, COVERAGE, PEAKS, _PC) + _COO + "pc",
    "matrix_dims": with_views(FRAGS, COVERAGE, PEAKS, _PC) + "select count(distinct (chr, start_pos, end_pos)) peaks, count(distinct cell) cells, count(*) nnz from pc",
    "matrix_filtered": with_views(FRAGS, COVERAGE, PEAKS, _PC) + _COO + "pc where cell % 3 = 0",
    "cell_similarity": with_views(FRAGS, _SIM) + "select * from si",
    "cell_doublets": with_views(FRAGS, _SIM, "be as (select a, arg_max(b, n * 1000000000000 - b) best from si group by a)") + "select cell from (select distinct cell from frags) c left join be on be.a = c.cell where coalesce(best, (select min(cell) from frags)) = cell",
    "cell_rank_curve": with_views(_CURVE) + "select total, k, cast(rank as double) rank, round(x, 6) x, round(y, 6) y, round(slope, 5) slope, skipped from cu",
    "cell_inflection": with_views(_CURVE) + "select arg_min(total, slope) inflection from cu where slope is not null and not skipped",
    "cell_knee": with_views(_CURVE, "w as (select *, row_number() over (order by x) i, lag(slope) over (order by x) bf, (lead(x) over (order by x) - lag(x) over (order by x)) / 2 wd from cu)",
        "e as (select (select i from w where slope is not null and not skipped order by slope desc, i limit 1) l, (select i from w where slope is not null and not skipped order by slope, i limit 1) r)",
        "b as (select total, i, case when r - l >= 4 then ((slope - bf) / wd) / pow(1 + pow((slope + bf) / 2, 2), 1.5) end bend from w, e where i >= l and i < greatest(r, l + 1))")
    + "select coalesce((select total from b where bend is not null order by bend, i limit 1), (select total from b order by i limit 1)) knee",
    "cell_called": with_views(_CURVE) + "select lib || '/' || cell cell, min(n_umi) total from umi_counts where n_umi >= 0 group by lib, umi_counts.cell having min(n_umi) >= (select arg_min(total, slope) from cu where slope is not null and not skipped)",
    "cell_sync": "select a.idb_key, coalesce('CELL_' || r.id, 'ATAC-A' || a.id) cell from (select * from cell_idb where id % 3 <> 0 and idb_key is not null) a left join (select * from cell_idb where id % 3 <> 1 and idb_key is not null) r using (idb_key)",
    "cell_sync_filter": "select count(*) cells from (select * from cell_idb where id % 3 <> 0 and idb_key is not null) a join (select * from cell_idb where id % 3 <> 1 and idb_key is not null) r using (idb_key)",
    "barcode_to_cell": with_views(FRAGS, "f as (select gid, arg_min(cell, idx) id from frags group by gid)") + "select f.id, gid, coalesce(names, '-') barcode from f left join cell_idb i on i.id = f.id",
    "umi_count": with_views(READS) + "select cell, gene, count(distinct umi) umis from reads group by all",
    "umi_collapse_1mm": with_views(READS, _U) + "select cell, gene, count(*) umis from u where not exists (select 1 from u v where v.cell = u.cell and v.gene = u.gene and hamming(v.umi, u.umi) = 1 and (v.n > u.n or (v.n = u.n and v.umi < u.umi))) group by all",
    "umi_one_gene": with_views(READS, "g as (select cell, umi, gene, count(*) n from reads group by all)", "m as (select *, max(n) over (partition by cell, umi) mx from g)", "t as (select *, count(*) over (partition by cell, umi) k from m where n = mx)") + "select cell, umi, gene, n from t where k = 1",
    "cigar_reflen": with_views(ALIGNMENTS) + "select cigar, max(len) len, count(*) n from alignments group by cigar",
    "sam_flag_filter": with_views(ALIGNMENTS) + "select rname, count(*) n from alignments where flag & 2304 = 0 and mapq >= 30 group by rname",
    "mate_fragment": with_views(ALIGNMENTS, _M.format(w="", h=" where a > 0 and b > 0")) + _PLACE,
    "mate_one": with_views(ALIGNMENTS, _M.format(w=" where flag & 64 <> 0", h="")) + _PLACE,
    "tn5_shift": with_views(ALIGNMENTS, _M.format(w="", h="")) + "select p.r chr, cast(sum(p.s + 4) as bigint) starts, cast(sum(p.e - 5) as bigint) ends from fr where p is not null group by 1",
    "name_annotation": with_views(READS) + "select rid || '|||BC:' || truth || '|UMI:' || umi || '|||CELL_' || cell \"name\", rid \"read\", umi \"second\", truth bc, cast(null as varchar) \"none\", cast(cell as varchar) cell from reads",
    "report_metrics": with_views(FRAGS, READS, "g as (select gid, count(distinct (chr, start_pos, end_pos)) k, count(*) n from frags group by gid)")
    + "select 'Total_read_pairs' metric, cast(count(*) as varchar) \"value\" from reads union all select 'Fully_barcode_rate', cast(floor(sum(case when seq = truth then 1 else 0 end) * 1000000.0 / count(*)) / 1000000.0 as varchar) from reads"
    " union all select 'Cell_count_estimated', cast(count(distinct cell) as varchar) from frags union all select 'Complex_count', cast(count(*) as varchar) from g union all select 'Fragments_after_dedup', cast(sum(k) as varchar) from g"
    " union all select 'Duplication_rate', cast(floor((sum(n) - sum(k)) * 1000000.0 / sum(n)) / 1000000.0 as varchar) from g",
}
