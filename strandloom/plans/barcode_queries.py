"""Queries of barcode extraction, correction and identifiers with their SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from strandloom.operators import barcode as B
from strandloom.operators.identify import identify
from strandloom.plans.views import READS, WHITELIST, reads, whitelist, with_views
from strandloom.sources import config

#: Letters of the simulated linker that stands before the barcode in the scanned reads.
LINKER = "AC"


def barcode_exact(s, d):
    return B.correct_exact(reads(s, d).select("rid", "seq"), whitelist(s, d), "seq")


def barcode_sparse_h1(s, d):
    return B.correct_sparse(reads(s, d).select("rid", "seq"), whitelist(s, d), "seq")


def _candidates(s, d):
    return B.candidates(reads(s, d), whitelist(s, d), "rid", "seq", "qual")


def barcode_candidates(s, d):
    return _candidates(s, d)


def barcode_dense_minq(s, d):
    return B.decide(_candidates(s, d), "rid", "minq").select("rid", "ord")


def barcode_fcfg(s, d):
    return B.decide(_candidates(s, d), "rid", "fcfg").select("rid", "ord")


def barcode_rnat(s, d):
    return B.decide(_candidates(s, d), "rid", "rnat").select("rid", "ord", F.round("share", 6).alias("share"))


def barcode_atact(s, d):
    priors = B.exact_counts(reads(s, d), whitelist(s, d), "seq")
    return B.decide(_candidates(s, d), "rid", "atact", priors).select("rid", "ord", F.round("share", 6).alias("share"))


def barcode_prior(s, d):
    return B.exact_counts(reads(s, d), whitelist(s, d), "seq")


def barcode_two_rounds(s, d):
    return B.correct(reads(s, d), whitelist(s, d), "rid", "seq", "qual").groupBy("round").agg(F.count(F.lit(1)).alias("n"), F.sum("ord").alias("ords"))


def barcode_random(s, d):
    return B.random_codes(reads(s, d), "umi", "RND")


def barcode_quality_filter(s, d):
    return reads(s, d).filter(B.mean_quality_at_least(F.col("qual"), 25)).select("rid")


def barcode_dropn(s, d):
    return B.without_n(reads(s, d), "seq").select("rid")


def _scanned(s, d):
    """Reads with 0 to 2 bases before the barcode and a short code after it, scanned for both."""
    r = reads(s, d).select("rid", F.concat(F.expr("substr('AC', 1, cast(cell % 3 as int))"), "seq", F.expr("case when kind = 0 then 'GGT' when kind = 1 then 'CCAT' else 'TTTT' end"), "body").alias("seq"))
    own = whitelist(s, d).select(F.lit("BC").alias("type"), "ord", "seq")
    short = s.createDataFrame([("DPM", 1, "GGT"), ("RPM", 1, "CCAT")], "type string, ord bigint, seq string")
    holes = [B.Hole("bc", ("BC",), laxity=2, length=(16, 16)), B.Hole("tag", ("DPM", "RPM"), length=(3, 4))]
    return B.scan_chain(r, "rid", "seq", holes, own.unionByName(short))


def barcode_laxity_scan(s, d):
    return _scanned(s, d).select("rid", F.col("pos").cast("bigint").alias("pos"), "bc", "tag", "tag_type")


def chain_status_hist(s, d):
    return B.chain_status(_scanned(s, d), ["bc", "tag"])


def read_type_totals(s, d):
    x = _scanned(s, d)
    found = lambda k: F.coalesce(F.col("tag_type") == k, F.lit(False))
    return B.read_types(x, found("DPM"), found("RPM"), F.col("bc").isNotNull() & F.col("tag").isNotNull())


def identifier_variable_hole(s, d):
    """DNA and RNA reads of one barcode share a key."""
    x = _scanned(s, d).withColumn("key", B.identifier_key([("bc", False), ("tag", True)]))
    return x.filter("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("tag_type").alias("kinds"))


def identifier_pattern(s, d):
    """Where the pattern (any, DPM or RPM) fits the found types."""
    x = _scanned(s, d)
    types = F.array("bc_type", "tag_type")
    return x.groupBy(B.matches_at(types, [None, {"DPM", "RPM"}]).cast("bigint").alias("at"), B.matches_at(types, [{"RPM"}], anchor=1).cast("bigint").alias("rna_at")).agg(F.count(F.lit(1)).alias("n"))


def identifier_assign(s, d):
    r = barcode_exact(s, d).withColumn("key", F.col("ord").cast("string"))
    return B.assign_ids(r, "key")


def identifier_seeded(s, d):
    """Ids of all barcodes, where every second one has its id from an earlier run."""
    r = barcode_exact(s, d).filter("ord is not null").withColumn("key", F.col("ord").cast("string"))
    known = r.filter("ord % 2 = 0").select("key", (F.col("ord") * 10).alias("id")).distinct()
    return B.assign_ids(r, "key", known)


#: A barcode with one error, a UMI and a tag that tells DNA from RNA; then the payload. Mate 2 gives ten bases.
CONFIG = config.parse(
    json.dumps(
        {
            "barcode chain": [{"BC-UMI-DPM-GENOMED": "R1:1"}, {"BC-UMI-RPM-GENOMER": "R1:1"}, {"GENOME": "R2:3"}],
            "barcode type": [
                {"BC": {"LENGTH": 16, "MISMATCH": 1}}, {"UMI": {"LENGTH": 4, "WHITE LIST": ["NNNN"]}}, {"DPM": {"LENGTH": 3, "WHITE LIST": {"DPM": "GGT"}}},
                {"RPM": {"LENGTH": 4, "WHITE LIST": {"RPM": "CCAT"}}}, {"GENOME": {"LENGTH": 10}},
            ],
            "identifier": {"CELL": "BC-ANY-DPM/RPM", "DNA": "DPM", "RNA": "RPM"},
        }
    )
)


def _identified(s, d, partial=False, numbered=True):
    """Reads of barcode, UMI, tag and body, identified by CONFIG."""
    r = reads(s, d).select("rid", F.concat("seq", "umi", F.expr("case when kind = 0 then 'GGT' when kind = 1 then 'CCAT' else 'TTTT' end"), "body").alias("s1"), F.col("body").alias("s2"), F.col("body_qual").alias("q2"))
    mates = r.select("rid", F.struct(F.col("s1").alias("seq"), F.repeat(F.lit("I"), F.length("s1")).alias("qual")).alias("r1"), F.struct(F.col("s2").alias("seq"), F.col("q2").alias("qual")).alias("r2"))
    return identify(mates, "rid", CONFIG, given={"BC": whitelist(s, d)}, partial=partial, numbered=numbered)


def barcode_capture(s, d):
    """Corrected barcode, UMI as it stands, and the payloads of both mates."""
    at = lambda i, f: F.get("codes", F.lit(i))[f]
    return _identified(s, d, numbered=False).select("rid", at(0, "code").cast("bigint").alias("bc"), at(1, "text").alias("umi"), F.col("payload_1.seq").alias("payload_1"), F.col("payload_2.seq").alias("payload_2"), F.col("payload_2.qual").alias("qual_2"))


def barcode_genome_fallback(s, d):
    """The kind of genome whose chain is found: DNA where it is whole, else RNA."""
    return _identified(s, d, numbered=False).select("rid", "genome", F.get("codes", F.lit(2))["text"].alias("tag"), "full")


def identifier_route(s, d):
    """Cell, type and route of each read; DNA and RNA reads of a barcode share the cell."""
    return _identified(s, d).select("rid", F.col("CELL").alias("cell"), "type", "route")


def identifier_route_all(s, d):
    """Reads by route where those that aren't full are written too."""
    return _identified(s, d, partial=True).groupBy("route", "full").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("CELL").alias("cells"))


QUERIES = {
    f.__name__: f
    for f in (
        barcode_exact, barcode_sparse_h1, barcode_candidates, barcode_dense_minq, barcode_fcfg, barcode_rnat, barcode_atact, barcode_prior, barcode_two_rounds, barcode_random, barcode_quality_filter, barcode_dropn,
        barcode_laxity_scan, chain_status_hist, read_type_totals, identifier_variable_hole, identifier_pattern, identifier_assign, identifier_seeded, barcode_capture, barcode_genome_fallback, identifier_route, identifier_route_all,
    )
}

_VAR = "select *, substr(seq, 1, i - 1) || b || substr(seq, i + 1) v from (select *, unnest(range(1, 17)) i from {0}) x, (values ('A'), ('C'), ('G'), ('T')) l(b) where substr(seq, i, 1) <> b"
_CAND = "mi as (select rid, seq, qual from reads where seq not in (select seq from whitelist)), ca as (select rid, w.ord, ord_q - 33 q from (select rid, v, ascii(substr(qual, i, 1)) ord_q from (" + _VAR.format("mi") + ")) x join whitelist w on w.seq = x.v)"
_PRIOR = "pr as (select w.ord, count(*) prior from reads r join whitelist w on w.seq = r.seq group by w.ord)"
_SPARSE = "ex as (select v, min(pack) pack from (select seq v, ord pack from whitelist union all select v, 1000000000000 + ord from (" + _VAR.format("whitelist") + ")) group by v)"
_SCAN = (
    "sc as (select rid, substr('AC', 1, cell % 3) || r.seq || case when kind = 0 then 'GGT' when kind = 1 then 'CCAT' else 'TTTT' end || body s from reads r),"
    " s1 as (select rid, s, coalesce(w0.ord, w1.ord, w2.ord) bc, case when w0.ord is not null then 17 when w1.ord is not null then 18 when w2.ord is not null then 19 else 17 end pos from sc"
    " left join whitelist w0 on w0.seq = substr(s, 1, 16) left join whitelist w1 on w1.seq = substr(s, 2, 16) left join whitelist w2 on w2.seq = substr(s, 3, 16)),"
    " s2 as (select rid, bc, case when substr(s, pos, 3) = 'GGT' then 'DPM' when substr(s, pos, 4) = 'CCAT' then 'RPM' end tag_type, case when substr(s, pos, 3) = 'GGT' then pos + 3 else pos + 4 end pos from s1)"
)
_IDENT = "id as (select r.*, pack % 1000000000000 bc, case kind when 0 then 'DPM' when 1 then 'RPM' end tag from reads r left join ex on v = r.seq), ce as (select bc, row_number() over (order by cast(bc as varchar)) c from (select distinct bc from id where bc is not null and tag is not null))"
# a DNA chain is whole with its tag and the barcode; the RNA chain, which comes last, is taken otherwise
_DNA = "bc is not null and tag is not null and tag = 'DPM'"
_ATACT = "wt as (select rid, c.ord, q, pow(10.0, -q / 10.0) * greatest(coalesce(prior, 1), 1) w from ca c left join pr on pr.ord = c.ord), su as (select rid, max(w) / sum(w) share, max(w) mx from wt group by rid)"
_RNAT = "wt as (select rid, ord, q, pow(10.0, -q / 10.0) w from ca), su as (select rid, max(w) / sum(w) share, min(q) mn from wt group by rid)"

_IDS = "ks as (select cast(ord as varchar) \"key\", count(*) n from reads r join whitelist w on w.seq = r.seq group by ord)"
SQL = {
    "barcode_exact": with_views(READS, WHITELIST) + "select rid, r.seq, ord from reads r left join whitelist w on w.seq = r.seq",
    "barcode_sparse_h1": with_views(READS, WHITELIST, _SPARSE) + "select rid, seq, pack % 1000000000000 ord, cast(pack // 1000000000000 as int) dist from reads left join ex on v = seq",
    "barcode_candidates": with_views(READS, WHITELIST, _CAND) + "select * from ca",
    "barcode_dense_minq": with_views(READS, WHITELIST, _CAND) + "select rid, arg_min(ord, cast(q as bigint) * 1000000000 + ord) ord from ca group by rid",
    "barcode_fcfg": with_views(READS, WHITELIST, _CAND) + "select rid, min(ord) ord from ca group by rid",
    "barcode_rnat": with_views(READS, WHITELIST, _CAND, _RNAT) + "select rid, min(ord) ord, round(max(share), 6) share from wt join su using (rid) where q = mn and share >= 0.975 group by rid",
    "barcode_atact": with_views(READS, WHITELIST, _CAND, _PRIOR, _ATACT) + "select rid, min(ord) ord, round(max(share), 6) share from wt join su using (rid) where w = mx and share >= 0.975 group by rid",
    "barcode_prior": with_views(READS, WHITELIST, _PRIOR) + "select * from pr",
    "barcode_two_rounds": with_views(READS, WHITELIST, _CAND, _PRIOR, _ATACT, "al as (select 0 round, w.ord from reads r join whitelist w on w.seq = r.seq union all (select 1, min(ord) from wt join su using (rid) where w = mx and share >= 0.975 group by rid))") + "select round, count(*) n, cast(sum(ord) as bigint) ords from al group by round",
    "barcode_random": with_views(READS) + "select 'RND:' || umi code, count(*) n from reads group by umi",
    "barcode_quality_filter": with_views(READS) + "select rid from reads where list_sum([ascii(substr(qual, i, 1)) - 33 for i in range(1, 17)]) >= 25 * 16",
    "barcode_dropn": with_views(READS) + "select rid from reads where seq not like '%N%'",
    "barcode_laxity_scan": with_views(READS, WHITELIST, _SCAN) + "select rid, pos, bc, case when tag_type is not null then 1 end tag, tag_type from s2",
    "chain_status_hist": with_views(READS, WHITELIST, _SCAN) + "select m mask, count(rid) reads from range(0, 4) g(m) left join (select rid, case when bc is null then 0 else 1 end + case when tag_type is null then 0 else 2 end k from s2) on k = m group by m",
    "read_type_totals": with_views(READS, WHITELIST, _SCAN, "t as (select tag_type = 'DPM' and tag_type is not null dna, tag_type = 'RPM' and tag_type is not null rna, bc is not null and tag_type is not null f from s2)")
    + "select count(*) reads, count_if(f) \"full\", count_if(dna) dna, count_if(rna) rna, count_if(not dna and not rna) ndnr, count_if(dna and f) dna_full, count_if(rna and f) rna_full, count_if(not dna and not rna and f) ndnr_full, count_if(dna and rna) \"both\", count_if(not f) \"partial\" from t",
    "identifier_variable_hole": with_views(READS, WHITELIST, _SCAN) + "select cast(bc as varchar) \"key\", count(*) n, count(distinct tag_type) kinds from s2 where bc is not null and tag_type is not null group by bc",
    "identifier_pattern": with_views(READS, WHITELIST, _SCAN) + "select case when bc is not null and tag_type is not null then 0 end \"at\", case when tag_type = 'RPM' then 1 end rna_at, count(*) n from s2 group by 1, 2",
    "barcode_capture": with_views(READS, WHITELIST, _SPARSE, _IDENT)
    + f"select rid, bc, 'UMI:' || umi umi, nullif(case when {_DNA} then body else substr(case kind when 0 then 'GGT' when 1 then 'CCAT' else 'TTTT' end || body, 5) end, '') payload_1, substr(body, 3, 10) payload_2, substr(body_qual, 3, 10) qual_2 from id",
    "barcode_genome_fallback": with_views(READS, WHITELIST, _SPARSE, _IDENT) + f"select rid, case when {_DNA} then 'D' else 'R' end genome, case when {_DNA} then 'DPM' when tag = 'RPM' then 'RPM' end tag, bc is not null and tag is not null \"full\" from id",
    "identifier_route": with_views(READS, WHITELIST, _SPARSE, _IDENT)
    + f"select rid, case when tag is not null then c end cell, case when {_DNA} then 'DNA' when tag = 'RPM' then 'RNA' else 'NDNR' end \"type\", case when bc is not null and tag is not null then case tag when 'DPM' then 'DNA' else 'RNA' end end route from id left join ce using (bc)",
    "identifier_route_all": with_views(READS, WHITELIST, _SPARSE, _IDENT)
    + f"select case when {_DNA} then 'DNA' when tag = 'RPM' then 'RNA' else 'NDNR' end || '_all' route, bc is not null and tag is not null \"full\", count(*) n, count(distinct case when tag is not null then c end) cells from id left join ce using (bc) group by 1, 2",
    "identifier_assign": with_views(READS, WHITELIST, _IDS) + "select \"key\", row_number() over (order by \"key\") id, n from ks",
    "identifier_seeded": with_views(READS, WHITELIST, _IDS, "e as (select *, cast(\"key\" as bigint) o from ks)") + "select \"key\", o * 10 id, n from e where o % 2 = 0 union all select \"key\", (select max(o) * 10 from e where o % 2 = 0) + row_number() over (order by \"key\"), n from e where o % 2 = 1",
}
