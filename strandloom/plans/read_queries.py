"""Queries of read trimming and read QC with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import readqc as Q
from strandloom.operators import trim as T
from strandloom.plans.views import READS, reads, with_views
from strandloom.storage import materialise


def fastq(s, d):
    """rid, name, seq, qual (64 bases); two thirds of the reads run into an adapter."""
    seq = "case kind when 0 then substr(body, 1, 30) || 'AGATCGGAAGAGC' || substr(body, 31, 21) when 1 then substr(body, 1, 40) || 'CTGTCTCTTATA' || substr(body, 41, 12) else body end"
    name = "concat('M:1:FC:', cast(kind as string), ':', cast(1101 + cell % 4 as string), ':', rid)"
    made = reads(s, d).select("rid", F.expr(name).alias("name"), F.expr(seq).alias("seq"), F.col("body_qual").alias("qual"), "cell", "kind", "umi")
    return materialise(made, "fastq")


FASTQ = (
    "fq as (select rid, 'M:1:FC:' || kind || ':' || (1101 + cell % 4) || ':' || rid \"name\","
    " case kind when 0 then substr(body, 1, 30) || 'AGATCGGAAGAGC' || substr(body, 31, 21) when 1 then substr(body, 1, 40) || 'CTGTCTCTTATA' || substr(body, 41, 12) else body end seq, body_qual qual, cell, kind, umi from reads)"
)


def _pairs(s, d):
    f = fastq(s, d)
    return f.select("rid", F.col("name").alias("name1"), F.col("name").alias("name2"), F.col("seq").alias("seq1"), F.col("qual").alias("qual1"), T.reverse_complement(F.col("seq")).alias("seq2"), F.reverse("qual").alias("qual2"))


def trim_quality(s, d):
    return T.trim_quality(fastq(s, d)).select("rid", "seq", "qual")


def trim_two_colour(s, d):
    return T.trim_quality(fastq(s, d), two_colour=True).select("rid", "seq")


def trim_adapter_detect(s, d):
    return T.detect_adapter(T.adapter_counts(fastq(s, d)))


def trim_adapter(s, d):
    return T.trim_adapter(fastq(s, d), T.ADAPTERS["Illumina"]).select("rid", "seq")


def trim_clip(s, d):
    return T.clip(fastq(s, d), five=4, three=3).select("rid", "seq", "qual")


def trim_length(s, d):
    return T.long_enough(T.trim_adapter(fastq(s, d), T.ADAPTERS["Illumina"], min_overlap=5), 40).select("rid")


def trim_hard5(s, d):
    return T.hard_trim(fastq(s, d), 20, 5).select("rid", "seq", "qual")


def trim_hard3(s, d):
    return T.hard_trim(fastq(s, d), 20, 3).select("rid", "seq", "qual")


def trim_pair_validate(s, d):
    """Pairs of quality-trimmed mates by state."""
    f = fastq(s, d)
    mate = f.select("rid", T.reverse_complement(F.col("seq")).alias("seq"), F.reverse("qual").alias("qual"))
    out = T.validate_pairs(T.trim_quality(f.select("rid", "seq", "qual"), 30), T.trim_quality(mate, 30), "rid", 60, (62, 62))
    return out.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("seq1")).alias("b1"), F.sum(F.length("seq2")).alias("b2"))


def umi_transfer(s, d):
    return T.transfer_umi(_pairs(s, d)).select("rid", "name1", "seq2", "qual2")


def clock_trim(s, d):
    return T.clock_trim(_pairs(s, d)).select("rid", "name2", "seq1", "qual2", "lacking")


def rrbs_trim(s, d):
    f = fastq(s, d).withColumn("full_length", F.lit(64))
    return T.trim_rrbs(T.trim_adapter(f, T.ADAPTERS["Nextera"], min_overlap=5), directional=False).select("rid", "seq")


def polya_detect(s, d):
    return T.detect_poly(fastq(s, d).withColumn("seq", F.concat("seq", F.expr("repeat(case when kind = 0 then 'A' else 'T' end, cast(cell % 15 as int))"))))


def polya_trim(s, d):
    f = fastq(s, d).withColumns({"seq": F.concat("seq", F.expr("repeat('A', cast(cell % 7 as int))")), "qual": F.concat("qual", F.expr("repeat('I', cast(cell % 7 as int))"))})
    return T.trim_poly_a(f).select("rid", "name", "seq", "qual")


def polyt_trim(s, d):
    """T's off the 3' end of read 1, A's off the 5' end of read 2, its reverse complement."""
    f = fastq(s, d).withColumns({"seq": F.concat("seq", F.expr("repeat('T', cast(cell % 7 as int))")), "qual": F.concat("qual", F.expr("repeat('I', cast(cell % 7 as int))"))})
    mate = f.withColumns({"seq": T.reverse_complement(F.col("seq")), "qual": F.reverse("qual")})
    one, two = T.trim_poly(f, "T").select("rid", "name", "seq"), T.trim_poly(mate, "A", end=5).select("rid", F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    return one.join(two, "rid")


def trim_pair_n(s, d):
    """Pairs whose mates have at most one N."""
    r = reads(s, d).select("rid", "seq", "qual")
    mate = r.select("rid", F.reverse("seq").alias("seq"), F.reverse("qual").alias("qual"))
    return T.validate_pairs(r, mate, "rid", 10, max_n=0).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def reverse_complement(s, d):
    return fastq(s, d).select("rid", T.reverse_complement(F.col("seq")).alias("seq"))


def prefix_removal(s, d):
    """Reads without the 5' adapters, which are the starts that at least one in 1000 reads have."""
    f = fastq(s, d)
    starts = f.groupBy(F.expr("substr(seq, 1, cast(4 + kind as int))").alias("adapter")).agg(F.count(F.lit(1)).alias("n"))
    adapters = materialise(starts.join(F.broadcast(f.agg(F.count(F.lit(1)).alias("all")))).filter("n * 1000 >= all").select("adapter"), "adapters")
    return T.remove_prefixes(f.select("rid", "seq", "qual"), adapters).groupBy(F.length("seq").cast("bigint").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def trim_summary(s, d):
    return T.summary(fastq(s, d), T.ADAPTERS["Illumina"])


def trim_adapter_lengths(s, d):
    found = T.adapter_lengths(fastq(s, d), T.ADAPTERS["Illumina"])
    return found.select("length", "reads", F.round("expected", 6).alias("expected"), "max_errors")


def trim_report(s, d):
    f = fastq(s, d)
    return T.report(f, T.long_enough(T.trim_adapter(T.trim_quality(f), T.ADAPTERS["Illumina"]), 20))


def qc_basic(s, d):
    return Q.basic(fastq(s, d))


def qc_base_quality(s, d):
    return Q.per_base_quality(fastq(s, d)).withColumn("mean", F.round("mean", 6))


def qc_sequence_quality(s, d):
    return Q.per_sequence_quality(fastq(s, d))


def qc_composition(s, d):
    return Q.composition(fastq(s, d)).select("pos", *[F.round(c, 6).alias(c) for c in "acgt"], "grade")


def qc_gc(s, d):
    return Q.gc_content(fastq(s, d)).withColumn("expected", F.round("expected", 4))


def qc_n(s, d):
    return Q.n_content(reads(s, d)).withColumn("n", F.round("n", 6))


def qc_lengths(s, d):
    return Q.lengths(T.trim_quality(fastq(s, d)))


def qc_duplication(s, d):
    return Q.duplication(reads(s, d))


def qc_remaining(s, d):
    return Q.remaining(reads(s, d)).withColumn("remaining", F.round("remaining", 6))


def qc_overrepresented(s, d):
    return Q.overrepresented(reads(s, d)).withColumn("percent", F.round("percent", 6))


def qc_contaminants(s, d):
    """Overrepresented reads against the list of contaminants, which are the true barcodes of the reads."""
    r = reads(s, d)
    known = r.select(F.concat(F.lit("c"), "truth").alias("name"), F.col("truth").alias("contaminant")).distinct()
    return Q.contaminants(Q.overrepresented(r, 0.05), known, overlap=14)


def qc_adapter(s, d):
    return Q.adapter_content(fastq(s, d)).withColumn("percent", F.round("percent", 6))


def qc_grades(s, d):
    """Grades of GC content, read lengths and adapter content."""
    f = fastq(s, d)
    parts = {"gc": Q.gc_grade(f), "lengths": Q.lengths_grade(T.trim_quality(f)), "adapter": Q.adapter_grade(f)}
    out = None
    for name, part in parts.items():
        rows = part.select(F.lit(name).alias("module"), F.round("value", 4).alias("value"), "grade")
        out = rows if out is None else out.unionByName(rows)
    return out


def qc_kmer(s, d):
    k = Q.kmers(fastq(s, d), 5)
    return k.filter("seen >= 20").select("kmer", "pos", "seen", F.round("ratio", 6).alias("ratio"), F.round("z", 5).alias("z"))


def qc_tile(s, d):
    return Q.tiles(fastq(s, d)).withColumn("deviation", F.round("deviation", 6))


QUERIES = {
    f.__name__: f
    for f in (
        trim_quality, trim_two_colour, trim_adapter_detect, trim_adapter, trim_clip, trim_length, trim_hard5, trim_hard3, trim_pair_validate, umi_transfer, clock_trim, rrbs_trim, polya_detect, polya_trim, polyt_trim, trim_pair_n, reverse_complement, prefix_removal, trim_report, trim_summary, trim_adapter_lengths,
        qc_basic, qc_base_quality, qc_sequence_quality, qc_composition, qc_gc, qc_n, qc_lengths, qc_duplication, qc_remaining, qc_overrepresented, qc_contaminants, qc_adapter, qc_grades, qc_kmer, qc_tile,
    )
}

_FQ = with_views(READS, FASTQ)


def _cut_sql(source: str, cutoff: int, name: str, two_colour: bool = False) -> str:
    score = "ascii(substr(qual, i, 1)) - 33"
    if two_colour:
        score = f"case when substr(seq, i, 1) = 'G' then {cutoff - 1} else {score} end"
    return (
        f"{name}a as (select rid, i, sum({cutoff} - ({score})) over (partition by rid order by i desc) s from (select rid, seq, qual, unnest(range(1, 65)) i from {source})),"
        f" {name}b as (select rid, i, s, min(s) over (partition by rid order by i desc) mn from {name}a),"
        f" {name} as (select f.*, coalesce(k, 64) keep from {source} f left join (select rid, arg_max(i, s * 1000 + i) - 1 k from {name}b where mn >= 0 and s > 0 group by rid) x on x.rid = f.rid)"
    )


def _adapter_sql(source: str, name: str, adapter: str, overlap: int = 1) -> str:
    n = len(adapter)
    return (
        f"{name}p as (select rid, min(p) p from (select rid, p, least({n}, length(seq) - p + 1) o, len([k for k in range(1, cast(least({n}, length(seq) - p + 1) + 1 as bigint)) if substr(seq, cast(p + k - 1 as int), 1) <> substr('{adapter}', cast(k as int), 1)]) w"
        f" from (select rid, seq, unnest(range(1, length(seq) + 1)) p from {source})) where o >= {overlap} and w <= floor(o * 0.1) group by rid),"
        f" {name} as (select f.*, coalesce(p, length(seq) + 1) - 1 cut from {source} f left join {name}p x on x.rid = f.rid)"
    )


_POS = "bs as (select rid, i pos, substr(seq, i, 1) b, ascii(substr(qual, i, 1)) - 33 q, split_part(\"name\", ':', 5) tile from (select *, unnest(range(1, length(seq) + 1)) i from {0}))"
_RC = "translate(reverse(seq), 'ACGT', 'TGCA')"
_G = "case when {0} > {2} then 'fail' when {0} > {1} then 'warn' else 'pass' end"
_L = "case when {0} < {2} then 'fail' when {0} < {1} then 'warn' else 'pass' end"

SQL = {
    "trim_quality": with_views(READS, FASTQ, _cut_sql("fq", 20, "c")) + "select rid, substr(seq, 1, keep) seq, substr(qual, 1, keep) qual from c",
    "trim_two_colour": with_views(READS, FASTQ, _cut_sql("fq", 20, "c", True)) + "select rid, substr(seq, 1, keep) seq from c",
    "trim_adapter_detect": with_views(READS, FASTQ, "n as (select count(*) reads, count_if(contains(seq, 'AGATCGGAAGAGC')) \"Illumina\", count_if(contains(seq, 'CTGTCTCTTATA')) \"Nextera\", count_if(contains(seq, 'TGGAATTCTCGG')) \"smallRNA\" from fq)")
    + "select case when \"Illumina\" >= greatest(\"Nextera\", \"smallRNA\") then 'Illumina' when \"Nextera\" >= \"smallRNA\" then 'Nextera' else 'smallRNA' end adapter,"
    " case when \"Illumina\" >= greatest(\"Nextera\", \"smallRNA\") then 'AGATCGGAAGAGC' when \"Nextera\" >= \"smallRNA\" then 'CTGTCTCTTATA' else 'TGGAATTCTCGG' end \"sequence\", * from n",
    "trim_adapter": with_views(READS, FASTQ, _adapter_sql("fq", "a", "AGATCGGAAGAGC")) + "select rid, substr(seq, 1, cut) seq from a",
    "trim_clip": _FQ + "select rid, substr(seq, 5, 57) seq, substr(qual, 5, 57) qual from fq",
    "trim_length": with_views(READS, FASTQ, _adapter_sql("fq", "a", "AGATCGGAAGAGC", 5)) + "select rid from a where cut >= 40",
    "trim_hard5": _FQ + "select rid, substr(seq, 1, 20) seq, substr(qual, 1, 20) qual from fq",
    "trim_hard3": _FQ + "select rid, right(seq, 20) seq, right(qual, 20) qual from fq",
    "trim_pair_validate": with_views(READS, FASTQ, f"rv as (select rid, {_RC} seq, reverse(qual) qual from fq)", _cut_sql("fq", 30, "c"), _cut_sql("rv", 30, "e"), "st as (select c.keep k1, e.keep k2 from c join e using (rid))")
    + "select case when k1 >= 60 and k2 >= 60 then 'pair' when k1 >= 62 then 'only1' when k2 >= 62 then 'only2' else 'dropped' end state, count(*) n, cast(sum(k1) as bigint) b1, cast(sum(k2) as bigint) b2 from st group by 1",
    "umi_transfer": _FQ + f"select rid, \"name\" || ':' || substr({_RC}, 1, 8) name1, substr({_RC}, 9) seq2, substr(reverse(qual), 9) qual2 from fq",
    "clock_trim": _FQ + f"select rid, \"name\" || ':R1:' || substr(seq, 1, 8) || ':R2:' || substr({_RC}, 1, 8) || ':F1:' || substr(seq, 9, 4) || ':F2:' || substr({_RC}, 9, 4) name2, substr(seq, 14) seq1, substr(reverse(qual), 14) qual2, substr(seq, 9, 4) <> 'CAGT' or substr({_RC}, 9, 4) <> 'CAGT' lacking from fq",
    "rrbs_trim": with_views(READS, FASTQ, _adapter_sql("fq", "a", "CTGTCTCTTATA", 5), "t as (select rid, substr(seq, 1, cut) seq from a)") + "select rid, case when length(seq) > 2 and (seq like 'CAA%' or seq like 'CGA%') then substr(seq, 3) when length(seq) < 64 and length(seq) >= 3 then substr(seq, 1, length(seq) - 2) else seq end seq from t",
    "polya_detect": with_views(READS, FASTQ, "t as (select seq || repeat(case when kind = 0 then 'A' else 'T' end, cell % 15) s from fq)") + "select count_if(contains(s, repeat('A', 10))) poly_a, count_if(contains(s, repeat('T', 10))) poly_t, case when count_if(contains(s, repeat('T', 10))) > count_if(contains(s, repeat('A', 10))) then 'T' else 'A' end polymer from t",
    "polya_trim": with_views(READS, FASTQ, "t as (select rid, \"name\", seq || repeat('A', cell % 7) seq, qual || repeat('I', cell % 7) qual from fq)", "u as (select *, length(regexp_extract(seq, '(A{3,})$', 1)) k from t)") + "select rid, case when k > 0 then k || ':' || \"name\" || '_PolyA:' || k else \"name\" end \"name\", substr(seq, 1, length(seq) - k) seq, substr(qual, 1, length(seq) - k) qual from u",
    "polyt_trim": with_views(READS, FASTQ, "t as (select rid, \"name\", seq || repeat('T', cell % 7) seq, qual || repeat('I', cell % 7) qual from fq)", "u as (select *, length(regexp_extract(seq, '(T{3,})$', 1)) k from t)")
    + "select rid, case when k > 0 then k || ':' || \"name\" || '_PolyT:' || k else \"name\" end \"name\", substr(seq, 1, length(seq) - k) seq, substr(translate(reverse(seq), 'ACGT', 'TGCA'), k + 1) seq2, substr(reverse(qual), k + 1) qual2 from u",
    "trim_pair_n": with_views(READS) + "select case when seq like '%N%' then 'dropped' else 'pair' end state, count(*) n from reads group by 1",
    "reverse_complement": _FQ + f"select rid, {_RC} seq from fq",
    "prefix_removal": with_views(READS, FASTQ, "ad as (select substr(seq, 1, 4 + kind) a from fq group by 1 having count(*) * 1000 >= (select count(*) from fq))", "t as (select 64 - case when substr(seq, 1, 6) in (select a from ad) then 6 when substr(seq, 1, 5) in (select a from ad) then 5 when substr(seq, 1, 4) in (select a from ad) then 4 else 0 end l from fq)") + "select l length, count(*) n from t group by l",
    "trim_summary": with_views(READS, FASTQ, _cut_sql("fq", 20, "c"), "t as (select rid, length(seq) was, substr(seq, 1, keep) seq from c)", _adapter_sql("t", "a", "AGATCGGAAGAGC"))
    + "select count(*) reads, count_if(cut < length(seq)) with_adapter, cast(sum(was) as bigint) bases_in, cast(sum(was - length(seq)) as bigint) bases_quality, cast(sum(length(seq) - cut) as bigint) bases_adapter, cast(sum(cut) as bigint) bases_out from a",
    "trim_adapter_lengths": with_views(READS, FASTQ, _adapter_sql("fq", "a", "AGATCGGAAGAGC"), "l as (select cast(length(seq) - cut as bigint) length, count(*) reads from a group by 1)")
    + "select length, reads, round((select count(*) from fq) * pow(0.25, least(length, 13)), 6) expected, cast(floor(least(length, 13) * 0.1) as bigint) max_errors from l where length > 0",
    "trim_report": with_views(READS, FASTQ, _cut_sql("fq", 20, "c"), "t as (select rid, substr(seq, 1, keep) seq from c)", _adapter_sql("t", "a", "AGATCGGAAGAGC")) + "select (select count(*) from fq) reads_in, (select cast(sum(length(seq)) as bigint) from fq) bases_in, count(*) reads_out, cast(sum(cut) as bigint) bases_out from a where cut >= 20",
    "qc_basic": _FQ + "select count(*) reads, min(length(seq)) shortest, max(length(seq)) longest, cast(floor(sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) * 100 / sum(length(regexp_replace(seq, '[^ACGT]', '', 'g')))) as bigint) gc from fq",
    "qc_base_quality": with_views(READS, FASTQ, _POS.format("fq"), "w as (select pos, q, row_number() over (partition by pos order by q) r, count(*) over (partition by pos) n from bs)", "o as (select pos, avg(q) mean, " + ", ".join(f"min(case when r * 100 >= n * {p} then q end) p{p}" for p in (10, 25, 50, 75, 90)) + " from w group by pos)")
    + "select pos, round(mean, 6) mean, p10, p25, p50, p75, p90, case when p25 < 5 or p50 < 20 then 'fail' when p25 < 10 or p50 < 25 then 'warn' else 'pass' end grade from o",
    "qc_sequence_quality": _FQ + "select cast(floor(list_sum([ascii(substr(qual, cast(i as int), 1)) - 33 for i in range(1, 65)]) / 64) as bigint) mean_quality, count(*) reads from fq group by 1",
    "qc_composition": with_views(READS, FASTQ, _POS.format("fq"), "o as (select pos, " + ", ".join(f"100.0 * count_if(b = '{x}') / count(*) {x.lower()}" for x in "ACGT") + " from bs group by pos)")
    + "select pos, " + ", ".join(f"round({x}, 6) {x}" for x in "acgt") + ", " + _G.format("greatest(abs(a - t), abs(g - c))", 10, 20) + " grade from o",
    "qc_gc": with_views(READS, FASTQ, "h as (select cast(round(length(regexp_replace(seq, '[^GC]', '', 'g')) * 100.0 / length(seq)) as bigint) gc, count(*) reads from fq group by 1)", "m as (select arg_max(gc, reads * 1000 + gc) md, sum(reads) n from h)", "s as (select md, n, sqrt(sum((gc - md) * (gc - md) * reads) / greatest(n - 1, 1)) sd from h, m group by md, n)")
    + "select gc, reads, round(n * exp(-((gc - md) * (gc - md)) / (2 * sd * sd)) / (sd * 2.5066282746310002), 4) expected from h, s",
    "qc_n": with_views(READS, "bs as (select i pos, substr(seq, i, 1) b from (select seq, unnest(range(1, length(seq) + 1)) i from reads))", "o as (select pos, 100.0 * count_if(b = 'N') / count(*) n from bs group by pos)") + "select pos, round(n, 6) n, " + _G.format("n", 5, 20) + " grade from o",
    "qc_lengths": with_views(READS, FASTQ, _cut_sql("fq", 20, "c")) + "select keep length, count(*) reads from c group by keep",
    "qc_duplication": with_views(READS, "k as (select count(*) k from reads group by seq)") + "select least(k, 10) \"level\", count(*) sequences, cast(sum(k) as bigint) reads from k group by 1",
    "qc_remaining": with_views(READS, "k as (select count(*) k from reads group by seq)", "o as (select 100.0 * count(*) / sum(k) r from k)") + "select round(r, 6) remaining, " + _L.format("r", 70, 50) + " grade from o",
    "qc_overrepresented": with_views(READS, "k as (select seq \"sequence\", count(*) reads, 100.0 * count(*) / (select count(*) from reads) p from reads group by seq)") + "select \"sequence\", reads, round(p, 6) percent, " + _G.format("p", 0.1, 1) + " grade from k where p > 0.1",
    "qc_contaminants": with_views(READS, "f as (select seq s from reads group by seq having 100.0 * count(*) / (select count(*) from reads) > 0.05)", "k as (select distinct 'c' || truth \"name\", truth c from reads)", "fw as (select s, substr(s, i, 14) w from (select s, unnest(range(1, 4)) i from f))", "kw as (select \"name\", substr(c, i, 14) w from (select \"name\", c, unnest(range(1, 4)) i from k))") + "select distinct s \"sequence\", \"name\" from fw join kw on hamming(fw.w, kw.w) <= 1",
    "qc_grades": with_views(READS, FASTQ, _cut_sql("fq", 20, "c"), "h as (select cast(round(length(regexp_replace(seq, '[^GC]', '', 'g')) * 100.0 / length(seq)) as bigint) gc, count(*) reads from fq group by 1)", "m as (select arg_max(gc, reads * 1000 + gc) md, sum(reads) n from h)", "sp as (select md, n, sqrt(sum((gc - md) * (gc - md) * reads) / greatest(n - 1, 1)) sd from h, m group by md, n)",
        "g as (select 100.0 * sum(abs(coalesce(reads, 0) - n * exp(-((r.gc - md) * (r.gc - md)) / (2 * sd * sd)) / (sd * 2.5066282746310002))) / max(n) v from sp, range(0, 101) r(gc) left join h on h.gc = r.gc)", "l as (select cast(count(distinct keep) as double) v, min(keep) lo from c)",
        "ap as (select case when instr(seq, a) > 0 then 1 else 0 end hit, a from fq, (values " + ", ".join(f"('{a}')" for a in Q.ADAPTERS.values()) + ") v(a))", "ad as (select max(p) v from (select 100.0 * sum(hit) / count(*) p from ap group by a))")
    + "select 'gc' \"module\", round(v, 4) \"value\", " + _G.format("v", 15, 30) + " grade from g union all select 'lengths', v, case when lo = 0 then 'fail' when v > 1 then 'warn' else 'pass' end from l union all select 'adapter', round(v, 4), " + _G.format("v", 5, 10) + " from ad",
    "qc_adapter": with_views(READS, FASTQ, "ad as (select * from (values " + ", ".join("('" + k.replace("'", "''") + f"', '{a}')" for k, a in Q.ADAPTERS.items()) + ") v(adapter, a))", "h as (select adapter, instr(seq, a) p from fq, ad)")
    + "select adapter, g.pos, round(100.0 * count_if(p > 0 and p <= g.pos) / count(*), 6) percent from h, range(1, 65) g(pos) group by all",
    "qc_kmer": with_views(READS, FASTQ, "r as (select i pos, substr(seq, i, 5) kmer from (select seq, unnest(range(1, 61)) i from fq))", "c as (select kmer, pos, count(*) seen from r group by all)", "e as (select *, sum(seen) over (partition by kmer) k, sum(seen) over (partition by pos) p, sum(seen) over () n from c)")
    + "select kmer, pos, seen, round(seen / (k / n * p), 6) ratio, round((seen - k / n * p) / sqrt(k / n * p * (1 - k / n)), 5) z from (select kmer, pos, seen, cast(k as double) k, cast(p as double) p, cast(n as double) n from e) where seen >= 20",
    "qc_tile": with_views(READS, FASTQ, _POS.format("fq"), "t as (select tile, pos, avg(q) m from bs group by all)", "p as (select pos, avg(q) m from bs group by pos)", "o as (select tile, t.pos, t.m - p.m d from t join p using (pos))") + "select tile, pos, round(d, 6) deviation, " + _G.format("-d", 5, 10) + " grade from o",
}
