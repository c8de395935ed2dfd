"""Queries of the streaming operators over the whole table of events, and of a whole pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.plans import pipelines
from strandloom.plans.views import ALIGNMENTS, BLACKLIST, alignments, blacklist, with_views
from strandloom.storage import table
from strandloom.streaming.sessions import hourly, sessions


def session_merge(s, d):
    """Sessions of users with gaps under 30 minutes."""
    return sessions(table(s, d, "events")).select("user_id", F.date_format("started", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("started"), F.date_format("ended", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ended"), "events", F.round("value", 4).alias("value"))


def hourly_events(s, d):
    return hourly(table(s, d, "events")).select(F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "events", F.round("value", 4).alias("value"))


def named_alignments(s, d):
    """The alignments with names that hold the complex and the cell of their order."""
    order = F.substring_index("qname", "-", 1).cast("bigint")
    name = F.concat("qname", F.lit("|||BC:A|||CELL_"), (order % 97).cast("string"), F.lit("|COMPLEX_"), (order % 1009).cast("string"))
    return alignments(s, d).withColumn("qname", name)


def _spliced(s, d):
    """The alignments as a spliced aligner scores them: 255 where unique, else 0 to 3; some chromosomes have other names."""
    return named_alignments(s, d).withColumns({"mapq": F.expr("case when mapq % 2 = 0 then 255L else mapq % 4 end"), "rname": F.expr("case when rname = 'chr4' then 'chrUn_4' else rname end")})


def pipeline_chiadrop(s, d):
    """Regions of each complex: mate 1, merged, split by chromosome, then without unplaced chromosomes."""
    return pipelines.refine(named_alignments(s, d).withColumn("rname", F.expr("case when rname = 'chr2' then 'chrUn_2' else rname end")), "chiadrop", contacts=False)["regions"].select("gid", "sub_id", "chr", "start_pos", "end_pos")


def pipeline_sprite(s, d):
    """Regions of each complex: alignments over the blacklist left out, duplicates by start removed."""
    return pipelines.refine(named_alignments(s, d), "sprite", blacklist(s, d))["regions"].select("gid", "sub_id", "chr", "start_pos", "end_pos", "dup")


def pipeline_rdsprite(s, d):
    """Lengths of the DNA and RNA fragments of each complex."""
    return pipelines.refine(named_alignments(s, d), "rdsprite", rna=_spliced(s, d))["mixed"]


def pipeline_scsprite(s, d):
    """Regions of each complex of a cell: unique alignments, duplicates by start removed."""
    return pipelines.refine(_spliced(s, d), "scsprite")["regions"].select("parent", "gid", "sub_id", "chr", "start_pos", "end_pos", "dup")


def pipeline_scatac(s, d):
    """Fragments of each cell over each peak."""
    return pipelines.refine(named_alignments(s, d), "scatac", peak={"cutoff": 3, "min_length": 20, "max_gap": 10})["counts"]


QUERIES = {f.__name__: f for f in (session_merge, hourly_events, pipeline_chiadrop, pipeline_sprite, pipeline_rdsprite, pipeline_scsprite, pipeline_scatac)}

# The SQL follows the steps of each method's own description, not the Python above.
_PLACE = "case when m2 is null then m1 when m1 is null then m2 when m1.r = m2.r then {{r: m1.r, s: least(m1.s, m2.s), e: greatest(m1.e, m2.e)}} when m1.e - m1.s >= m2.e - m2.s then m1 else m2 end p"
_AL = (
    "{n}al as (select qname, split_part(qname, '-', 1)::bigint o, flag, {r} rname, pos, pos + len e, {q} mapq from alignments),"
    " {n}mt as (select qname, o, min(case when flag & 128 = 0 and rname <> '*' then {{r: rname, s: pos, e: e}} end) m1, min(case when flag & 128 <> 0 and rname <> '*' then {{r: rname, s: pos, e: e}} end) m2,"
    " count_if(flag & 128 = 0) a, count_if(flag & 128 <> 0) b from {n}al where {w} group by all),"
    " {n}fr as (select qname, o, " + _PLACE + " from {n}mt{h})"
)
_Q30 = "flag & 2304 = 0 and mapq >= 30"
_STAR = {"r": "case when rname = 'chr4' then 'chrUn_4' else rname end", "q": "case when mapq % 2 = 0 then 255 else mapq % 4 end", "w": "mapq = 255"}


def _al(n: str = "", w: str = _Q30, h: str = "", r: str = "rname", q: str = "mapq") -> str:
    return _AL.format(n=n, w=w, h=h, r=r, q=q)


_CHIA = (
    "x as (select cast(o % 1009 as varchar) gid, p.r chr, p.s start_pos, p.e + 100 end_pos from fr where p is not null), y as (select *, max(end_pos) over (partition by gid, chr order by start_pos, end_pos rows between unbounded preceding and 1 preceding) prev from x),"
    " z as (select *, sum(case when prev + 3000 >= start_pos then 0 else 1 end) over (partition by gid, chr order by start_pos, end_pos rows unbounded preceding) k from y),"
    " m as (select gid, chr, min(start_pos) start_pos, max(end_pos) end_pos from z group by gid, chr, k), f as (select gid, chr, row_number() over (partition by gid order by chr) - 1 n from m group by gid, chr)"
)


def _single(n: str = "") -> str:
    """One fragment for each chromosome and start of a complex, the first by place, and chromosomes by first appearance."""
    return (
        f"{n}dd as (select cast(o % 97 as varchar) cell, cast(o % 1009 as varchar) gid, p.r chr, p.s start_pos, min(p.e) end_pos, count(*) dup from {n}fr where p is not null group by {{}}),"
        f" {n}f as (select gid, chr, row_number() over (partition by gid order by chr) - 1 n from {n}dd group by gid, chr)"
    )


_BY_COMPLEX, _BY_CELL = (s.format(g) for s, g in ((_single(), "2, 3, 4"), (_single(), "1, 2, 3, 4")))
_LENGTHS = "select '{t}' \"type\", chr, start_pos, end_pos, gid || '-' || count(*) over (partition by gid) || '-' || (row_number() over (partition by gid order by start_pos, chr, end_pos) - 1) \"name\", end_pos - start_pos len from {n}dd"
_ATAC = (
    "frags as (select cast(o % 97 as varchar) cell, p.r chr, p.s + 4 start_pos, p.e - 5 end_pos from fr where p is not null group by all),"
    " ev as (select chr, p, sum(d) d from (select chr, start_pos p, 1 d from frags where start_pos < end_pos union all select chr, end_pos, -1 from frags where start_pos < end_pos) group by all having sum(d) <> 0),"
    " dp as (select chr, p start_pos, lead(p) over (partition by chr order by p) end_pos, sum(d) over (partition by chr order by p) depth from ev),"
    " hi as (select *, case when start_pos - lag(end_pos) over (partition by chr order by start_pos) <= 10 then 0 else 1 end nw from dp where depth >= 3), isl as (select *, sum(nw) over (partition by chr order by start_pos) k from hi),"
    " peaks as (select chr, min(start_pos) start_pos, max(end_pos) end_pos from isl group by chr, k having max(end_pos) - min(start_pos) >= 20)"
)
SQL = {
    "session_merge": "with a as (select user_id, ts, value, case when ts < lag(ts) over (partition by user_id order by ts) + interval 30 minutes then 0 else 1 end nw from events where user_id is not null and ts is not null), b as (select *, sum(nw) over (partition by user_id order by ts rows unbounded preceding) k from a)"
    " select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') started, strftime(max(ts) + interval 30 minutes, '%Y-%m-%d %H:%M:%S.%f') ended, count(*) events, round(sum(value), 4) \"value\" from b group by user_id, k",
    "hourly_events": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') \"hour\", event_type, count(*) events, round(sum(value), 4) \"value\" from events where ts is not null group by all",
    "pipeline_chiadrop": with_views(ALIGNMENTS, _al(w=_Q30 + " and flag & 64 <> 0", r="case when rname = 'chr2' then 'chrUn_2' else rname end"), _CHIA) + "select m.gid, m.gid || '-' || n sub_id, chr, start_pos, end_pos from m join f using (gid, chr) where not regexp_matches(chr, 'Het|chrU|chrM')",
    "pipeline_sprite": with_views(ALIGNMENTS, BLACKLIST, _al(w=_Q30 + " and not exists (select 1 from blacklist b where b.chr = al.rname and al.pos < b.end_pos and b.start_pos < al.e)"), _BY_COMPLEX.replace("cast(o % 97 as varchar) cell", "null cell")) + "select dd.gid, dd.gid || '-' || n sub_id, chr, start_pos, end_pos, dup from dd join f using (gid, chr)",
    "pipeline_rdsprite": with_views(ALIGNMENTS, _al(), _al("r", **_STAR), _single().format("2, 3, 4").replace("cast(o % 97 as varchar) cell", "null cell"), _single("r").format("2, 3, 4").replace("cast(o % 97 as varchar) cell", "null cell")) + _LENGTHS.format(t="DNA", n="") + " union all " + _LENGTHS.format(t="RNA", n="r"),
    "pipeline_scsprite": with_views(ALIGNMENTS, _al(**_STAR), _BY_CELL) + "select cell parent, dd.gid, dd.gid || '-' || n sub_id, chr, start_pos, end_pos, dup from dd join f using (gid, chr)",
    "pipeline_scatac": with_views(ALIGNMENTS, _al(h=" where a > 0 and b > 0"), _ATAC) + "select p.chr, p.start_pos, p.end_pos, cell, count(*) n from frags f join peaks p on p.chr = f.chr and f.start_pos < p.end_pos and p.start_pos < f.end_pos and f.start_pos < f.end_pos group by all",
}
