"""Inputs of the reference-style queries, derived from the tables: as DataFrames and as SQL.

frags: fragments of identified cells and complexes on known chromosomes, redeliveries removed.
whitelist and reads: barcodes of cell_idb, and a read per line item that carries one of them with
simulated errors. mates: alignments of two mates per order line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.ids import group_number, with_chromosome
from strandloom.plans.problems import _id_sql
from strandloom.storage import maybe_broadcast, spread, table


def frags(spark: SparkSession, d: str, by: list[str] | None = None) -> DataFrame:
    """idx, lib, cell, complex, gid (lib/complex), chr, start_pos, end_pos.

    `by`: rows that are equal in these columns are in one partition; removing redeliveries then needs no shuffle besides.
    """
    rows = spread(table(spark, d, "cluster_frags").drop("seen_at", "loaded_at"), "frag_id").filter("start_pos is not null and end_pos is not null").select(
        F.col("frag_id").alias("idx"), "lib", group_number(F.col("cell"), "CELL").alias("cell"), group_number(F.col("complex"), "COMPLEX").alias("complex"), "chr",
        F.least("start_pos", "end_pos").alias("start_pos"), F.greatest("start_pos", "end_pos").alias("end_pos"),
    )
    known = with_chromosome(rows.filter("cell is not null and complex is not null"), "chr", table(spark, d, "chrom_sizes")).filter("chr is not null")
    known = known.repartition(*by) if by else known
    return known.distinct().withColumn("gid", F.concat_ws("/", "lib", F.col("complex").cast("string")))


FRAGS = (
    "frags as (select *, lib || '/' || complex gid from (select distinct frag_id idx, lib, " + _id_sql("cell", "CELL") + " cell, " + _id_sql("complex", "COMPLEX") + " complex, c.chr,"
    " least(start_pos, end_pos) start_pos, greatest(start_pos, end_pos) end_pos from cluster_frags x join chrom_sizes c on regexp_replace(lower(trim(x.chr)), '^chr', '') = regexp_replace(lower(c.chr), '^chr', '')"
    " where start_pos is not null and end_pos is not null) where cell is not null and complex is not null)"
)


def whitelist(spark: SparkSession, d: str) -> DataFrame:
    """ord, seq: barcodes of the cells; of equal ones the smallest id."""
    return table(spark, d, "cell_idb").filter("names is not null and id is not null").groupBy(F.expr("substr(names, 4)").alias("seq")).agg(F.min("id").alias("ord")).select("ord", "seq")


WHITELIST = "whitelist as (select min(id) ord, substr(names, 4) seq from cell_idb where names is not null group by 2)"

_RID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint))"


def reads(spark: SparkSession, d: str) -> DataFrame:
    """rid, truth, seq (with errors), umi, qual, gene, cell, batch: one read per line item.

    truth is the barcode of cell l_partkey % 2000; a fifth has one substitution, a few an N. umi has
    4 bases, so that UMIs collide; qual has 16 characters.
    """
    lines = spread(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber").withColumn("rid", F.expr(_RID)).withColumn("id", F.expr("l_partkey % 2000"))
    # only ids that a remainder can be, so that the lines needn't be shuffled for it
    truth = maybe_broadcast(table(spark, d, "cell_idb").filter("names is not null and id > -2000 and id < 2000").select("id", F.expr("substr(names, 4)").alias("truth")))
    place = "cast(1 + l_orderkey % 16 as int)"
    wrong = f"case when l_suppkey % 5 = 0 then translate(substr(truth, {place}, 1), 'ACGT', 'CGTA') when l_suppkey % 5 = 1 and l_orderkey % 7 = 0 then 'N' end"
    seq = f"case when {wrong} is null then truth else substr(truth, 1, {place} - 1) || {wrong} || substr(truth, {place} + 1) end"
    bases = "translate({0}, '0123456789abcdef', 'ACGTACGTACGTACGT')"
    dna = bases.format("md5('{0}-' || rid)")
    return lines.join(truth, "id").select(
        "rid", "truth", F.expr(seq).alias("seq"), F.expr(bases.format("substr(md5('u-' || rid), 1, 4)")).alias("umi"), F.expr("translate(substr(md5('q-' || rid), 1, 16), '0123456789abcdef', '#%+/37:?@ABCDEFG')").alias("qual"),
        F.expr("'G' || cast(l_partkey % 50 as string)").alias("gene"), F.expr("l_orderkey % 97").alias("cell"), F.expr("l_linenumber % 3").cast("bigint").alias("kind"), F.expr(f"{dna.format('s')} || {dna.format('t')}").alias("body"), F.expr("translate(md5('p-' || rid) || md5('r-' || rid), '0123456789abcdef', '#%+/37:?@ABCDEFG')").alias("body_qual"),
    )


def _reads_sql() -> str:
    place = "(1 + l_orderkey % 16)"
    wrong = f"case when l_suppkey % 5 = 0 then translate(substr(truth, {place}, 1), 'ACGT', 'CGTA') when l_suppkey % 5 = 1 and l_orderkey % 7 = 0 then 'N' end"
    dna = "translate(md5('{0}-' || rid), '0123456789abcdef', 'ACGTACGTACGTACGT')"
    return (
        "reads as (select rid, truth, case when wrong is null then truth else substr(truth, 1, place - 1) || wrong || substr(truth, place + 1) end seq, "
        f"substr({dna.format('u')}, 1, 4) umi, translate(substr(md5('q-' || rid), 1, 16), '0123456789abcdef', '#%+/37:?@ABCDEFG') qual, 'G' || (l_partkey % 50) gene, l_orderkey % 97 cell, l_linenumber % 3 kind,"
        f" {dna.format('s')} || {dna.format('t')} body, translate(md5('p-' || rid) || md5('r-' || rid), '0123456789abcdef', '#%+/37:?@ABCDEFG') body_qual"
        f" from (select *, {place} place, {wrong} wrong from (select *, {_RID} rid from lineitem) l join (select id, substr(names, 4) truth from cell_idb where names is not null) t on t.id = l.l_partkey % 2000))"
    )


READS = _reads_sql()


def alignments(spark: SparkSession, d: str) -> DataFrame:
    """qname, flag, rname, pos, mapq, cigar: the line items of an order's part as mates."""
    lines = spread(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")
    return lines.selectExpr(
        "concat(cast(l_orderkey as string), '-', cast((l_linenumber - 1) div 2 as string)) as qname",
        "cast(1 + (case when l_linenumber % 2 = 1 then 64 else 128 end) + (case when l_returnflag = 'A' then 256 else 0 end) as bigint) as flag",
        "case when l_suppkey % 11 = 0 then '*' else concat('chr', cast(1 + l_orderkey % 3 + l_suppkey % 2 as string)) end as rname",
        "cast(l_partkey * 37 + l_quantity as bigint) as pos", "cast(l_suppkey % 61 as bigint) as mapq",
        "concat(cast(10 + l_linenumber as string), 'M', cast(l_linenumber as string), 'I', cast(20 + l_suppkey % 7 as string), 'M', cast(l_partkey % 4 as string), 'D', '5S') as cigar",
    )


ALIGNMENTS = (
    "alignments as (select l_orderkey || '-' || ((l_linenumber - 1) // 2) qname, cast(1 + (case when l_linenumber % 2 = 1 then 64 else 128 end) + (case when l_returnflag = 'A' then 256 else 0 end) as bigint) flag,"
    " case when l_suppkey % 11 = 0 then '*' else 'chr' || (1 + l_orderkey % 3 + l_suppkey % 2) end rname, l_partkey * 37 + cast(l_quantity as bigint) pos, l_suppkey % 61 mapq,"
    " (10 + l_linenumber) || 'M' || l_linenumber || 'I' || (20 + l_suppkey % 7) || 'M' || (l_partkey % 4) || 'D' || '5S' cigar,"
    " 10 + l_linenumber + 20 + l_suppkey % 7 + l_partkey % 4 len from lineitem)"
)


def blacklist(spark: SparkSession, d: str) -> DataFrame:
    """chr, start_pos, end_pos: a region for each order."""
    return table(spark, d, "orders").selectExpr("concat('chr', cast(1 + o_custkey % 17 as string)) as chr", "(o_orderkey * 7919) % 150000000 as start_pos", "(o_orderkey * 7919) % 150000000 + 20000 as end_pos")


BLACKLIST = "blacklist as (select 'chr' || (1 + o_custkey % 17) chr, (o_orderkey * 7919) % 150000000 start_pos, (o_orderkey * 7919) % 150000000 + 20000 end_pos from orders)"


def with_views(*parts: str, recursive: bool = False) -> str:
    return ("with recursive " if recursive else "with ") + ", ".join(parts) + " "
