"""Queries of the general problems: p1 (keys that hold most rows) and p2 (periods and gaps)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.ids import group_number, with_chromosome
from strandloom.operators.skew import distinct_counts, skew_join
from strandloom.operators.sweep import sweep
from strandloom.storage import materialise, spread, table

KINDS = {"cell": "CELL", "complex": "COMPLEX"}

#: An id of p1_found holds at least one of so many distinct fragments.
SHARE = 100


def fragment_keys(spark: SparkSession, d: str) -> DataFrame:
    """(key_value, frag_id): a row for the cell and one for the complex of each fragment row."""
    frags = spread(table(spark, d, "cluster_frags").select("frag_id", *KINDS))
    both = F.array(*[F.struct(F.lit(f"{p}_").alias("p"), group_number(F.col(c), p).alias("n")) for c, p in KINDS.items()])
    return (
        frags.select("frag_id", F.explode(both).alias("k"))
        .filter("k.n is not null")
        .select(F.concat("k.p", F.col("k.n").cast("string")).alias("key_value"), "frag_id")
    )


def _named(counts: DataFrame) -> DataFrame:
    kind = F.lower(F.substring_index("key_value", "_", 1))
    return counts.select(kind.alias("key_kind"), "key_value", "fragments")


def p1_counts(spark: SparkSession, d: str) -> DataFrame:
    """Distinct fragments of every cell and complex."""
    return _named(distinct_counts(fragment_keys(spark, d), "key_value", "frag_id", name="fragments"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Ids with at least 1% of all distinct fragments."""
    total = table(spark, d, "cluster_frags").agg(F.countDistinct("frag_id")).first()[0]
    return p1_counts(spark, d).filter(F.col("fragments") * SHARE >= total).select("key_kind", "key_value")


def p1_barcodes(spark: SparkSession, d: str) -> DataFrame:
    """Distinct fragments and reported reads of each cell with its barcode; cells without a row keep null."""
    frags = spread(table(spark, d, "cluster_frags").select("cell", "frag_id")).select(group_number(F.col("cell"), "CELL").alias("id"), "frag_id").filter("id is not null")
    idb = table(spark, d, "cell_idb").select("id", F.col("n").alias("reads"), F.substring_index("names", ":", -1).alias("barcode"))
    label = skew_join(frags, idb, "id", how="left").select("frag_id", F.struct("id", "barcode", "reads").alias("key"))
    keyed = materialise(label.select("frag_id", F.to_json("key", {"ignoreNullFields": "false"}).alias("key")), "labelled")
    counts = distinct_counts(keyed, "key", "frag_id", name="fragments")
    parsed = F.from_json("key", "id bigint, barcode string, reads bigint")
    return counts.select(parsed.alias("k"), "fragments").select("k.id", "k.barcode", "k.reads", "fragments")


def intervals(spark: SparkSession, d: str) -> DataFrame:
    """(lib, complex, chr, start_pos, end_pos) with the complex number and the standard chromosome."""
    frags = spread(table(spark, d, "cluster_frags").select("lib", "complex", "chr", "start_pos", "end_pos")).select("lib", group_number(F.col("complex"), "COMPLEX").alias("complex"), "chr", "start_pos", "end_pos")
    return with_chromosome(frags, "chr", table(spark, d, "chrom_sizes"))


def p2_sweep(spark: SparkSession, d: str) -> DataFrame:
    """All periods and gaps of each library, complex and chromosome."""
    swept = sweep(intervals(spark, d), ["lib", "complex", "chr"], "start_pos", "end_pos")
    return swept.withColumn("complex", F.concat(F.lit("COMPLEX_"), F.col("complex").cast("string"))).select("lib", "complex", "chr", "kind", "start_pos", "end_pos")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The gaps alone."""
    gaps = p2_sweep(spark, d).filter("kind = 'gap'")
    return gaps.select("lib", "complex", "chr", F.col("start_pos").alias("gap_start"), F.col("end_pos").alias("gap_end"))


QUERIES = {f.__name__: f for f in (p1_found, p1_counts, p1_barcodes, p2_found, p2_sweep)}


def _id_sql(column: str, prefix: str) -> str:
    return f"try_cast(nullif(regexp_extract({column}, '^\\s*(?:{prefix}_)?0*([0-9]+)\\s*$', 1, 'i'), '') as bigint)"


_KEYS = "with k as (select frag_id, 'cell' key_kind, 'CELL_' || " + _id_sql("cell", "CELL") + " key_value from cluster_frags union all select frag_id, 'complex', 'COMPLEX_' || " + _id_sql("complex", "COMPLEX") + " from cluster_frags)"

#: `f` of the SQL: intervals with the complex number and the chromosome's spelling.
INTERVALS_SQL = (
    "f as (select distinct lib, " + _id_sql("complex", "COMPLEX") + " complex, c.chr, least(start_pos, end_pos) lo, greatest(start_pos, end_pos) hi"
    " from cluster_frags x join chrom_sizes c on regexp_replace(lower(trim(x.chr)), '^chr', '') = regexp_replace(lower(c.chr), '^chr', '')"
    " where start_pos is not null and end_pos is not null)"
)

_SWEEP = (
    "with " + INTERVALS_SQL + ", o as (select *, max(hi) over (partition by lib, complex, chr order by lo, hi rows between unbounded preceding and 1 preceding) prev"
    " from f where lo < hi and complex is not null and lib is not null),"
    " p as (select lib, complex, chr, min(lo) s, max(hi) e from (select *, sum(case when prev is null or lo > prev then 1 else 0 end) over (partition by lib, complex, chr order by lo, hi rows unbounded preceding) k from o)"
    " group by lib, complex, chr, k), g as (select lib, 'COMPLEX_' || complex complex, chr, s, e, lead(s) over (partition by lib, complex, chr order by s) nxt from p)"
)

SQL = {
    "p1_found": _KEYS + " select key_kind, key_value from k where key_value is not null group by all having count(distinct frag_id) * 100 >= (select count(distinct frag_id) from cluster_frags)",
    "p1_counts": _KEYS + " select key_kind, key_value, count(distinct frag_id) fragments from k where key_value is not null and frag_id is not null group by all",
    "p1_barcodes": "with k as (select frag_id, " + _id_sql("cell", "CELL") + " id from cluster_frags) select k.id, regexp_replace(names, '^.*:', '') barcode, n reads, count(distinct frag_id) fragments"
    " from k left join cell_idb i on i.id = k.id where k.id is not null and frag_id is not null group by all",
    "p2_found": _SWEEP + " select lib, complex, chr, e gap_start, nxt gap_end from g where nxt is not null",
    "p2_sweep": _SWEEP + " select lib, complex, chr, 'period' kind, s start_pos, e end_pos from g union all select lib, complex, chr, 'gap', e, nxt from g where nxt is not null",
}
