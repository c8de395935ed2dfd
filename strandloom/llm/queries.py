"""Queries p3 to p8 and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.llm.frequent import frequent
from strandloom.llm.leaks import leaks
from strandloom.llm.pairs import SIGNIFICANT, together
from strandloom.llm.quantiles import RANK_ERROR, build, merge, percentiles, ranks, regroup
from strandloom.llm.spam import stuffed
from strandloom.llm.tokens import PATTERN, encode
from strandloom.plans.problems import INTERVALS_SQL, intervals
from strandloom.storage import materialise, maybe_broadcast, spread, table

#: A frequent value stands in one of so many rows.
ONE_IN = 400
#: A pair stands in one of so many records.
PAIR_ONE_IN, PAIR_LIFT = 100, 3
#: Folder of the public tokenizers.
TOKENIZERS = "/opt/tokenizers"


def p3_top(spark: SparkSession, d: str) -> DataFrame:
    """Frequent values as written, with exact counts and the bounds of the first pass."""
    found = frequent(table(spark, d, "cluster_frags"), {"cell": "cell", "complex": "complex"}, ONE_IN)
    return found.select(F.col("kind").alias("key_kind"), F.col("value").alias("key_value"), "n", "low", "high")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_top(spark, d).select("key_kind", "key_value")


def measured(spark: SparkSession, d: str) -> DataFrame:
    """(lib, run_day, n_umi) with each measured cell of a library once."""
    cells = table(spark, d, "umi_counts").filter("n_umi >= 0 and lib is not null and cell is not null")
    return cells.groupBy("lib", "cell").agg(F.min(F.struct("loaded_at", "run_day", "n_umi")).alias("first")).select("lib", "first.run_day", "first.n_umi")


def reported(spark: SparkSession, d: str) -> DataFrame:
    """(lib, reported): the latest Median_UMI_per_cell that is a number."""
    name = F.regexp_replace(F.lower("metric"), "[^a-z0-9]", "")
    rows = table(spark, d, "qc_report").filter((name == "medianumipercell") & F.col("lib").isNotNull())
    latest = rows.groupBy("lib").agg(F.max_by("value", F.struct("reported_at", "value")).alias("value"))
    digits = F.regexp_replace("value", r"(?U)[,\s]", "")
    number = F.when(digits.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), digits.try_cast("double"))
    return latest.select("lib", number.alias("reported")).filter("reported is not null")


def medians(values: DataFrame, key: str, value: str, brackets: DataFrame) -> DataFrame:
    """(key, n, median) exactly, given a bracket (key, low, high) that is likely to hold the median.

    Values outside the bracket are only counted; inside it, equal values are counted together. Where
    a bracket proves not to hold the median it is replaced by the whole range.
    """
    rows = values.select(key, F.col(value).alias("v")).join(maybe_broadcast(brackets), key)
    stats = materialise(rows.groupBy(key).agg(F.count("v").alias("n"), F.count_if(F.expr("v < low")).alias("below"), F.count_if(F.expr("v <= high")).alias("upto"), F.min("v").alias("least"), F.max("v").alias("most")), "medians")
    missed = stats.filter("below > (n - 1) div 2 or upto <= n div 2")
    inside = rows.filter("v between low and high").groupBy(key, "v").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(key).orderBy("v")
    at = inside.withColumn("upto_v", F.sum("c").over(w)).join(stats.join(missed.select(key), key, "left_anti"), key)
    holds = lambda rank: F.expr(f"below + upto_v > {rank} and below + upto_v - c <= {rank}")
    both = F.when(holds("(n - 1) div 2"), F.col("v")).otherwise(0) + F.when(holds("n div 2"), F.col("v")).otherwise(0)
    out = at.groupBy(key, "n").agg((F.sum(both) / 2.0).alias("median"))
    if missed.limit(1).count():
        wide = materialise(missed.select(key, F.col("least").alias("low"), F.col("most").alias("high")), "brackets")
        out = out.unionByName(medians(values, key, value, wide))
    return out


def p4_medians(spark: SparkSession, d: str) -> DataFrame:
    """Reported and true median of each library. Sketches of days merge to a library; their brackets are checked exactly."""
    cells = materialise(measured(spark, d), "measured")
    days = merge(build(cells, ["lib", "run_day"], "n_umi"), cells.rdd.getNumPartitions())
    libs = merge(regroup(days, "lib string, run_day date", ["lib"]), 1)
    near = ranks(libs, [0.5 - RANK_ERROR, 0.5 + RANK_ERROR])
    brackets = materialise(near.groupBy(F.from_json("g", "lib string")["lib"].alias("lib")).agg(F.min("low").alias("low"), (F.max("high") + 1).alias("high")), "brackets")
    return medians(cells, "lib", "n_umi", brackets).join(reported(spark, d), "lib").select("lib", "n", "median", "reported")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Libraries whose report is off by more than a tenth of the median."""
    return p4_medians(spark, d).filter("abs(reported - median) * 10 > median").select("lib")


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of n_umi per library and of both positions per chromosome, from the sketches alone."""
    shares = [0.05, 0.25, 0.5, 0.75, 0.95]
    cells = measured(spark, d).select(F.lit("n_umi").alias("measure"), F.col("lib").alias("group"), F.col("n_umi").alias("v"))
    frags = intervals(spark, d).filter("chr is not null")
    ends = frags.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col("chr").alias("group"), F.col(c).alias("v")) for c in ("start_pos", "end_pos")])).alias("e")).select("e.*")
    return percentiles(cells.unionByName(ends), ["measure", "group"], "v", shares)


def places(spark: SparkSession, d: str) -> DataFrame:
    """(lib, complex, place) of every interval on a chromosome."""
    low = F.least("start_pos", "end_pos")
    rows = intervals(spark, d).filter("chr is not null and complex is not null and start_pos is not null and end_pos is not null")
    return rows.select("lib", "complex", F.concat("chr", F.lit(":"), F.expr("(least(start_pos, end_pos) - pmod(least(start_pos, end_pos), 1000000)) div 1000000").cast("string")).alias("place"))


def p5_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of places in at least 1% of the records that meet more or less often than by chance (at 0.1%)."""
    found = together(places(spark, d), ["lib", "complex"], "place", PAIR_ONE_IN, SIGNIFICANT)
    return found.select("item_a", "item_b", "n_ab", "n_a", "n_b", "n", F.round("lift", 6).alias("lift"), F.round("llr", 3).alias("llr"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that meet at least three times as often as by chance."""
    return together(places(spark, d), ["lib", "complex"], "place", PAIR_ONE_IN).filter(F.col("n_ab") * F.col("n") >= PAIR_LIFT * F.col("n_a") * F.col("n_b")).select("item_a", "item_b")


def tokenizer(folder: str = TOKENIZERS) -> tuple[str, str]:
    """Rank file and split pattern of byte_bpe_50k."""
    return os.path.join(folder, "byte_bpe_50k.tiktoken"), PATTERN


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    path, pattern = tokenizer()
    return encode(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text", path, pattern)


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Documents with passages, and how much of them."""
    return leaks(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", table(spark, d, "eval_items"), "item_id")


def p7_parts(spark: SparkSession, d: str) -> DataFrame:
    """How many parts of twelve words a document and a passage have in common."""
    return p7_leaks(spark, d).filter("same > 0").select("doc_id", "item_id", "same")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with twelve consecutive words in common."""
    return p7_leaks(spark, d).filter("same > 0").select("doc_id", "item_id").distinct()


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    """Features, distance and deviation along the spam directions of every document."""
    return stuffed(spread(table(spark, d, "documents").select("doc_id", "text", "lang")), "doc_id", table(spark, d, "page_labels"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Keyword-stuffed pages, tag clouds and link lists."""
    return p8_scores(spark, d).filter("spam").select("doc_id")


QUERIES = {f.__name__: f for f in (p3_found, p3_top, p4_found, p4_medians, p4_percentiles, p5_found, p5_pairs, p6_ids, p7_found, p7_parts, p7_leaks, p8_found, p8_scores)}

_P3 = "k as (select 'cell' key_kind, cell key_value from cluster_frags union all select 'complex', complex from cluster_frags), f as (select key_kind, key_value, count(*) n from k where key_value is not null group by all having count(*) * 400 >= (select count(*) from cluster_frags))"
_P4 = (
    "with u as (select lib, cell, min(n_umi) v from umi_counts where n_umi >= 0 group by all), m as (select lib, count(*) n, median(v) median from u group by lib),"
    " q as (select lib, arg_max(coalesce(value, ''), reported_at::varchar || coalesce(value, '')) v from qc_report where regexp_replace(lower(metric), '[^a-z0-9]', '', 'g') = 'medianumipercell' group by lib),"
    " r as (select lib, try_cast(regexp_replace(v, '[,\\s]', '', 'g') as double) reported from q)"
)
_P5 = (
    "with " + INTERVALS_SQL + ", i as (select distinct lib, complex, chr || ':' || (lo // 1000000) p from f where complex is not null),"
    " t as (select count(*) n from (select distinct lib, complex from i)), s as (select p, count(*) k from i group by p),"
    " b as (select i.* from i join s using (p) where k * 100 >= (select n from t)),"
    " ab as (select x.p item_a, y.p item_b, count(*) n_ab from b x join b y on x.lib = y.lib and x.complex = y.complex and x.p < y.p group by all),"
    " r as (select item_a, item_b, n_ab, sa.k n_a, sb.k n_b, n from ab join s sa on sa.p = item_a join s sb on sb.p = item_b cross join t where n_ab * 100 >= n)"
)

_XLX = lambda x: f"(case when {x} > 0 then ({x}) * ln(cast({x} as double)) else 0 end)"
_LLR = "greatest(0, 2 * (" + " + ".join(_XLX(x) for x in ("n_ab", "n_a - n_ab", "n_b - n_ab", "n - n_a - n_b + n_ab")) + " - " + " - ".join(_XLX(x) for x in ("n_a", "n - n_a", "n_b", "n - n_b")) + " + " + _XLX("n") + "))"


def _words_sql(source: str, key: str) -> str:
    clean = "regexp_replace(regexp_replace(nfc_normalize(text), '-\\r?\\n', '', 'g'), '\\([^()\\[\\]]*\\)|\\[[^()\\[\\]]*\\]', ' ', 'g')"
    words = f"regexp_extract_all(lower({clean}), '[\\p{{L}}\\p{{N}}]+')"
    return f"(select {key}, unnest(range(1, len(w) - 10)) i, w from (select {key}, {words} w from {source} where text is not null))"


_P7 = "with d as (select doc_id, array_to_string(w[i:i+11], ' ') s from " + _words_sql("documents", "doc_id") + "), e as (select item_id, array_to_string(w[i:i+11], ' ') s from " + _words_sql("eval_items", "item_id") + ") "

SQL = {
    "p3_found": "with " + _P3 + " select key_kind, key_value from f",
    "p4_found": _P4 + " select lib from m join r using (lib) where abs(reported - median) * 10 > median",
    "p4_medians": _P4 + " select lib, n, median, reported from m join r using (lib) where reported is not null",
    "p5_found": _P5 + " select item_a, item_b from r where n_ab * n >= 3 * n_a * n_b",
    "p5_pairs": _P5 + f", g as (select *, {_LLR} g from r) select item_a, item_b, n_ab, n_a, n_b, n, round(n_ab * n / (n_a * n_b), 6) lift, round(g, 3) llr from g where g >= {SIGNIFICANT}",
    "p7_found": _P7 + "select distinct doc_id, item_id from d join e using (s)",
    "p7_parts": _P7 + "select doc_id, item_id, count(*) same from d join e using (s) group by all",
}
