"""Alignments: flags, CIGAR strings, mates and the fragment that two mates make.

Columns: qname, flag, rname, pos (0-based), mapq, cigar; `rname` is * for an unmapped mate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIRED, FIRST, LAST, NOT_PRIMARY = 0x1, 0x40, 0x80, 2304


def reference_length(cigar: Column) -> Column:
    """Bases of the reference that a CIGAR string covers; 0 for * and the empty string."""
    lengths = F.regexp_extract_all(cigar, F.lit("([0-9]+)[MDN=X]"), F.lit(1))
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))


def usable(df: DataFrame, min_mapq: int = 30, unique: int | None = None) -> DataFrame:
    """Primary alignments with at least `min_mapq`, or with exactly `unique` where that is given."""
    good = F.col("mapq") == unique if unique is not None else F.col("mapq") >= min_mapq
    return df.filter((F.col("flag").bitwiseAND(NOT_PRIMARY) == 0) & good)


def one_mate(df: DataFrame, which: int) -> DataFrame:
    """Alignments of mate 1 or mate 2 alone; those of unpaired reads stay."""
    return df.filter((F.col("flag").bitwiseAND(PAIRED) == 0) | (F.col("flag").bitwiseAND(FIRST if which == 1 else LAST) != 0))


def mates(df: DataFrame, strict: bool = False) -> DataFrame:
    """One row per read name: qname and the structs m1, m2 (rname, start, end) of its mates.

    A mate that is unmapped or absent is null. strict: reads whose paired flag is set but that lack
    a mate are dropped. Of several alignments of a mate the smallest by (rname, pos, cigar) counts.
    """
    start = F.col("pos")
    place = F.struct("rname", start.alias("start"), (start + reference_length(F.col("cigar"))).alias("end"))
    mapped = F.col("rname").isNotNull() & (F.col("rname") != "*")
    second = F.col("flag").bitwiseAND(LAST) != 0
    side = lambda cond: F.min(F.when(cond & mapped, place))
    out = df.groupBy("qname").agg(side(~second).alias("m1"), side(second).alias("m2"), F.max(F.col("flag").bitwiseAND(PAIRED)).alias("paired"), F.count_if(~second).alias("_a"), F.count_if(second).alias("_b"))
    if strict:
        out = out.filter("paired = 0 or (_a > 0 and _b > 0)")
    return out.select("qname", "m1", "m2")


def fragment(mated: DataFrame) -> DataFrame:
    """qname, chr, start_pos, end_pos: the place of a read from its mates.

    One mapped mate: its place. Both on one chromosome: from the smaller start to the larger end. On
    two chromosomes: the mate that covers more, the first on a tie. None mapped: no row.
    """
    m1, m2 = F.col("m1"), F.col("m2")
    same = m1["rname"] == m2["rname"]
    first_longer = (m1["end"] - m1["start"]) >= (m2["end"] - m2["start"])
    spanning = F.struct(m1["rname"].alias("rname"), F.least(m1["start"], m2["start"]).alias("start"), F.greatest(m1["end"], m2["end"]).alias("end"))
    place = F.when(m2.isNull(), m1).when(m1.isNull(), m2).when(same, spanning).when(first_longer, m1).otherwise(m2)
    return mated.withColumn("_p", place).filter("_p is not null").select("qname", F.col("_p.rname").alias("chr"), F.col("_p.start").alias("start_pos"), F.col("_p.end").alias("end_pos"))


def tn5_shift(df: DataFrame) -> DataFrame:
    """Start + 4 and end - 5, as the transposase cuts."""
    return df.withColumn("start_pos", F.col("start_pos") + 4).withColumn("end_pos", F.col("end_pos") - 5)


def split_name(name: Column) -> Column:
    """Struct (read, barcodes array<struct<type,value>>, ids map<string,string>) of read|||T:V|T:V|||CELL_1|COMPLEX_2."""
    parts = F.split(name, r"\|\|\|")
    pairs = F.filter(F.split(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\|"), lambda x: x != "")
    codes = F.transform(pairs, lambda x: F.struct(F.substring_index(x, ":", 1).alias("type"), F.regexp_replace(x, "^[^:]*:", "").alias("value")))
    labels = F.filter(F.split(F.coalesce(F.get(parts, F.lit(2)), F.lit("")), r"\|"), lambda x: x != "")
    ids = F.map_from_entries(F.transform(labels, lambda x: F.struct(F.substring_index(x, "_", 1).alias("key"), F.regexp_replace(x, "^[^_]*_", "").alias("value"))))
    return F.struct(parts[0].alias("read"), codes.alias("barcodes"), ids.alias("ids"))


def annotate_name(name: Column, barcodes: Column, ids: Column) -> Column:
    """The reverse of split_name; what follows a / or blank in the read name is cut."""
    read = F.regexp_replace(name, "[/ ].*$", "")
    codes = F.array_join(F.transform(barcodes, lambda b: F.concat(b["type"], F.lit(":"), b["value"])), "|")
    labels = F.array_join(F.transform(F.map_entries(ids), lambda e: F.concat(e["key"], F.lit("_"), e["value"])), "|")
    return F.concat_ws("|||", read, codes, labels)


def choose(barcodes: Column, spec: str) -> Column:
    """Value of a barcode by position ('3'), by type ('UMI') or by both ('3:UMI'); null if it isn't there."""
    place, _, kind = spec.partition(":")
    if place.isdigit():
        found = F.get(barcodes, F.lit(int(place) - 1))
        return F.when(F.lit(not kind) | (found["type"] == kind), found["value"]) if kind else found["value"]
    return F.get(F.filter(barcodes, lambda b: b["type"] == place), F.lit(0))["value"]


def extra_tags(barcodes: Column, text: str) -> dict[str, Column]:
    """Two-letter tag -> value of each barcode that a text such as '3:UMI:UM-DPM:DP' names, for the SAM sink."""
    from strandloom.sources.config import field_spec

    return {tag: choose(barcodes, spec) for spec, tag in field_spec(text)}
