"""One form for identifiers and chromosomes that are written in several ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_number(value: Column, prefix: str) -> Column:
    """The number n of `prefix`_n as bigint.

    Case, outer blanks, leading zeros and a missing prefix make no difference. Null, blank, `-`,
    `NOT_FOUND`, anything else without that form, and numbers beyond bigint give null.
    """
    digits = F.regexp_extract(value, rf"(?iU)^\s*(?:{prefix}_)?0*([0-9]+)\s*$", 1)
    return digits.try_cast("bigint")


def chromosome_key(value: Column) -> Column:
    """Chromosome without outer blanks, case and the leading `chr`; blank gives null."""
    key = F.regexp_replace(F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", "")), "^chr", "")
    return F.when(F.length(key) > 0, key)


def with_chromosome(df: DataFrame, column: str, chrom_sizes: DataFrame) -> DataFrame:
    """`df` with `column` in the spelling of `chrom_sizes`; null where it is no chromosome there.

    The size table is a reference table: one row per chromosome. It is broadcast after its size was
    checked; a larger one is joined by shuffle.
    """
    from strandloom.storage import maybe_broadcast

    names = (
        chrom_sizes.select(F.col("chr").alias("_chr"), chromosome_key(F.col("chr")).alias("_chr_key"))
        .filter("_chr_key is not null")
        .groupBy("_chr_key")
        .agg(F.min("_chr").alias("_chr"))
    )
    keyed = df.withColumn("_chr_key", chromosome_key(F.col(column)))
    return keyed.join(maybe_broadcast(names), "_chr_key", "left").withColumn(column, F.col("_chr")).drop("_chr", "_chr_key")
