"""Clusters: fragments grouped by an identifier, refined, split, merged, paired and counted.

The canonical form is long: a row per fragment with its group's columns, `chr`, `start_pos`,
`end_pos` and `idx`, which stands for the order of the input. Null keys, chromosomes and positions
are for the caller to filter; where an operator does it, it says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.ranks import following, numbered
from strandloom.operators.sweep import sweep
from strandloom.storage import materialise

FRAGMENT = ["chr", "start_pos", "end_pos"]
#: Fragments of one line of text.
PER_LINE = 1_000_000
#: Positions of a bin in which fragments look for the interval they were merged into.
BIN = 1 << 20


def group(df: DataFrame, keys: list[str], order: str = "idx") -> DataFrame:
    """One row per group with its fragments in order: keys, `n`, `frags` (array of chr, start, end).

    A group's fragments must fit into one row; inline_text and to_bed take the long form and have no such bound.
    """
    fragment = F.struct(F.col(order).alias("idx"), *FRAGMENT)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.transform(F.array_sort(F.collect_list(fragment)), lambda x: F.struct(x["chr"].alias("chr"), x["start_pos"].alias("start_pos"), x["end_pos"].alias("end_pos"))).alias("frags"))


def inline_text(df: DataFrame, keys: list[str], order: str = "idx", per_line: int = PER_LINE) -> DataFrame:
    """The flat text line of each group: keys, `part`, `line` with keys, count, then chr, start, end of each fragment.

    Groups of more than `per_line` fragments make several lines, numbered by `part` from 0, each with
    the keys and its own count, so that no line holds more than that.
    """
    rows = numbered(df.select(*keys, *FRAGMENT, order), keys, order).withColumn("part", F.expr(f"i div {per_line}L"))
    text = F.concat_ws("\t", "chr", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"))
    lines = rows.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("_n"), F.array_sort(F.collect_list(F.struct("i", text.alias("t")))).alias("_f"))
    return lines.select(*keys, "part", F.concat_ws("\t", *[F.col(k).cast("string") for k in keys], F.col("_n").cast("string"), F.concat_ws("\t", F.col("_f")["t"])).alias("line"))


def hierarchy(df: DataFrame, parent: str, child: str, order: str = "idx") -> DataFrame:
    """Each child with the parent of its first fragment, and its number of fragments."""
    return df.groupBy(child).agg(F.min_by(parent, order).alias(parent), F.count(F.lit(1)).alias("n"))


def dedup(df: DataFrame, keys: list[str], by: list[str], order: str = "idx") -> DataFrame:
    """First fragment of each (keys, by), with `dup`, the number of fragments it stands for.

    `by` is (chr, start_pos) or (chr, start_pos, end_pos). The survivor is the one of the smallest
    `order`; where that ties, the smallest by the other columns. Sums are made map-side first.
    """
    rest = [c for c in df.columns if c not in (*keys, *by, order)]
    first = F.min(F.struct(order, *rest)).alias("_first")
    return df.groupBy(*keys, *by).agg(first, F.count(F.lit(1)).alias("dup")).select(*keys, *by, f"_first.{order}", *[f"_first.{c}" for c in rest], "dup")


def duplicate_stats(deduped: DataFrame) -> DataFrame:
    """Fragments before, duplicates among them."""
    total = F.coalesce(F.sum("dup"), F.lit(0).cast("bigint"))
    return deduped.agg((total - F.count(F.lit(1))).alias("duplicates"), total.alias("total_fragments"))


def split_by_chromosome(df: DataFrame, key: str, order: str = "idx") -> DataFrame:
    """`df` with `sub_id` = key-k, k counting the chromosomes of a group from 0, by first appearance in `order`.

    The window is over one row per group and chromosome, never over the fragments.
    """
    firsts = df.groupBy(key, "chr").agg(F.min(order).alias("_first"))
    w = Window.partitionBy(key).orderBy("_first", "chr")
    named = firsts.select(key, "chr", F.concat_ws("-", F.col(key).cast("string"), (F.row_number().over(w) - 1).cast("string")).alias("sub_id"))
    return df.join(named, [key, "chr"])


def merge(df: DataFrame, keys: list[str], distance: int = 0, extend: int = 0, min_length: int = 0) -> DataFrame:
    """Intervals of a group merged per chromosome: keys, chr, start_pos, end_pos.

    Fragments shorter than `min_length` go first; then each end grows by `extend`; then neighbours
    with end + distance >= next start become one. Ends are taken as covered, so intervals of length
    0 count. Done by the sweep, with the closed ends as half positions.
    """
    rows = df.filter(F.col("end_pos") - F.col("start_pos") >= min_length).select(
        *keys, "chr", (F.col("start_pos") * 2).alias("start_pos"), ((F.col("end_pos") + extend + distance) * 2 + 1).alias("end_pos")
    )
    swept = sweep(rows, [*keys, "chr"], "start_pos", "end_pos").filter("kind = 'period'")
    return swept.select(*keys, "chr", F.expr("start_pos div 2").alias("start_pos"), (F.expr("(end_pos - 1) div 2") - distance).alias("end_pos"))


def merge_with(df: DataFrame, keys: list[str], extra: str, distance: int = 0, extend: int = 0, min_length: int = 0, delimiter: str = ";") -> DataFrame:
    """As merge, with the values of `extra` in order of start, joined by `delimiter`.

    Fragments are joined to the interval that their start lies in, by an equi-join on bins of
    positions, so a large group is spread over its bins. The values of one merged interval must fit
    into one row. Null keys and positions are left out, as in merge.
    """
    own = [*keys, "chr"]
    written = materialise(df.select(*own, "start_pos", "end_pos", F.col(extra).alias("_x")), "fragments")
    merged = merge(written, keys, distance, extend, min_length).select(*own, F.col("start_pos").alias("_s"), F.col("end_pos").alias("_e"))
    merged = merged.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_s") / BIN), F.floor(F.col("_e") / BIN))))
    rows = written.filter(F.col("end_pos") - F.col("start_pos") >= min_length).withColumn("_bin", F.floor(F.col("start_pos") / BIN))
    inside = rows.join(merged, [*own, "_bin"]).filter("start_pos between _s and _e")
    value = F.struct("start_pos", "end_pos", "_x")
    return inside.groupBy(*own, "_s").agg(F.max("_e").alias("_e"), F.array_join(F.array_sort(F.collect_list(value))["_x"].cast("array<string>"), delimiter).alias(extra)).select(*own, F.col("_s").alias("start_pos"), F.col("_e").alias("end_pos"), extra)


def to_bed(df: DataFrame, keys: list[str], order: str = "idx") -> DataFrame:
    """A row per fragment: chr, start_pos, end_pos, `name` (keys joined by |), `i` (its place in the group)."""
    name = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return numbered(df.select(*keys, *FRAGMENT, order), keys, order).select(*FRAGMENT, name.alias("name"), "i")


def lengths(df: DataFrame, key: str, order: str = "idx") -> DataFrame:
    """chr, start_pos, end_pos, `name` (key-count-i) and `len` of each fragment."""
    rows = numbered(df.select(key, *FRAGMENT, order), [key], order)
    name = F.concat_ws("-", F.col(key).cast("string"), F.col("n").cast("string"), F.col("i").cast("string"))
    return rows.select(*FRAGMENT, name.alias("name"), (F.col("end_pos") - F.col("start_pos")).alias("len"))


def next_distances(df: DataFrame, key: str, order: str = "idx") -> DataFrame:
    """Distance from each fragment's end to the start of the next one in its group."""
    rows = following(df.select(key, *FRAGMENT, order), [key], order, FRAGMENT)
    return rows.select(key, "i", "chr", "start_pos", "end_pos", "next_chr", "next_start_pos", "next_end_pos", (F.col("next_start_pos") - F.col("end_pos")).alias("dist"))


def _tiles(column: Column, width: int) -> Column:
    return F.floor(column / width)


def pairs_within(df: DataFrame, keys: list[str], reach: int, order: str = "idx") -> DataFrame:
    """Pairs of fragments of one group and chromosome whose starts lie up to `reach` apart.

    i comes before j by (start_pos, idx). The join is an equi-join on tiles of `reach` bases, so a
    large group is spread over its tiles and no pair beyond its neighbours is looked at.
    """
    left = df.select(*keys, *FRAGMENT, order, _tiles(F.col("start_pos"), reach).alias("_tile"))
    right = df.select(*keys, "chr", F.col("start_pos").alias("start_2"), F.col("end_pos").alias("end_2"), F.col(order).alias("_order_2"), F.explode(F.array(_tiles(F.col("start_pos"), reach), _tiles(F.col("start_pos"), reach) - 1)).alias("_tile"))
    near = left.join(right, [*keys, "chr", "_tile"]).filter(
        (F.col("start_2") - F.col("start_pos") <= reach) & ((F.col("start_2") > F.col("start_pos")) | ((F.col("start_2") == F.col("start_pos")) & (F.col("_order_2") > F.col(order))))
    )
    return near.select(*keys, "chr", F.col("start_pos").alias("start_1"), F.col("end_pos").alias("end_1"), "start_2", "end_2", (F.col("start_2") - F.col("end_pos")).alias("dist"))


def juice(pairs: DataFrame) -> DataFrame:
    """Contact rows: name of the chromosome without c, h, r at its ends, and both midpoints."""
    name = F.expr("trim(both 'chr' from chr)")
    mid = lambda a, b: F.expr(f"({a} + {b}) div 2")
    return pairs.select(name.alias("chr_1"), mid("start_1", "end_1").alias("mid_1"), name.alias("chr_2"), mid("start_2", "end_2").alias("mid_2"))


def spans(df: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest to largest coordinate of each group, and its number of fragments."""
    return df.groupBy(*keys).agg((F.max(F.greatest("start_pos", "end_pos")) - F.min(F.least("start_pos", "end_pos"))).alias("span"), F.count(F.lit(1)).alias("n"))


def count_histogram(df: DataFrame, key: str, top: int = 15) -> DataFrame:
    """Groups by number of fragments: F = 1 .. F = top, F > top; empty classes have 0."""
    spark = df.sparkSession
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("k")).groupBy(F.least("k", F.lit(top + 1)).alias("k")).agg(F.count(F.lit(1)).alias("groups"))
    label = F.when(F.col("k") > top, F.lit(f"F > {top}")).otherwise(F.concat(F.lit("F = "), F.col("k").cast("string")))
    return spark.range(1, top + 2).withColumnRenamed("id", "k").join(sizes, "k", "left").select(label.alias("class"), F.coalesce("groups", F.lit(0)).cast("bigint").alias("groups"))


def labelled_union(parts: dict[str, DataFrame], label: str = "type") -> DataFrame:
    """All parts one after the other, each row with the name of its part."""
    out = None
    for name, part in parts.items():
        part = part.withColumn(label, F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def without_names(df: DataFrame, column: str, patterns: tuple[str, ...] = ("Het", "chrU", "chrM")) -> DataFrame:
    """Rows whose `column` holds none of the patterns; null stays out, as it matches nothing known."""
    return df.filter(~F.col(column).rlike("|".join(patterns)))
