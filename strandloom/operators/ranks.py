"""Positions of rows in the order of their group, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Width of a block of order values; a window sees one block of a group at a time.
BLOCK = 1 << 20


def numbered(df: DataFrame, keys: list[str], order: str, block: int = BLOCK) -> DataFrame:
    """`df` with `i` (0-based position by the bigint column `order`) and `n` (rows of the group).

    Ties are broken by all columns, so that rows which tie altogether are interchangeable. Rows of a
    group are numbered inside blocks of order values, to which the sizes of the blocks before are
    added. Null keys form a group; a null order comes first. An empty table stays empty.
    """
    rows = df.withColumn("_block", F.coalesce(F.expr(f"(`{order}` - pmod(`{order}`, {block}L)) div {block}L"), F.lit(-(1 << 60))))
    safe = {k: f"_k{j}" for j, k in enumerate(keys)}
    sizes = rows.groupBy(*[F.struct(F.col(k)).alias(v) for k, v in safe.items()], "_block").agg(F.count(F.lit(1)).alias("_size"))
    upto = Window.partitionBy(*safe.values()).orderBy("_block")
    sizes = sizes.withColumn("_before", F.sum("_size").over(upto) - F.col("_size")).withColumn("n", F.sum("_size").over(Window.partitionBy(*safe.values()))).drop("_size")
    inside = Window.partitionBy(*safe.values(), "_block").orderBy(order, *[c for c in df.columns if c != order])
    placed = rows.select("*", *[F.struct(F.col(k)).alias(v) for k, v in safe.items()]).withColumn("_row", F.row_number().over(inside))
    joined = placed.join(sizes, [*safe.values(), "_block"])
    return joined.select(*df.columns, (F.col("_before") + F.col("_row") - 1).alias("i"), "n")


def following(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Each row of a group with the next one: `df` with i, n and `next_` of `columns`.

    A join on (keys, i), which spreads a large group over all tasks. The last row of a group drops out.
    """
    rows = numbered(df, keys, order)
    ahead = rows.select(*keys, (F.col("i") - 1).alias("i"), *[F.col(c).alias(f"next_{c}") for c in columns])
    return rows.join(ahead, [*keys, "i"])
