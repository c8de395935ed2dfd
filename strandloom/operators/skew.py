"""Per-key results where a few keys hold most rows.

Heavy keys are found by Spark's frequent-items sketch (one pass, a fixed number of counters, no
heavy key is missed). Their rows are picked by a broadcast join and worked on without ever being
gathered by key; the other rows take the ordinary shuffle by key; the two results are united. Which
keys the sketch names changes the speed only, never the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.storage import maybe_broadcast

#: Bounds of the share of rows from which a key is heavy; the sketch has 1 / share counters.
LEAST, MOST = 1e-4, 1e-2


def heavy_share(spark: SparkSession) -> float:
    """A quarter of the rows that a task has on average after a shuffle, within LEAST and MOST.

    So a light key adds less than a quarter to the rows of its task, up to 2,500 partitions; beyond
    that it adds less than LEAST of all rows.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return min(MOST, max(LEAST, 1 / (4 * parts)))


def heavy_values(df: DataFrame, column: str, support: float | None = None) -> list:
    """Every non-null value of `column` in at least `support` of the rows, and perhaps lighter ones.

    At most 1 / support values (heavy_share by default), so that the list may go to the driver. Empty
    for an empty table.
    """
    support = support or heavy_share(df.sparkSession)
    row = df.select(column).filter(F.col(column).isNotNull()).freqItems([column], support).first()
    return sorted(v for v in (row[0] if row and row[0] else []) if v is not None)


def split_heavy(df: DataFrame, key: str, support: float | None = None, values: list | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of heavy keys, other rows), by broadcast semi and anti joins. Null keys are light."""
    values = heavy_values(df, key, support) if values is None else values
    heavy = df.sparkSession.createDataFrame([(v,) for v in values], f"`{key}` {df.schema[key].dataType.simpleString()}")
    return df.join(F.broadcast(heavy), key, "left_semi"), df.join(F.broadcast(heavy), key, "left_anti")


def distinct_counts(df: DataFrame, key: str, item: str, support: float | None = None, name: str = "n") -> DataFrame:
    """Number of distinct `item` of each `key`: columns `key`, `name` (bigint).

    Null keys give no row; null items don't count, and a key with null items only gives no row.
    Repeated rows count once. Other columns are ignored. An empty table gives an empty result.

    Heavy keys: duplicates go in a shuffle on (key, item), which spreads a key over all tasks, and
    what is left is counted map-side. Light keys: one shuffle on the key serves both steps.
    """
    rows = df.select(key, item).filter(F.col(key).isNotNull() & F.col(item).isNotNull())
    heavy, light = split_heavy(rows, key, support)
    spread = heavy.distinct()
    gathered = light.repartition(key).distinct()
    count = F.count(F.lit(1)).alias(name)
    return spread.groupBy(key).agg(count).unionByName(gathered.groupBy(key).agg(count))


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", support: float | None = None, max_rows: int | None = None, salts: int = 64) -> DataFrame:
    """`left` joined to `right` on `key`, where a few keys may hold most rows of `left`.

    how: inner or left. The rows of `right` with heavy keys are broadcast if they are small enough
    for that (or at most `max_rows`); beyond that they are repeated once per salt and joined by
    shuffle on (key, salt). A row's salt is a hash of its columns, so that a task that runs again
    gives it the same one; equal rows share theirs.
    Null keys match nothing. Other columns of `right` that `left` has too get `_right` appended.
    Repeated rows are joined each. An empty side gives what the join of that kind gives.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    taken = set(left.columns)
    for column in right.columns:
        if column != key and column in taken:
            name = f"{column}_right"
            while name in taken or name in right.columns:
                name += "_"
            right = right.withColumnRenamed(column, name)
    values = heavy_values(left, key, support)
    heavy, light = split_heavy(left, key, values=values)
    few, rest = split_heavy(right, key, values=values)
    sized = maybe_broadcast(few) if max_rows is None else maybe_broadcast(few, max_rows)
    if sized is not few:
        hot = heavy.join(sized, key, how)
    else:
        many = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = heavy.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int"))
        hot = salted.join(many, [key, "_salt"], how).drop("_salt")
    return hot.unionByName(light.join(rest, key, how))
