"""Text formats of the stages: clusters, identifier tables, whitelists, BED, matrices, sizes, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_clusters(spark: SparkSession, path: str, parents: list[str], extras: int = 0) -> DataFrame:
    """Ragged cluster lines in the long form: parents..., idx, i, chr, start_pos, end_pos, extra_0...

    A line holds the parents, the number n of fragments, n times chr, start, end, and then `extras`
    blocks of n values. Lines with # or @ in front are headers. idx is the place of the fragment in
    the input: line number by partition order, then i.
    """
    line = spark.read.text(path).filter(~F.col("value").rlike("^[#@]") & (F.col("value") != "")).select(F.monotonically_increasing_id().alias("_line"), F.split("value", "\t").alias("v"))
    k = len(parents)
    rows = line.withColumn("n", F.col("v")[k].cast("int")).filter("n > 0")
    at = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    cell = lambda offset: F.element_at("v", (offset + 1).cast("int"))
    base = F.lit(k + 1) + F.col("i") * 3
    values = [cell(F.lit(k + 1) + F.col("n") * (3 + j) + F.col("i")).alias(f"extra_{j}") for j in range(extras)]
    names = [F.col("v")[j].alias(p) for j, p in enumerate(parents)]
    return at.select(*names, F.struct("_line", "i").alias("idx"), "i", cell(base).alias("chr"), cell(base + 1).cast("bigint").alias("start_pos"), cell(base + 2).cast("bigint").alias("end_pos"), *values)


def cluster_header(spark: SparkSession, path: str) -> list[str] | None:
    """Column names of the @CN line, or None. One line, looked up on the driver."""
    found = spark.read.text(path).filter(F.col("value").startswith("@CN")).limit(1).collect()
    return found[0][0].split("\t")[1:] if found else None


def sink_clusters(df: DataFrame, keys: list[str], path: str, order: str = "idx") -> None:
    """Write fragments as cluster lines, in as many files as partitions; very large groups take several lines."""
    from strandloom.operators.cluster import inline_text

    inline_text(df, keys, order).select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def scan_idb(spark: SparkSession, path: str) -> DataFrame:
    """idb_key, id, n, names."""
    return spark.read.schema("idb_key string, id bigint, n bigint, names string").option("sep", "\t").csv(path)


def sink_idb(df: DataFrame, path: str) -> None:
    df.select("idb_key", "id", "n", "names").write.mode("overwrite").option("sep", "\t").csv(path)


def scan_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """ord, name, seq of a list with one column (seq) or two (name, seq), plain or gz; name is seq where absent.

    ord counts the lines of one file from 0; a whitelist is one file, which fits a task.
    """
    parts = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).filter(F.trim("value") != "").coalesce(1).select(F.monotonically_increasing_id().alias("ord"), parts.alias("p"))
    return lines.select("ord", F.col("p")[0].alias("name"), F.element_at("p", -1).alias("seq"))


def scan_bed(spark: SparkSession, path: str) -> DataFrame:
    """chr, start_pos, end_pos and, where there, name and dup."""
    return spark.read.schema("chr string, start_pos bigint, end_pos bigint, name string, dup bigint").option("sep", "\t").csv(path)


def sink_bed(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Sorted by (chr, start_pos) over all files, by ranges."""
    chosen = df.select(*(columns or df.columns))
    chosen.orderBy("chr", "start_pos").write.mode("overwrite").option("sep", "\t").csv(path)


def scan_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chr string, chr_size bigint").option("sep", "\t").csv(path)


def sink_matrix(entries: DataFrame, peaks: DataFrame, cells: DataFrame, path: str) -> None:
    """Folders peaks, cells and matrix: the last in MatrixMarket coordinates, with its header in the file that sorts first."""
    peaks.orderBy("i").select("chr", "start_pos", "end_pos").write.mode("overwrite").option("sep", "\t").csv(f"{path}/peaks")
    cells.orderBy("j").select("cell").write.mode("overwrite").option("sep", "\t").csv(f"{path}/cells")
    dims = peaks.agg(F.count(F.lit(1)).alias("p")).join(cells.agg(F.count(F.lit(1)).alias("c"))).join(entries.agg(F.count(F.lit(1)).alias("n")))
    head = dims.select(F.explode(F.array(F.lit("%%MatrixMarket matrix coordinate integer general"), F.concat_ws(" ", "p", "c", "n"))).alias("value"))
    head.coalesce(1).write.mode("overwrite").text(f"{path}/matrix/part=0")
    entries.orderBy("j", "i").select(F.concat_ws(" ", "i", "j", "v").alias("value")).write.mode("overwrite").text(f"{path}/matrix/part=1")


def scan_matrix(spark: SparkSession, path: str) -> DataFrame:
    """i, j, v of the matrix folder."""
    p = F.split("value", " ")
    return spark.read.text(f"{path}/matrix/part=1").select(p[0].cast("bigint").alias("i"), p[1].cast("bigint").alias("j"), p[2].cast("bigint").alias("v"))


def sink_counts(df: DataFrame, path: str) -> None:
    """Barcode counts: ord, count, seq."""
    df.select("ord", "count", "seq").write.mode("overwrite").option("sep", "\t").csv(path)


def scan_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("ord bigint, count bigint, seq string").option("sep", "\t").csv(path)
