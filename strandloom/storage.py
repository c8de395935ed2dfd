"""Tables by path, size-checked broadcasts and intermediate tables in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a side may be broadcast after it was measured.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name` of a data folder; one file or a folder of part files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """`df` over all cores, where its scan has fewer partitions than there are cores.

    A small file with a single row group is read by one task; what follows need not be. Inputs with
    enough partitions, which is every large one, are left as they are. Rows go by a hash of the
    columns `by`, else of the whole row: unlike a round robin that needs no sort to be repeatable,
    and a grouping by keys that contain `by` needs no second shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    hashed = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and t != "variant"]
    return df.repartition(cores, *(by or ([F.xxhash64(*hashed)] if hashed else [])))


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session.

    Where it is unset, a local session (as in tests) gets a folder of its own; on a cluster that is
    an error, as every executor would write to its own disk.
    """
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.strandloom.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="strandloom-")
        spark.conf.set("spark.strandloom.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet below the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of an executor, and is far smaller than the
    row objects of checkpoint(). The files live until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _bytes_of(df: DataFrame) -> Column:
    """Bytes of a row in memory, roughly; of nested columns their text."""
    text = [F.coalesce(F.octet_length(F.col(f"`{c}`") if t in ("string", "binary") else F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary") or "<" in t]
    return sum(text, F.lit(16 * len(df.columns)).cast("bigint"))


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with a broadcast hint if it has at most `max_rows` rows and `max_bytes` bytes, else `df` itself.

    Measuring stops at max_rows + 1. Beyond the bounds Spark joins by shuffle, and AQE splits skewed
    partitions. Give it only cheap frames (scans, small aggregates) or materialised ones: they are
    evaluated once more to be measured.
    """
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(_bytes_of(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
