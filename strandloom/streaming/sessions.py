"""Sessions of a stream: the streaming form of merging neighbours within a distance.

A fragment merge joins intervals of one group that lie up to a distance apart; on a stream, events
of one user that lie up to a gap apart make a session. State is one open session per user, bounded
by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """user_id, started, ended (last event + gap), events, value of each session.

    Works on a batch and on a stream; on a stream give `late`, the watermark on ts: later events are
    dropped and a session comes out once the watermark has passed its end. Null users or times make
    no session.
    """
    rows = events.filter("user_id is not null and ts is not null")
    if late:
        rows = rows.withWatermark("ts", late)
    grouped = rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
    return grouped.select("user_id", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "events", "value")


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The Parquet files below `path` as a stream of events."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def hourly(events: DataFrame, late: str | None = None) -> DataFrame:
    """Events and value per hour and type."""
    rows = events.withWatermark("ts", late) if late else events
    grouped = rows.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
    return grouped.select(F.col("w.start").alias("hour"), "event_type", "events", "value")
