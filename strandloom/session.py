"""Spark session for local runs; on a cluster the caller brings their own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "strandloom", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session with UTC, AQE and Arrow on. Keyword settings use "__" for "."."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STRANDLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give the Python workers of `spark` this package, once per context, wherever they were started."""
    import tempfile
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_strandloom_shipped", False):
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="strandloom-")) / "strandloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._strandloom_shipped = True
