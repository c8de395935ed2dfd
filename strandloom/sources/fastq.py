"""FASTQ as a Spark data source, and as text.

Format `fastq`: option `path` (files, separated by commas, of one lane after the other) and
`chunk_bytes`. Plain files are read in chunks of bytes by many tasks; a compressed file is one
chunk. Rows carry (lane, chunk, row); with_ordinals turns that into the ordinal of a read in its
lane, by which mates are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strandloom.sources import files

SCHEMA = "lane int, chunk int, row bigint, name string, seq string, comment string, qual string"
_BATCH = 20_000


class Chunk(InputPartition):
    def __init__(self, lane: int, chunk: int, path: str, begin: int, end: int | None):
        self.lane, self.chunk, self.path, self.begin, self.end = lane, chunk, path, begin, end


def _sync(file, begin: int) -> None:
    """Go to the first record that begins at or after `begin`.

    A record's first line begins with @ and its third with +; a quality line may begin with @ too,
    but then the second line after it is a sequence, never a +.
    """
    if begin == 0:
        return
    file.seek(begin - 1)
    file.readline()
    while True:
        at = file.tell()
        lines = [file.readline() for _ in range(3)]
        if not lines[0] or (lines[0][:1] == b"@" and lines[2][:1] == b"+"):
            file.seek(at)
            return
        file.seek(at)
        file.readline()


class FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for part in options["path"].split(",") for p in files.expand(part)]
        self.size = int(options.get("chunk_bytes", 64 << 20))

    def partitions(self) -> list[Chunk]:
        out = []
        for lane, path in enumerate(self.paths):
            if path.endswith(".gz"):
                out.append(Chunk(lane, 0, path, 0, None))
                continue
            size = files.size(path)
            out += [Chunk(lane, k, path, at, min(at + self.size, size)) for k, at in enumerate(range(0, max(size, 1), self.size))]
        return out

    def read(self, part: Chunk) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], [], []]
        row = 0

        def batch() -> pa.RecordBatch:
            nonlocal row
            n = len(columns[0])
            out = pa.RecordBatch.from_arrays(
                [pa.array([part.lane] * n, pa.int32()), pa.array([part.chunk] * n, pa.int32()), pa.array(range(row, row + n), pa.int64()), *[pa.array(c, pa.string()) for c in columns]],
                ["lane", "chunk", "row", "name", "seq", "comment", "qual"],
            )
            row += n
            for c in columns:
                c.clear()
            return out

        with files.open_binary(part.path, part.path.endswith(".gz")) as file:
            if part.end is not None:
                _sync(file, part.begin)
            while part.end is None or file.tell() < part.end:
                head, seq, plus, qual = (file.readline().decode().rstrip("\r\n") for _ in range(4))
                if not head:
                    break
                if head[0] != "@" or plus[:1] != "+" or len(seq) != len(qual):
                    raise ValueError(f"{part.path}: not a FASTQ record: {head[:80]!r}")
                name, _, comment = head[1:].partition(" ")
                for c, v in zip(columns, (name, seq, comment, qual)):
                    c.append(v)
                if len(columns[0]) >= _BATCH:
                    yield batch()
        if columns[0]:
            yield batch()


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)


def scan(spark: SparkSession, paths: list[str], chunk_bytes: int = 64 << 20) -> DataFrame:
    """lane, idx (ordinal in the lane, from 0), name, seq, comment, qual."""
    spark.dataSource.register(FastqSource)
    return with_ordinals(spark.read.format("fastq").option("path", ",".join(paths)).option("chunk_bytes", str(chunk_bytes)).load())


def with_ordinals(rows: DataFrame) -> DataFrame:
    sizes = rows.groupBy("lane", "chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("lane").orderBy("chunk")) - F.col("_n")
    return rows.join(sizes.select("lane", "chunk", before.alias("_before")), ["lane", "chunk"]).select("lane", (F.col("_before") + F.col("row")).alias("idx"), "name", "seq", "comment", "qual")


def scan_mates(spark: SparkSession, mates: list[list[str]], chunk_bytes: int = 64 << 20) -> DataFrame:
    """lane, idx and the structs r1, r2, ... of up to four mates, joined by ordinal.

    Every mate needs as many files. A read without mate raises an error when it is computed.
    """
    if len({len(m) for m in mates}) != 1 or len(mates) > 4:
        raise ValueError("one to four mates with equally many files each")
    out = None
    for k, paths in enumerate(mates, 1):
        rows = scan(spark, paths, chunk_bytes)
        own = rows.select("lane", "idx", F.struct("name", "seq", "comment", "qual").alias(f"r{k}"))
        out = own if out is None else out.join(own, ["lane", "idx"], "full_outer")
    complete = F.lit(True)
    for k in range(1, len(mates) + 1):
        complete = complete & F.col(f"r{k}").isNotNull()
    return out.withColumn("r1", F.when(complete, F.col("r1")).otherwise(F.raise_error(F.lit("a mate is missing: a file was cut short"))))


def sink(df: DataFrame, path: str, route: list[str] | None = None, compression: str = "none") -> None:
    """Write name, seq, qual as FASTQ text, in a folder per value of the `route` columns (such as type and mate)."""
    lines = F.concat(F.lit("@"), F.col("name"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual")).alias("value")
    writer = df.select(*(route or []), lines).write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*route) if route else writer).text(path)
