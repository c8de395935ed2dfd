"""SAM text and BAM files: scans to the alignment schema, and the SAM sink with added tags."""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strandloom.sources import files

SCHEMA = "qname string, flag int, rname string, pos bigint, mapq int, cigar string, rnext string, pnext bigint, tlen bigint, seq string, qual string, tags map<string,string>"
FIELDS = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
_NUMBERS = {"flag": "int", "pos": "bigint", "mapq": "int", "pnext": "bigint", "tlen": "bigint"}


def scan_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text; pos is 0-based, tags map TG to T:value."""
    parts = F.split("value", "\t")
    columns = [parts[i].cast(_NUMBERS.get(f, "string")).alias(f) for i, f in enumerate(FIELDS)]
    pair = lambda t: F.struct(F.substr(t, F.lit(1), F.lit(2)).alias("key"), F.substr(t, F.lit(4)).alias("value"))
    extra = F.filter(F.slice(parts, 12, 10_000), lambda t: F.length(t) >= 5)
    rows = spark.read.text(path).filter(~F.col("value").startswith("@")).select(*columns, F.map_from_entries(F.transform(extra, pair)).alias("tags"))
    return rows.withColumn("pos", F.col("pos") - 1).withColumn("pnext", F.col("pnext") - 1)


def headers(spark: SparkSession, path: str) -> DataFrame:
    """The header lines of SAM text."""
    return spark.read.text(path).filter(F.col("value").startswith("@"))


def _without(tags: Column, tag: str) -> Column:
    return F.map_filter(tags, lambda k, _: k != tag)


def sink_sam(df: DataFrame, path: str, tags: dict[str, Column] | None = None) -> None:
    """Write alignments as SAM text without header; `tags`: two-letter tag -> its text value."""
    merged = F.col("tags") if "tags" in df.columns else F.create_map().cast("map<string,string>")
    for tag, value in (tags or {}).items():
        merged = F.map_concat(_without(merged, tag), F.create_map(F.lit(tag), F.concat(F.lit("Z:"), value)))
    texts = F.transform(F.array_sort(F.map_entries(merged)), lambda e: F.concat_ws(":", e["key"], e["value"]))
    fixed = [(F.col(f) + 1 if f in ("pos", "pnext") else F.col(f)).cast("string") for f in FIELDS]
    df.select(F.concat_ws("\t", *fixed, texts).alias("value")).write.mode("overwrite").text(path)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


_BASES = "=ACMGRSVTWYHKDBN"
_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_CODES = {"A": "<c", "c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}


def _tags(raw: bytes) -> dict[str, str]:
    out, at = {}, 0
    while at + 3 <= len(raw):
        tag, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(b"\0", at)
            out[tag], at = f"{kind}:{raw[at:end].decode()}", end + 1
        elif kind == "B":
            sub, n = chr(raw[at]), struct.unpack_from("<i", raw, at + 1)[0]
            values = struct.unpack_from(f"<{n}{_CODES[sub][1]}", raw, at + 5)
            out[tag], at = f"B:{sub}," + ",".join(map(str, values)), at + 5 + n * _SIZES[sub]
        else:
            value = struct.unpack_from(_CODES[kind], raw, at)[0]
            out[tag] = f"A:{value.decode()}" if kind == "A" else f"{'f' if kind == 'f' else 'i'}:{value}"
            at += _SIZES[kind]
    return out


class BamReader(DataSourceReader):
    """A task per file: BGZF is a series of gzip members, which are read as one stream."""

    def __init__(self, options: dict):
        self.paths = sorted(p for part in options["path"].split(",") for p in files.expand(part))

    def partitions(self) -> list[_File]:
        return [_File(p) for p in self.paths]

    def read(self, part: _File) -> Iterator[tuple]:
        with files.open_binary(part.path, unzip=True) as file:
            number = lambda: struct.unpack("<i", file.read(4))[0]
            if file.read(4) != b"BAM\1":
                raise ValueError(f"{part.path}: not a BAM file")
            file.read(number())
            names = []
            for _ in range(number()):
                names.append(file.read(number())[:-1].decode())
                number()
            name = lambda i: names[i] if i >= 0 else "*"
            while head := file.read(4):
                raw = file.read(struct.unpack("<i", head)[0])
                ref, pos, l_name, mapq, _, n_cigar, flag, l_seq, next_ref, next_pos, tlen = struct.unpack_from("<iiBBHHHiiii", raw)
                at = 32 + l_name
                ops = struct.unpack_from(f"<{n_cigar}I", raw, at)
                cigar = "".join(f"{x >> 4}{'MIDNSHP=X'[x & 15]}" for x in ops) or "*"
                at += 4 * n_cigar
                packed = raw[at : at + (l_seq + 1) // 2]
                seq = "".join(_BASES[b >> 4] + _BASES[b & 15] for b in packed)[:l_seq] or "*"
                at += (l_seq + 1) // 2
                qual = raw[at : at + l_seq]
                text = "*" if not l_seq or qual[:1] == b"\xff" else "".join(chr(q + 33) for q in qual)
                mate = "=" if next_ref >= 0 and next_ref == ref else name(next_ref)
                yield raw[32 : 31 + l_name].decode(), flag, name(ref), pos, mapq, cigar, mate, next_pos, tlen, seq, text, _tags(raw[at + l_seq :])


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(self.options)


def scan_bam(spark: SparkSession, paths: list[str]) -> DataFrame:
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("path", ",".join(paths)).load()
