import gzip
import json
import struct

import pytest
from pyspark.sql import functions as F

from strandloom.operators import alignments as A
from strandloom.operators import cluster as C
from strandloom.plans import pipelines
from strandloom.sources import alignment, config, fastq, files, tables


def records(n, mate=1):
    return "".join(f"@read{i} c{i}\n{'ACGT' * (i % 5 + 1)}\n+\n{'@' * (4 * (i % 5 + 1))}\n" for i in range(n))


def test_fastq_in_chunks_and_gz(spark, tmp_path):
    (tmp_path / "a.fastq").write_text(records(300))
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as out:
        out.write(records(20))
    for chunk in (97, 1 << 20):  # quality lines of @ must not be taken for the start of a record
        got = fastq.scan(spark, [str(tmp_path / "a.fastq"), str(tmp_path / "b.fastq.gz")], chunk).collect()
        assert sorted((r.lane, r.idx) for r in got) == [(0, i) for i in range(300)] + [(1, i) for i in range(20)]
        assert all(r.name == f"read{r.idx}" and r.comment == f"c{r.idx}" and len(r.seq) == len(r.qual) for r in got)


def test_mates_and_cut_file(spark, tmp_path):
    (tmp_path / "1.fq").write_text(records(12))
    (tmp_path / "2.fq").write_text(records(12))
    (tmp_path / "3.fq").write_text(records(11))
    both = fastq.scan_mates(spark, [[str(tmp_path / "1.fq")], [str(tmp_path / "2.fq")]])
    assert both.filter("r1.name = r2.name").count() == 12
    with pytest.raises(Exception, match="a mate is missing"):
        fastq.scan_mates(spark, [[str(tmp_path / "1.fq")], [str(tmp_path / "3.fq")]]).select("r1.name").collect()
    (tmp_path / "bad.fq").write_text("@x\nACG\n+\nII\n")
    with pytest.raises(Exception, match="not a FASTQ record"):
        fastq.scan(spark, [str(tmp_path / "bad.fq")]).collect()


def test_fastq_round_trip_by_route(spark, tmp_path):
    df = spark.createDataFrame([("n1", "ACGT", "IIII", "DNA"), ("n2", "GG", "##", "RNA")], "name string, seq string, qual string, type string")
    fastq.sink(df, str(tmp_path / "out"), ["type"])
    back = fastq.scan(spark, [str(tmp_path / "out/type=RNA/*.txt")]).collect()
    assert [(r.name, r.seq, r.qual) for r in back] == [("n2", "GG", "##")]


SAM = "@HD\tVN:1.6\nq1\t99\tchr1\t101\t60\t4M\t=\t200\t103\tACGT\tIIII\tNM:i:0\tUM:Z:AC:GT\nq2\t4\t*\t0\t0\t*\t*\t0\t0\tNN\t##\n"


def test_sam_round_trip(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    df = alignment.scan_sam(spark, str(tmp_path / "a.sam"))
    q1 = df.filter("qname = 'q1'").first()
    assert (q1.flag, q1.pos, q1.tags) == (99, 100, {"NM": "i:0", "UM": "Z:AC:GT"}) and alignment.headers(spark, str(tmp_path / "a.sam")).count() == 1
    alignment.sink_sam(df, str(tmp_path / "out"), {"XX": F.col("qname")})
    back = alignment.scan_sam(spark, str(tmp_path / "out"))
    assert back.filter("qname = 'q1'").first().tags == {"NM": "i:0", "UM": "Z:AC:GT", "XX": "Z:q1"}
    assert back.select(*alignment.FIELDS).exceptAll(df.select(*alignment.FIELDS)).count() == 0


def test_bam(spark, tmp_path):
    seq, cigar = "ACGTN", [(3, 0), (1, 1), (1, 4)]
    codes = ["=ACMGRSVTWYHKDBN".index(b) for b in seq] + [0]
    packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, 6, 2))
    tags = b"NMC\x02" + b"UMZAC\0" + b"XBBs" + struct.pack("<ihh", 2, -1, 7) + b"XFf" + struct.pack("<f", 0.5)
    body = struct.pack("<iiBBHHHiiii", 1, 100, 3, 60, 0, len(cigar), 99, len(seq), 1, 200, 105) + b"q1\0" + b"".join(struct.pack("<I", n << 4 | op) for n, op in cigar) + packed + bytes([40, 40, 2, 40, 30]) + tags
    refs = b"".join(struct.pack("<i", len(n) + 1) + n + b"\0" + struct.pack("<i", 1000) for n in (b"chr1", b"chr2"))
    raw = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 2) + refs + struct.pack("<i", len(body)) + body
    (tmp_path / "a.bam").write_bytes(gzip.compress(raw[:30]) + gzip.compress(raw[30:]))
    r = alignment.scan_bam(spark, [str(tmp_path / "a.bam")]).first()
    assert (r.qname, r.flag, r.rname, r.pos, r.cigar, r.rnext, r.pnext, r.tlen, r.seq, r.qual) == ("q1", 99, "chr2", 100, "3M1I1S", "=", 200, 105, "ACGTN", "II#I?")
    assert r.tags == {"NM": "i:2", "UM": "Z:AC", "XB": "B:s,-1,7", "XF": "f:0.5"}


def test_mate_cases(spark):
    rows = [("one", 65, "chr1", 10, "5M"), ("one", 129, "*", 0, "*"), ("same", 65, "chr1", 50, "5M2D3M4S"), ("same", 129, "chr1", 20, "6M"), ("tie", 65, "chr2", 5, "9M"), ("tie", 129, "chr3", 5, "9M"), ("long", 65, "chr2", 5, "3M"), ("long", 129, "chr3", 5, "4M"), ("none", 65, "*", 0, "*"), ("orphan", 65, "chr1", 1, "2M")]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos bigint, cigar string")
    got = {r.qname: (r.chr, r.start_pos, r.end_pos) for r in A.fragment(A.mates(df)).collect()}
    assert got == {"one": ("chr1", 10, 15), "same": ("chr1", 20, 60), "tie": ("chr2", 5, 14), "long": ("chr3", 5, 9), "orphan": ("chr1", 1, 3)}
    assert "orphan" not in {r.qname for r in A.mates(df, strict=True).collect()}
    one = A.tn5_shift(A.fragment(A.mates(A.one_mate(df, 2)))).filter("qname = 'same'").first()
    assert (one.start_pos, one.end_pos) == (24, 21)


def test_clusters_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("c1", 1, "chr1", 1, 5), ("c1", 2, "chr2", 3, 4), ("c2", 3, "chr1", 7, 9)], "gid string, idx bigint, chr string, start_pos bigint, end_pos bigint")
    tables.sink_clusters(df, ["gid"], str(tmp_path / "c"))
    back = tables.scan_clusters(spark, str(tmp_path / "c"), ["gid"])
    assert sorted((r.gid, r.i, r.chr, r.start_pos, r.end_pos) for r in back.collect()) == [("c1", 0, "chr1", 1, 5), ("c1", 1, "chr2", 3, 4), ("c2", 0, "chr1", 7, 9)]
    (tmp_path / "x.cluster").write_text("@CN\tCELL\tCOMPLEX\tCount\n#note\nk1\tx1\t2\tchr1\t1\t2\tchr3\t5\t6\tu\tv\n\nk2\tx2\t0\n")
    extra = tables.scan_clusters(spark, str(tmp_path / "x.cluster"), ["cell", "gid"], extras=1).collect()
    assert [(r.cell, r.gid, r.chr, r.end_pos, r.extra_0) for r in extra] == [("k1", "x1", "chr1", 2, "u"), ("k1", "x1", "chr3", 6, "v")]
    assert tables.cluster_header(spark, str(tmp_path / "x.cluster")) == ["CELL", "COMPLEX", "Count"]


def test_small_tables(spark, tmp_path):
    with gzip.open(tmp_path / "w.txt.gz", "wt") as out:
        out.write("n1 ACGT\nn2\tGGTT\n")
    (tmp_path / "w1.txt").write_text("ACGT\n\nTTTT\n")
    assert [tuple(r) for r in tables.scan_whitelist(spark, str(tmp_path / "w.txt.gz")).collect()] == [(0, "n1", "ACGT"), (1, "n2", "GGTT")]
    assert [tuple(r) for r in tables.scan_whitelist(spark, str(tmp_path / "w1.txt")).collect()] == [(0, "ACGT", "ACGT"), (1, "TTTT", "TTTT")]
    idb = spark.createDataFrame([("1-2", 1, 5, "BC:ACGT")], "idb_key string, id bigint, n bigint, names string")
    tables.sink_idb(idb, str(tmp_path / "idb"))
    assert tables.scan_idb(spark, str(tmp_path / "idb")).collect() == idb.collect()
    bed = spark.createDataFrame([("chr2", 5, 9, "b", 1), ("chr1", 7, 8, "a", 2)], "chr string, start_pos bigint, end_pos bigint, name string, dup bigint")
    tables.sink_bed(bed, str(tmp_path / "bed"))
    assert [r.chr for r in tables.scan_bed(spark, str(tmp_path / "bed")).orderBy("chr").collect()] == ["chr1", "chr2"]
    counts = spark.createDataFrame([(1, 9, "AC")], "ord bigint, count bigint, seq string")
    tables.sink_counts(counts, str(tmp_path / "counts"))
    assert tables.scan_counts(spark, str(tmp_path / "counts")).collect() == counts.collect()


def test_matrix_files(spark, tmp_path):
    entries = spark.createDataFrame([(1, 1, 3), (2, 1, 1)], "i bigint, j bigint, v bigint")
    peaks = spark.createDataFrame([("chr1", 0, 5, 1), ("chr1", 9, 12, 2)], "chr string, start_pos bigint, end_pos bigint, i bigint")
    tables.sink_matrix(entries, peaks, spark.createDataFrame([("x", 1)], "cell string, j bigint"), str(tmp_path))
    head = "".join(p.read_text() for p in sorted((tmp_path / "matrix/part=0").glob("*.txt")))
    assert head == "%%MatrixMarket matrix coordinate integer general\n2 1 2\n"
    assert sorted(map(tuple, tables.scan_matrix(spark, str(tmp_path)).collect())) == [(1, 1, 3), (2, 1, 1)]


CONFIG = """// layout
# comment
{"Barcode Chain": [{"BC-UMI|1-GENOMED": "R1:1"}, {"ODD/EVEN-GENOMER": "R2:3"}],
 "BARCODE TYPE": [{"BC": {"LENGTH": "4-6", "LAXITY": 2, "MISMATCH": 1, "SPACE": 1, "DENSE": 1, "WHITE LIST": ["ACGT", {"two": "GGCC"}]}}, {"UMI": {"WHITE LIST": ["NNNNN"]}}, {"ODD": {"LENGTH": 3, "WHITE LIST": ["AAA"]}}, {"EVEN": {"LENGTH": 3, "RANDOM": true}}],
 "identifier": {"CELL": "2:BC-ANY-4:ODD/EVEN"}, "son": {"COMPLEX": "CELL"}, "other": 1}
"""


def test_config():
    c = config.parse(CONFIG)
    assert c.chains[0] == config.Chain([("BC",), ("UMI",), ("GENOMED",)], 1, 1, "D") and c.chains[1].holes[0] == ("ODD", "EVEN") and c.chains[1].genome == "R"
    bc = c.types["BC"]
    assert (bc.space, bc.laxity, bc.length, bc.mismatch, bc.dense, bc.random, bc.whitelist) == (1, 2, (4, 6), 1, True, False, [("BC:ACGT", "ACGT"), ("two", "GGCC")])
    assert c.types["UMI"].verbatim and not bc.verbatim and c.types["UMI"].length == (5, 5) and c.types["EVEN"].random
    assert c.identifiers[0].pattern == [(2, ("BC",)), (None, None), (4, ("ODD", "EVEN"))] and c.identifiers[0].anchored and c.sons == {"COMPLEX": "CELL"} and c.ignored == ["other"]
    assert config.BarcodeType("GENOMED").payload and not bc.payload
    assert config.with_whitelist(c, "BC", [("a", "ACGTA")]).types["BC"].length == (5, 5)
    assert ("BC", 1, "GGCC", "two") in c.whitelist_rows()
    assert config.field_spec("3:UMI:UM-DPM:DP-BC") == [("3:UMI", "UM"), ("DPM", "DP"), ("BC", "BC")]


def test_config_errors():
    with pytest.raises(ValueError, match="not a place"):
        config.parse(json.dumps({"barcode chain": [{"A": "R9:1"}], "barcode type": [{"A": {"LENGTH": 3}}]}))
    with pytest.raises(ValueError, match="without a type"):
        config.parse(json.dumps({"barcode chain": [{"A": "R1:1"}]}))
    with pytest.raises(ValueError, match="must ascend"):
        config.parse(json.dumps({"identifier": {"X": "3:A-2:B"}}))


def test_names(spark):
    df = spark.createDataFrame([("r1/1 x|||BC:AC|UMI:G:T|||CELL_1|COMPLEX_2_3",), ("plain",)], "n string")
    a, b = df.select(A.split_name(F.col("n")).alias("x")).select("x.*").collect()
    assert [tuple(v) for v in a.barcodes] == [("BC", "AC"), ("UMI", "G:T")] and a.ids == {"CELL": "1", "COMPLEX": "2_3"} and b.read == "plain" and b.ids == {}


def test_barcodes_as_tags(spark, tmp_path):
    rows = [("r1|||BC:AC|UMI:GG|DPM:T|||CELL_1", 0, "chr1", 4, 60, "5M", "*", -1, 0, "ACGTA", "IIIII")]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos bigint, mapq int, cigar string, rnext string, pnext bigint, tlen bigint, seq string, qual string")
    alignment.sink_sam(df, str(tmp_path / "s"), A.extra_tags(A.split_name(F.col("qname"))["barcodes"], "2:UMI:UM-DPM:DP"))
    assert alignment.scan_sam(spark, str(tmp_path / "s")).first().tags == {"UM": "Z:GG", "DP": "Z:T"}


def test_files_by_path_and_address(tmp_path):
    for n in ("b.fq", "a.fq", "c.txt"):
        (tmp_path / n).write_text(n)
    assert files.expand(str(tmp_path / "*.fq")) == [str(tmp_path / n) for n in ("a.fq", "b.fq")]
    assert files.expand(f"file://{tmp_path}/*.fq") == [f"file://{tmp_path}/{n}" for n in ("a.fq", "b.fq")] and files.expand("s3://bucket/x.fq") == ["s3://bucket/x.fq"]
    assert files.size(f"file://{tmp_path}/a.fq") == 4 and files.open_binary(str(tmp_path / "b.fq")).read() == b"b.fq"
    with pytest.raises(FileNotFoundError):
        files.size(str(tmp_path / "none"))


def test_pipeline_of_hand_made_reads(spark):
    rows = [(f"q{i}|||BC:A|||COMPLEX_{1 + i // 4}", 0, "chr1", 1000 * i, 60, "50M") for i in range(8)] + [("bad|||BC:A|||COMPLEX_1", 0, "chr1", 5, 3, "50M"), ("no id", 0, "chr1", 5, 60, "50M"), ("m|||BC:A|||COMPLEX_1", 0, "chrM", 5, 60, "50M")]
    out = pipelines.refine(spark.createDataFrame(rows, "qname string, flag int, rname string, pos bigint, mapq int, cigar string"), "chiadrop")
    assert sorted((r.gid, r.chr, r.start_pos, r.end_pos) for r in out["regions"].collect()) == [("1", "chr1", 0, 3150), ("2", "chr1", 4000, 7150)]
    assert out["contacts"].count() == 0 and {r["class"]: r.groups for r in out["histogram"].collect()}["F = 1"] == 2


def test_pipelines_take_their_alignments(spark):
    """Unique reads of scsprite, the mask of sprite, both kinds of rdsprite."""
    schema = "qname string, flag int, rname string, pos bigint, mapq int, cigar string"
    name = lambda i: f"q{i}|||BC:A|||CELL_{i % 2}|COMPLEX_{i // 3}"
    star = spark.createDataFrame([(name(i), 2304 if i == 5 else 0, "chr1" if i % 2 else "chrUn_1", 100 * (i // 2), 3 if i == 0 else 255, "50M") for i in range(6)], schema)
    single = pipelines.refine(star, "scsprite")
    assert sorted((r.parent, r.gid, r.sub_id, r.chr, r.start_pos, r.dup) for r in single["regions"].collect()) == [("0", "0", "0-1", "chrUn_1", 100, 1), ("0", "1", "1-1", "chrUn_1", 200, 1), ("1", "0", "0-0", "chr1", 0, 1), ("1", "1", "1-0", "chr1", 100, 1), ("1", "1", "1-0", "chr1", 200, 1)]
    dna = spark.createDataFrame([(name(i), 0, "chr1", 100 * i, 60, "50M") for i in range(3)] + [(name(0), 256, "chr1", 7, 60, "50M"), (name(1), 0, "chr1", 9, 10, "50M")], schema)
    hidden = spark.createDataFrame([("chr1", 149, 160)], "chr string, start_pos bigint, end_pos bigint")
    assert sorted(r.start_pos for r in pipelines.refine(dna, "sprite", hidden)["dedup"].collect()) == [0, 200]
    mixed = pipelines.refine(dna, "rdsprite", rna=star)["mixed"].collect()
    assert {(r.type, r.name, r.len) for r in mixed} == {("DNA", f"0-3-{i}", 50) for i in range(3)} | {("RNA", f"0-2-{i}", 50) for i in range(2)} | {("RNA", f"1-3-{i}", 50) for i in range(3)}
