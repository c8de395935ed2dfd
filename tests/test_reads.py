"""Trimming and read QC against plain Python and golden cases."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandloom.operators import readqc as Q
from strandloom.operators import trim as T


def fq(spark, rows):
    return spark.createDataFrame([(f"r{i}", s, q if q is not None or s is None else "I" * len(s)) for i, (s, q) in enumerate(rows)], "name string, seq string, qual string")


def by_name(df, *columns):
    return {r["name"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def cut(qual, cutoff):
    total = most = 0
    keep = len(qual)
    for i in reversed(range(len(qual))):
        total += cutoff - (ord(qual[i]) - 33)
        if total < 0:
            break
        if total > most:
            most, keep = total, i
    return keep


def start(seq, adapter, overlap):
    for p in range(len(seq)):
        part = adapter[: len(seq) - p]
        if len(part) >= overlap and sum(a != b for a, b in zip(part, seq[p:])) <= int(len(part) * 0.1):
            return p
    return len(seq)


def test_quality_trim_equals_loop(spark):
    rnd = random.Random(1)
    rows = [("A" * n, "".join(chr(33 + rnd.randint(0, 40)) for _ in range(n))) for n in (rnd.randint(0, 60) for _ in range(200))]
    got = by_name(T.trim_quality(fq(spark, rows), 20), "seq", "qual")
    assert got == {f"r{i}": (s[: cut(q, 20)], q[: cut(q, 20)]) for i, (s, q) in enumerate(rows)}
    assert by_name(T.trim_quality(fq(spark, [(None, None), ("", "")])), "seq") == {"r0": None, "r1": ""}


def test_two_colour_counts_g_as_bad(spark):
    assert by_name(T.trim_quality(fq(spark, [("ACGGGG", "IIIIII"), ("ACGTGG", "IIIIII")]), 20, two_colour=True), "seq") == {"r0": "AC", "r1": "ACGT"}


def test_adapter_trim_equals_loop(spark):
    rnd = random.Random(2)
    a = T.ADAPTERS["Nextera"]
    seqs = ["".join(rnd.choices("ACGT", k=rnd.randint(0, 30))) + a[: rnd.randint(0, 12)] + "".join(rnd.choices("CT", k=rnd.randint(0, 5))) for _ in range(200)]
    for overlap in (1, 5):
        got = by_name(T.trim_adapter(fq(spark, [(s, None) for s in seqs]), a, min_overlap=overlap), "seq")
        assert got == {f"r{i}": s[: start(s, a, overlap)] for i, s in enumerate(seqs)}


def test_trim_summary_and_lengths_equal_loop(spark):
    rnd = random.Random(12)
    a = T.ADAPTERS["Illumina"]
    rows = [(None, None), ("", "")]
    for _ in range(150):
        s = "".join(rnd.choices("ACGT", k=rnd.randint(0, 25))) + a[: rnd.randint(0, len(a))]
        rows.append((s, "".join(chr(33 + rnd.randint(10, 40)) for _ in s)))
    kept = [s[: cut(q, 20)] for s, q in rows if s is not None]
    left = [s[: start(s, a, 1)] for s in kept]
    size = lambda texts: sum(map(len, texts))
    want = (len(rows), sum(x != y for x, y in zip(kept, left)), size(s for s, _ in rows if s), size(s for s, _ in rows if s) - size(kept), size(kept) - size(left), size(left))
    df = fq(spark, rows).withColumn("_note", F.lit(1))
    assert tuple(T.summary(df, a).first()) == want
    gone = Counter(len(s) - start(s, a, 1) for s, _ in rows if s is not None)
    got = {r.length: (r.reads, r.expected, r.max_errors) for r in T.adapter_lengths(df, a).collect()}
    assert got == {n: (k, len(rows) * 0.25 ** min(n, len(a)), min(n, len(a)) // 10) for n, k in gone.items() if n > 0}
    assert tuple(T.summary(df.limit(0), a).first()) == (0,) * 6 and T.adapter_lengths(df.limit(0), a).collect() == []


def test_long_reads_go_in_steps(spark, monkeypatch):
    monkeypatch.setattr(T, "_CELLS", 1000)
    work = T._quality_cut(20)
    import pandas as pd

    quals = pd.Series(["I" * 700 + "#" * 50, None, "##", "I" * 5])
    assert T._in_steps([quals], work).tolist() == [700, pd.NA, 0, 5]


def test_detection_ties(spark):
    make = lambda *n: spark.createDataFrame([(100, *n)], "reads int, Illumina int, Nextera int, smallRNA int")
    name = lambda df, **k: T.detect_adapter(df, **k).first().adapter
    assert [name(make(*n)) for n in ((3, 2, 1), (1, 5, 2), (0, 0, 4), (2, 2, 2), (0, 3, 3), (3, 1, 3))] == ["Illumina", "Nextera", "smallRNA", "Illumina", "Nextera", "Illumina"]
    assert T.detect_adapter(make(2, 1, 0), already_trimmed=2).first().sequence == "X"


def test_clips_and_hard_trims(spark):
    df = fq(spark, [("ACGTACGT", "12345678"), ("ACG", "123")])
    assert by_name(T.clip(df, five=3, three=2), "seq", "qual") == {"r0": ("TAC", "456"), "r1": ("A", "1")}
    assert by_name(T.hard_trim(df, 5, 3), "seq", "qual") == {"r0": ("TACGT", "45678"), "r1": ("ACG", "123")}
    assert by_name(T.hard_trim(df, 5, 5), "seq") == {"r0": "ACGTA", "r1": "ACG"}


def test_length_and_n(spark):
    df = fq(spark, [("ACGN", None), ("NNAA", None), ("AC", None), ("ACGTACGT", None)])
    assert set(by_name(T.long_enough(df, 3, 6, 1), "seq")) == {"r0"}
    assert set(by_name(T.long_enough(df, 1, None, 0.3), "seq")) == {"r0", "r2", "r3"}


def test_pairs(spark):
    a = spark.createDataFrame([(1, "A" * 30, "I" * 30), (2, "A" * 10, "I" * 10), (3, "A" * 40, "I" * 40), (4, "A", "I")], "k int, seq string, qual string")
    b = spark.createDataFrame([(1, "A" * 30, "I" * 30), (2, "A" * 50, "I" * 50), (3, "A" * 10, "I" * 10), (4, "A", "I")], "k int, seq string, qual string")
    assert {r.k: r.state for r in T.validate_pairs(a, b, "k", 20, (35, 35)).collect()} == {1: "pair", 2: "only2", 3: "only1", 4: "dropped"}
    with pytest.raises(Exception, match="a mate is missing"):
        T.validate_pairs(a, b.filter("k < 3"), "k").collect()


def test_special_trims(spark):
    pair = spark.createDataFrame([("n1", "n2", "UUUUUUUUCAGTAFFFF", "q" * 17, "VVVVVVVVCAGGAGGG", "r" * 16)], "name1 string, name2 string, seq1 string, qual1 string, seq2 string, qual2 string")
    c = T.clock_trim(pair).first()
    assert (c.name1, c.seq1, c.seq2, c.qual2, c.lacking) == ("n1:R1:UUUUUUUU:R2:VVVVVVVV:F1:CAGT:F2:CAGG", "FFFF", "GGG", "rrr", True)
    u = T.transfer_umi(pair).first()
    assert (u.name1, u.name2, u.seq1, u.seq2) == ("n1:VVVVVVVV", "n2:VVVVVVVV", "UUUUUUUUCAGTAFFFF", "CAGGAGGG")
    df = fq(spark, [("CAATT", None), ("CGGTT", None), ("CGGTTTTT", None), ("CA", None)]).withColumn("full_length", F.lit(8))
    assert by_name(T.trim_rrbs(df), "seq") == {"r0": "CAA", "r1": "CGG", "r2": "CGGTTTTT", "r3": ""}
    assert by_name(T.trim_rrbs(df, directional=False), "seq") == {"r0": "ATT", "r1": "CGG", "r2": "CGGTTTTT", "r3": "CA"}
    poly = T.trim_poly_a(fq(spark, [("CGAAAA", None), ("CGAA", None), ("AAAA", None)])).collect()
    assert sorted((r.name, r.seq) for r in poly) == [("4:r0_PolyA:4", "CG"), ("4:r2_PolyA:4", ""), ("r1", "CGAA")]
    assert by_name(T.remove_prefixes(fq(spark, [("GGTACA", None), ("GGA", None), ("TTT", None)]), spark.createDataFrame([("GG",), ("GGTA",)], "adapter string")), "seq") == {"r0": "CA", "r1": "A", "r2": "TTT"}
    assert fq(spark, [("GATN", None)]).select(T.reverse_complement(F.col("seq"))).first()[0] == "NATC"
    with pytest.raises(Exception, match="colour-space"):
        T.reject_colour_space(fq(spark, [("T0123", None)])).collect()


def test_qc_modules(spark):
    df = fq(spark, [("ACGT", "IIII"), ("ACGN", "II##"), ("GGGG", "5555"), ("AC", "I#")]).withColumn("name", F.concat(F.lit("m:1:f:2:"), (F.length("seq") * 100).cast("string"), F.lit(":9")))
    assert Q.basic(df).first().asDict() == {"reads": 4, "shortest": 2, "longest": 4, "gc": 69}
    box = {r.pos: (r.p10, r.p50, r.p90, r.grade) for r in Q.per_base_quality(df).collect()}
    assert box[1] == (20, 40, 40, "pass") and box[4] == (2, 20, 40, "fail")
    assert {r.pos: r.n for r in Q.n_content(df).collect()}[4] == pytest.approx(100 / 3)
    assert {r["length"]: r.reads for r in Q.lengths(df).collect()} == {4: 3, 2: 1}
    assert {(r.pos, r.a, r.c) for r in Q.composition(df).collect() if r.pos == 1} == {(1, 75.0, 0.0)}
    off = {(r.tile, r.pos): r.deviation for r in Q.tiles(df).collect()}
    assert off[("200", 2)] == pytest.approx(2 - (40 + 40 + 20 + 2) / 4)
    assert {r.mean_quality: r.reads for r in Q.per_sequence_quality(df).collect()} == {40: 1, 21: 2, 20: 1}


def test_qc_duplicates_and_adapters(spark):
    long = "ACGT" * 20
    df = fq(spark, [(long, None), (long[:50] + "T" * 30, None), ("AC", None)] + [("GG", None)] * 12)
    assert {r["level"]: (r.sequences, r.reads) for r in Q.duplication(df).collect()} == {1: (1, 1), 2: (1, 2), 10: (1, 12)}
    assert Q.remaining(df).first().remaining == pytest.approx(20.0)
    assert {r["sequence"]: r.reads for r in Q.overrepresented(df, 10).collect()} == {"GG": 12, long[:50]: 2}
    a = Q.ADAPTERS["Nextera Transposase Sequence"]
    content = {(r.adapter, r.pos): r.percent for r in Q.adapter_content(fq(spark, [("A" + a, None), ("C" * 13, None)])).collect()}
    name = "Nextera Transposase Sequence"
    assert [content[name, p] for p in (1, 2, 13)] == [0.0, 50.0, 50.0] and content["SOLID Small RNA Adapter", 13] == 0.0
    found = Q.contaminants(spark.createDataFrame([("T" + "ACGGTCATTGCA" + "T",)], "sequence string"), spark.createDataFrame([("hit", "ACGGTCATTGGA"), ("far", "ACGGTCAAAGGA")], "name string, contaminant string"), 12)
    assert [r.name for r in found.collect()] == ["hit"]
    k = {(r.kmer, r.pos): (r.seen, r.ratio) for r in Q.kmers(fq(spark, [("AAC", None), ("CAA", None)]), 2).collect()}
    assert k[("AA", 1)] == (1, 1.0) and k[("AC", 2)][1] == 2.0


def test_qc_of_nothing(spark):
    none = fq(spark, [("A", "I")]).limit(0)
    assert Q.per_base_quality(none).collect() == [] and Q.duplication(none).collect() == [] and Q.kmers(none).collect() == []
    assert Q.basic(none).first().reads == 0


def test_poly_tails_at_both_ends(spark):
    df = spark.createDataFrame([("a", "ACGTTTT", "1234567"), ("b", "ACGTT", "12345"), ("c", "TTTT", "1234"), ("d", None, None), ("e", "", "")], "name string, seq string, qual string")
    three = {r.name: (r.seq, r.qual) for r in T.trim_poly(df, "T").collect()}
    assert three == {"4:a_PolyT:4": ("ACG", "123"), "b": ("ACGTT", "12345"), "4:c_PolyT:4": ("", ""), "d": (None, None), "e": ("", "")}
    five = {r.name: (r.seq, r.qual) for r in T.trim_poly(df.withColumn("seq", F.reverse("seq")), "T", end=5).collect()}
    assert five["4:a_PolyT:4"] == ("GCA", "567") and five["b"] == ("TTGCA", "12345")


def test_pairs_with_too_many_n(spark):
    one = spark.createDataFrame([(1, "ACGTN", "IIIII"), (2, "ANNGT", "IIIII"), (3, "ACGT", "IIII"), (4, "nnnnn", "IIIII")], "k int, seq string, qual string")
    two = spark.createDataFrame([(k, "ACGTA", "IIIII") for k in (1, 2, 3, 4)], "k int, seq string, qual string")
    state = lambda **more: {r.k: r.state for r in T.validate_pairs(one, two, "k", 5, **more).collect()}
    assert state(max_n=1) == {1: "pair", 2: "dropped", 3: "dropped", 4: "dropped"} and state() == {1: "pair", 2: "pair", 3: "dropped", 4: "pair"}
    assert state(max_n=1, unpaired=(4, 4)) == {1: "pair", 2: "dropped", 3: "only1", 4: "dropped"}


def test_grades(spark):
    df = lambda *seqs: spark.createDataFrame([(s, "I" * len(s)) for s in seqs], "seq string, qual string")
    assert [(r.value, r.grade) for r in Q.lengths_grade(df("ACG", "AC", "")).collect()] == [(3.0, "fail")]
    assert [r.grade for r in Q.lengths_grade(df("ACG", "ACT")).collect()] == ["pass"] and [r.grade for r in Q.lengths_grade(df("ACG", "AC")).collect()] == ["warn"]
    assert [(r.value, r.grade) for r in Q.gc_grade(df("AC", "GT")).collect()] == [(0.0, "pass")]
    assert Q.gc_grade(df("AC", "GT", "GG", "AA", "AAAAAAAAAC")).first().grade == "fail"
    assert [(r.value, r.grade) for r in Q.adapter_grade(df("AGATCGGAAGAGC", "ACGTACGTACGTACGT")).collect()] == [(50.0, "fail")]
