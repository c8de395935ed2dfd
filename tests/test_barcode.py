"""Barcode operators against a read-by-read scan and golden cases."""

import random

from pyspark.sql import functions as F

from strandloom.operators import barcode as B

BC = ["ACGTACGT", "TTTTCCCC", "GGGGAAAA", "ACGTACGA"]


def table(spark):
    return spark.createDataFrame(list(enumerate(BC)), "ord bigint, seq string")


def reads(spark, seqs, qual=None):
    return spark.createDataFrame([(f"r{i}", s, (qual or {}).get(i, "I" * len(s or ""))) for i, s in enumerate(seqs)], "rid string, seq string, qual string")


def test_expand_prefers_near_then_early(spark):
    got = {r.variant: (r.ord, r.dist, r.conflicts) for r in B.expand(table(spark)).collect()}
    assert got["ACGTACGT"] == (0, 0, 1) and got["ACGTACGC"] == (0, 1, 1) and got["TTTTCCCA"] == (1, 1, 0)
    assert len({v for v in got}) == len(got)


def test_sparse_dense_and_n(spark):
    r = reads(spark, ["TTTTCCCC", "TTTTCCCA", "NTTTCCCC", "GGGGAATT", None, ""])
    sparse = {x.rid: x.ord for x in B.correct_sparse(r, table(spark), "seq").collect()}
    assert sparse == {"r0": 1, "r1": 1, "r2": None, "r3": None, "r4": None, "r5": None}
    dense = {x.rid: x.ord for x in B.decide(B.candidates(r, table(spark), "rid", "seq", "qual"), "rid", "minq").collect()}
    assert dense == {"r1": 1, "r2": 1}  # N is tolerated here, exact hits are not looked at


def test_posteriors(spark):
    r = reads(spark, ["ACGTACGC", "ACGTACGC"], {0: "IIIIIIII", 1: "IIIIIII#"})
    found = B.candidates(r, table(spark), "rid", "seq", "qual")
    assert found.count() == 4
    assert B.decide(found, "rid", "rnat").collect() == []  # two equal candidates are rejected
    priors = spark.createDataFrame([(3, 1000)], "ord bigint, prior bigint")
    assert {(x.rid, x.ord) for x in B.decide(found, "rid", "atact", priors).collect()} == {("r0", 3), ("r1", 3)}
    assert {x.ord for x in B.decide(found, "rid", "fcfg").collect()} == {0}


def test_two_rounds_use_priors(spark):
    r = reads(spark, ["ACGTACGA"] * 50 + ["ACGTACGC", "AAAAAAAA"])
    got = {x.rid: (x.ord, x.round) for x in B.correct(r, table(spark), "rid", "seq", "qual").collect()}
    assert got["r50"] == (3, 1) and got["r0"] == (3, 0) and "r51" not in got


def test_quality_and_letters(spark):
    df = spark.createDataFrame([("I!", "ACGN"), ("", "acgt"), (None, "AXC"), ("5", None)], "q string, s string")
    got = df.select(B.mean_quality_at_least(df.q, 20).alias("ok"), B.valid(df.s).alias("v")).collect()
    assert [r.ok for r in got] == [True, False, False, True] and [r.v for r in got] == [True, True, False, None]
    assert [r.s for r in B.without_n(df, "s").collect()] == ["acgt"]


def scan(seq, holes, words, pos=1):
    out = []
    for hole in holes:
        hit = None
        for kind in hole.alternatives:
            for shift in range(hole.laxity + 1):
                for size in range(hole.length[0], hole.length[1] + 1):
                    sub = seq[pos - 1 + hole.space + shift :][:size]
                    if hit is None and (kind, sub) in words:
                        hit = words[kind, sub], kind, hole.space + shift + size
        out += [hit[0], hit[1]] if hit else [None, None]
        pos += hit[2] if hit else hole.space + hole.length[1]
    return (pos, *out)


def test_chain_scan_equals_read_by_read(spark):
    rnd = random.Random(3)
    words = {("X", "ACG"): 1, ("X", "TTA"): 2, ("Y", "AC"): 5, ("Y", "CGTA"): 6, ("Z", "GGT"): 9, ("Z", "TT"): 8}
    holes = [B.Hole("h0", ("X", "Y"), laxity=2, length=(2, 4)), B.Hole("h1", ("Z",), space=1, laxity=1, length=(2, 3))]
    seqs = ["".join(rnd.choices("ACGT", k=rnd.randint(0, 14))) for _ in range(150)] + ["AACGTGGT", "ACGTAGGT", ""]
    table = spark.createDataFrame([(k, o, s) for (k, s), o in words.items()], "type string, ord bigint, seq string")
    got = {r.rid: tuple(r)[1:] for r in B.scan_chain(reads(spark, seqs), "rid", "seq", holes, table).collect()}
    assert got == {f"r{i}": scan(s, holes, words) for i, s in enumerate(seqs)}
    names = B.chain_status(B.scan_chain(reads(spark, seqs), "rid", "seq", holes, table), ["h0", "h1"]).collect()
    assert {r["mask"] for r in names} == {0, 1, 2, 3} and sum(r.reads for r in names) == len(seqs)


def test_identifiers(spark):
    df = spark.createDataFrame([("k2",), ("k1",), ("k2",), (None,)], "key string")
    assert {r.key: (r.id, r.n) for r in B.assign_ids(df, "key").collect()} == {"k1": (1, 1), "k2": (2, 2)}
    known = spark.createDataFrame([("k2", 70)], "key string, id bigint")
    assert {r.key: r.id for r in B.assign_ids(df, "key", known).collect()} == {"k2": 70, "k1": 71}
    assert {r.key: r.id for r in B.assign_ids(df, "key", known.limit(0)).collect()} == {"k1": 1, "k2": 2}
    assert B.assign_ids(df.limit(0), "key").collect() == []


def test_dna_and_rna_share_an_id(spark):
    df = spark.createDataFrame([(4, 1, "DPM"), (4, 2, "RPM"), (None, 1, "DPM"), (4, None, None)], "bc bigint, tag bigint, kind string")
    got = df.select(B.identifier_key([("bc", False), ("tag", True)]).alias("k")).collect()
    assert [r.k for r in got] == ["4", "4", None, None]
    t = B.read_types(df, F.coalesce(F.col("kind") == "DPM", F.lit(False)), F.coalesce(F.col("kind") == "RPM", F.lit(False)), F.col("bc").isNotNull() & F.col("tag").isNotNull()).first()
    assert (t.reads, t.full, t.dna, t.rna, t.ndnr, t.dna_full) == (4, 2, 2, 1, 1, 1)


def test_patterns(spark):
    df = spark.createDataFrame([(["A", "B", "C"],), (["B", None, "C"],), ([],), (["C"],)], "t array<string>")
    at = lambda *a: [r[0] for r in df.select(B.matches_at(df.t, *a)).collect()]
    assert at([{"B"}, {"C"}]) == [1, None, None, None] and at([None, {"B", "C"}]) == [0, None, None, None]
    assert at([{"C"}], 0) == [None, None, None, 0] and at([{"C"}]) == [2, 2, None, 0]


def test_random_codes(spark):
    assert {r.code: r.n for r in B.random_codes(reads(spark, ["AC", "AC", "G", None]), "seq", "R").collect()} == {"R:AC": 2, "R:G": 1}


def test_correct_two_substitutions_away(spark):
    wl = spark.createDataFrame([(0, "AAAAAA"), (1, "CCCCCC"), (2, "AACCAA")], "ord bigint, seq string")
    reads = [("exact", "CCCCCC"), ("one", "CCGCCC"), ("two", "CGCCTC"), ("n", "CNCCTC"), ("between", "AACGAA"), ("three", "CGTGCC")]
    df = spark.createDataFrame([(k, s, "!+5?II") for k, s in reads], "rid string, seq string, qual string")
    assert sorted(map(tuple, B.candidates(df.filter("rid in ('two', 'between')"), wl, "rid", "seq", "qual", 2).collect())) == [("between", 0, 20 + 30), ("two", 1, 10 + 40)]
    for mode in ("default", "minq", "rnat", "fcfg"):
        got = {r.rid: (r.ord, r.round) for r in B.correct(df, wl, "rid", "seq", "qual", mode, mismatches=2).collect()}
        assert got == {"exact": (1, 0), "one": (1, 1), "two": (1, 1), "n": (1, 1), "between": (2, 1)}
        assert {r.rid for r in B.correct(df, wl, "rid", "seq", "qual", mode).collect()} == {"exact", "one", "between"}
