"""Identification by configuration: golden cases, a read-by-read scan, and FASTQ to routes."""

import json
import random

from strandloom.operators.identify import fastq_rows, identify
from strandloom.sources import config, fastq

SCHEMA = "rid string, r1 struct<seq:string,qual:string>, r2 struct<seq:string,qual:string>"


def make(spark, seqs):
    return spark.createDataFrame([(f"r{i}", (a, "I" * len(a)) if a is not None else None, (b, "I" * len(b)) if b is not None else None) for i, (a, b) in enumerate(seqs)], SCHEMA).repartition(3)


TWO_KINDS = config.parse(
    json.dumps(
        {
            "barcode chain": [{"BC-UMI-DPM-GENOMED": "R1:1"}, {"BC-UMI-RPM-GENOMER": "R1:1"}, {"ODD/EVEN-GENOME": "R2:2"}],
            "barcode type": [
                {"BC": {"LENGTH": 4, "MISMATCH": 1, "WHITE LIST": ["AAAA", "CCGG"]}},
                {"UMI": {"LENGTH": 3, "WHITE LIST": ["NNN"]}},
                {"DPM": {"LENGTH": 2, "LAXITY": 1, "WHITE LIST": {"D1": "GT"}}},
                {"RPM": {"LENGTH": 3, "SPACE": 1, "WHITE LIST": {"R1": "TTT"}}},
                {"ODD": {"LENGTH": 4, "WHITE LIST": {"o1": "ACAC"}}},
                {"EVEN": {"LENGTH": "3-4", "LAXITY": 1, "WHITE LIST": {"e1": "GAG", "e2": "GAGT"}}},
                {"GENOME": {"LENGTH": 5}},
            ],
            "identifier": {"CELL": "BC-ANY-DPM/RPM-ODD/EVEN", "BOTH": "1:BC-4:EVEN", "DNA": "DPM", "RNA": "RPM"},
        }
    )
)


def test_golden_cases(spark):
    rows = [
        ("AAAATTTGTACGTACGT", "xACACTTTTTTT"),  # DNA at once, odd
        ("AAATTTTCGTACGT", "xACACGGGG"),  # one mismatch, tag one base on, payload of 4
        ("CCGGACGCTTTAA", "xGAGTCCCCC"),  # no DNA tag: falls back to RNA behind its space; shortest length first
        ("CCGGACGCCCCAA", "xyGAGACCCC"),  # neither: the last kind counts, and isn't full
        ("CC", "x"), (None, None), ("", ""), ("AAAATTTGT", "xACAC"),
    ]
    got = {r.rid: r for r in identify(make(spark, rows), "rid", TWO_KINDS).collect()}
    assert len(got) == 8 and "r5" in got
    a, b, c, d = (got[f"r{i}"] for i in range(4))
    assert (a.label, a.full, a.type, a.route, a.genome) == ("BC:AAAA|UMI:TTT|D1|o1|||CELL_1|NOT_FOUND", True, "DNA", "DNA", "D")
    assert (a.payload_1.seq, a.payload_2.seq, a.payload_2.qual) == ("ACGTACGT", "TTTTT", "IIIII")
    assert (b.codes[0].text, b.codes[2].text, b.payload_1.seq, b.payload_2.seq, b.CELL) == ("BC:AAAA", "D1", "ACGT", "GGGG", a.CELL)
    assert (c.type, c.codes[2].text, c.payload_1.seq, c.codes[3].text, c.payload_2.seq, c.full) == ("RNA", "R1", "AA", "e1", "TCCCC", True) and c.BOTH == 1 and c.CELL not in (None, a.CELL)
    assert (d.genome, d.full, d.route, d.type, d.CELL) == ("R", False, None, "NDNR", None) and d.codes[2].code is None and d.codes[3].text == "e1"
    assert all(not got[f"r{i}"].full and got[f"r{i}"].route is None for i in (4, 5, 6))
    assert got["r7"].full and got["r7"].payload_1 is None
    partial = {r.rid: r.route for r in identify(make(spark, rows), "rid", TWO_KINDS, partial=True).collect()}
    assert partial["r0"] == "DNA_all" and partial["r3"] == "NDNR_all"


def brute(seq, kinds, alternatives):
    """Chain of holes read one by one: (type, text) or None each."""
    pos, out = 0, []
    for names in alternatives:
        hit = None
        for kind in names:
            t = kinds[kind]
            for shift in range(t.laxity + 1):
                for size in range(t.length[0], t.length[1] + 1):
                    sub = seq[pos + t.space + shift : pos + t.space + shift + size]
                    near = [(sum(x != y for x, y in zip(sub, w)), i, n) for i, (n, w) in enumerate(t.whitelist) if len(w) == len(sub) == size]
                    near = [x for x in near if x[0] <= t.mismatch]
                    if hit is None and near and "N" not in sub:
                        hit = (kind, min(near)[2], pos + t.space + shift + size)
        last = kinds[names[-1]]
        pos = hit[2] if hit else pos + last.space + last.length[1]
        out.append(hit[:2] if hit else None)
    return out


def test_scan_against_brute_force(spark):
    rnd = random.Random(12)
    words = lambda n, k: ["".join(rnd.choices("ACGT", k=k)) for _ in range(n)]
    c = config.parse(json.dumps({"barcode chain": [{"A/B-C-B/A": "R1:1"}], "barcode type": [{"A": {"LENGTH": 4, "LAXITY": 2, "MISMATCH": 1, "WHITE LIST": words(5, 4)}}, {"B": {"LENGTH": "3-5", "SPACE": 1, "WHITE LIST": words(3, 3) + words(3, 5)}}, {"C": {"LENGTH": 5, "LAXITY": 1, "WHITE LIST": words(4, 5)}}]}))
    pool = [w for t in c.types.values() for _, w in t.whitelist]
    seqs = ["".join(rnd.choice(["", rnd.choice("ACGTN")]) + rnd.choice(pool) for _ in range(3)) + "ACGT" for _ in range(200)]
    got = {r.rid: [(x.type, x.text) if x.code is not None else None for x in r.codes] for r in identify(make(spark, [(s, None) for s in seqs]), "rid", c).collect()}
    want = {f"r{i}": brute(s, c.types, c.chains[0].holes) for i, s in enumerate(seqs)}
    assert got == want and sum(None not in w for w in want.values()) > 20


def test_dense_types_use_priors_in_the_second_round(spark):
    c = lambda **more: config.parse(json.dumps({"barcode chain": [{"BC-GENOME": "R1:1"}], "barcode type": [{"BC": {"LENGTH": 8, "MISMATCH": 1, "DENSE": 1, "WHITE LIST": ["ACGTACGT", "TTTTCCCC", "ACGTACGA"], **more}}], "identifier": {"CELL": "BC"}}))
    rows = [("ACGTACGAGG", None)] * 60 + [("ACGTACGCGG", None), ("NTTTCCCCGG", None), ("GGGGGGGGGG", None)]
    got = {r.rid: r.codes[0].code for r in identify(make(spark, rows), "rid", c()).collect()}
    assert got["r60"] == "2" and got["r61"] == "1" and got["r62"] is None and got["r0"] == "2"
    by = lambda mode: {r.rid: r.codes[0].code for r in identify(make(spark, rows), "rid", c(), mode).collect()}
    assert by("rnat")["r60"] is None and by("fcfg")["r60"] == "0" and by("minq")["r61"] == "1"
    assert identify(make(spark, rows).limit(0), "rid", c()).collect() == []


def test_random_types_are_codes_of_their_own(spark):
    c = config.parse(json.dumps({"barcode chain": [{"BC-GENOME": "R1:1"}], "barcode type": [{"BC": {"LENGTH": 4, "RANDOM": 1, "WHITE LIST": ["NNNN"]}}], "identifier": {"CELL": "BC"}}))
    got = {r.rid: (r.label, r.CELL) for r in identify(make(spark, [("ACGTGG", None), ("AAAAGG", None), ("ACGTCC", None), ("ANAAGG", None)]), "rid", c).collect()}
    assert got == {"r0": ("BC:ACGT|||CELL_2", 2), "r1": ("BC:AAAA|||CELL_1", 1), "r2": ("BC:ACGT|||CELL_2", 2), "r3": ("NOT_FOUND|||NOT_FOUND", None)}


def test_fastq_to_routes(spark, tmp_path):
    given = [("a", "AAAATTTGTACGTACGT", "xACACTTTTTTT"), ("b", "CCGGACGCTTTAA", "xGAGTCCCCC"), ("c", "CCGGACGCCCCAA", "xyGAGACCCC")]
    for m in (1, 2):
        (tmp_path / f"m{m}.fq").write_text("".join(f"@{n} {m}:N\n{s[m]}\n+\n{'I' * len(s[m])}\n" for n, *_ in given for s in given if s[0] == n))
    mates = fastq.scan_mates(spark, [[str(tmp_path / f"m{m}.fq")] for m in (1, 2)]).withColumn("key", fastq.F.concat_ws("-", "lane", "idx"))
    found = identify(mates, "key", TWO_KINDS)
    rows = fastq_rows(found, mates.select("key", "r1.name"), "key")
    fastq.sink(rows, str(tmp_path / "out"), ["route", "mate"])
    read = lambda route, mate: "".join(p.read_text() for p in (tmp_path / "out" / f"route={route}" / f"mate={mate}").glob("part*"))
    assert read("DNA", 1) == "@a|||BC:AAAA|UMI:TTT|D1|o1|||CELL_1|NOT_FOUND\nACGTACGT\n+\nIIIIIIII\n" and read("RNA", 2).split("\n")[1] == "TCCCC"
    assert sorted(p.name for p in (tmp_path / "out").glob("route=*")) == ["route=DNA", "route=RNA"]


def _written(monkeypatch):
    """Names and rows of what identify writes, as it goes."""
    from strandloom.operators import identify as module
    from strandloom.storage import materialise

    names = {}

    def kept(df, name):
        out = materialise(df, name)
        names[name] = max(names.get(name, 0), out.count())
        return out

    monkeypatch.setattr(module, "materialise", kept)
    return names


def _plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_sparse_reads_are_neither_shuffled_nor_written(spark, monkeypatch):
    """a read stays one row. Large whitelists (here: any) are expanded only to what the reads have; with row lookups off the result is the same."""
    from strandloom.operators import identify as module

    rng = random.Random(4)
    seqs = [("".join(rng.choice("ACGTN" if rng.random() < 0.1 else "ACG") for _ in range(12)).replace("CCC", "GTA"), "x" + rng.choice(["ACAC", "GAG", "GAGT", "TTTT"]) + "ACGTA"[: rng.randrange(6)]) for _ in range(200)]
    seqs = [(rng.choice(["AAAA", "CCGG", "CCGA", "AATA", "TTTT"]) + a, b) for a, b in seqs] + [(None, None), ("", "")]
    found = []
    for rows, tries in ((200_000, 32), (1, 32), (200_000, 0)):
        monkeypatch.setattr(module, "BROADCAST_ROWS", rows)
        monkeypatch.setattr(module, "MOST_TRIES", tries)
        names = _written(monkeypatch)
        out = identify(make(spark, seqs), "rid", TWO_KINDS)
        found.append(sorted(map(repr, out.collect())))
        if tries:
            assert "Exchange hashpartitioning" not in _plan(out) and {*names} <= {"words", "seen", "keys", "ids"} and ("seen" in names) == (rows == 1)
        monkeypatch.undo()
    assert len(found[0]) == 202 and found[0] == found[1] == found[2]


def test_fallback_query_writes_no_reads(spark, monkeypatch):
    """barcode_genome_fallback numbers no identifiers and writes whitelists only."""
    from strandloom.plans.barcode_queries import barcode_genome_fallback

    names = _written(monkeypatch)
    out = barcode_genome_fallback(spark, "/root/testdata/sf0.001")
    assert {*names} <= {"words", "seen"} and "rid" in out.columns


def _lean(spark, monkeypatch, name, most):
    """Runs the query and asserts that nothing it wrote has a row per read."""
    from strandloom.plans import barcode_queries

    names = _written(monkeypatch)
    out = barcode_queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert {*names} <= {"words", "seen", "keys", "ids"} and names.get("keys", 0) <= most
    return out


def test_route_all_writes_no_reads(spark, monkeypatch):
    """F2"""
    out = _lean(spark, monkeypatch, "identifier_route_all", 2000)
    assert {r.route for r in out} <= {"DNA_all", "RNA_all", "NDNR_all"} and sum(r.n for r in out) > 100


def test_capture_writes_no_reads(spark, monkeypatch):
    """without identifiers, not even their keys."""
    assert _lean(spark, monkeypatch, "barcode_capture", 0)


def test_route_writes_no_reads(spark, monkeypatch):
    """F6"""
    assert any(r.cell for r in _lean(spark, monkeypatch, "identifier_route", 2000))


def _compiled(spark, name, joins):
    """Whether Spark compiles the whole query, with `joins` lookups in a read's row, in methods that are each short enough for the JVM."""
    from strandloom.plans import barcode_queries

    plan = _plan(barcode_queries.QUERIES[name](spark, "/root/testdata/sf0.001"))
    return "lambdafunction" not in plan and plan.count("BroadcastHashJoin") == joins and plan.count("Coalesce ") >= 4


def test_route_all_is_compiled(spark):
    """no functions of elements; BC is looked up once for both chains. Joins: the simulated barcode, BC, DPM, RPM and the ids."""
    assert _compiled(spark, "identifier_route_all", 5)


def test_capture_is_compiled(spark):
    """F4"""
    assert _compiled(spark, "barcode_capture", 4)


def test_route_is_compiled(spark):
    """F6"""
    assert _compiled(spark, "identifier_route", 5)
