"""Golden cases of the cluster operators."""

import random
from collections import Counter
from itertools import combinations

import pytest

from strandloom.operators import cluster as C
from strandloom.operators.ranks import following, numbered

SCHEMA = "gid string, idx bigint, chr string, start_pos bigint, end_pos bigint"
ROWS = [("a", 5, "chr2", 10, 20), ("a", 1, "chr1", 10, 20), ("a", 3, "chr1", 10, 25), ("a", 2, "chr2", 10, 20), ("a", 4, "chr1", 10, 20), ("b", 9, "chr3", 7, 9)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_dedup_start_against_start_and_end(df):
    assert rows(C.dedup(df, ["gid"], ["chr", "start_pos"])) == [("a", "chr1", 10, 1, 20, 3), ("a", "chr2", 10, 2, 20, 2), ("b", "chr3", 7, 9, 9, 1)]
    by_both = C.dedup(df, ["gid"], C.FRAGMENT)
    assert sorted((r.idx, r.dup) for r in by_both.collect()) == [(1, 2), (2, 2), (3, 1), (9, 1)]
    assert C.duplicate_stats(by_both).first().asDict() == {"duplicates": 2, "total_fragments": 6}
    again = C.dedup(by_both.drop("dup"), ["gid"], C.FRAGMENT)
    assert again.filter("dup > 1").count() == 0 and again.count() == by_both.count()


def test_empty_groups(df):
    none = df.limit(0)
    assert C.duplicate_stats(C.dedup(none, ["gid"], C.FRAGMENT)).first().asDict() == {"duplicates": 0, "total_fragments": 0}
    assert C.count_histogram(none, "gid").agg({"groups": "sum"}).first()[0] == 0
    assert C.split_by_chromosome(none, "gid").collect() == []


def test_split_by_first_appearance(df):
    named = {(r.gid, r.chr): r.sub_id for r in C.split_by_chromosome(df, "gid").collect()}
    assert named == {("a", "chr1"): "a-0", ("a", "chr2"): "a-1", ("b", "chr3"): "b-0"}


def test_inline_and_back(df):
    assert {r.gid: r.n for r in C.group(df, ["gid"]).collect()} == {"a": 5, "b": 1}
    lines = {r.gid: r.line for r in C.inline_text(df, ["gid"]).collect()}
    assert lines["b"] == "b\t1\tchr3\t7\t9" and lines["a"].startswith("a\t5\tchr1\t10\t20\tchr2\t10\t20\tchr1\t10\t25")
    parts = {(r.gid, r.part): r.line for r in C.inline_text(df, ["gid"], per_line=2).collect()}
    assert sorted(parts) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)] and parts["a", 0] == "a\t2\tchr1\t10\t20\tchr2\t10\t20" and parts["a", 2].startswith("a\t1\t")
    bed = C.to_bed(df, ["gid"]).collect()
    assert len(bed) == 6 and {(r.name, r.i) for r in bed} == {("a", i) for i in range(5)} | {("b", 0)}


def test_numbers_over_blocks(spark):
    data = [("g", i * 37 % 101, i) for i in range(101)] + [(None, 3, 1), (None, None, 2)]
    df = spark.createDataFrame(data, "k string, o bigint, v int").repartition(4)
    for block in (5, 1 << 20):
        got = {(r.k, r.o): (r.i, r.n) for r in numbered(df, ["k"], "o", block).collect()}
        assert got == {**{("g", o): (o, 101) for o in range(101)}, (None, None): (0, 2), (None, 3): (1, 2)}


def test_next_and_negative_distances(df):
    got = sorted((r.gid, r.i, r.dist) for r in C.next_distances(df, "gid").collect())
    assert got == [("a", 0, -10), ("a", 1, -10), ("a", 2, -15), ("a", 3, -10)]
    assert following(df, ["gid"], "idx", ["chr"]).filter("gid = 'b'").count() == 0


def test_pairs_within_reach(spark):
    data = [("g", i, "chr1", s, s + 5) for i, s in enumerate([0, 3, 100, 104, 205, 3])] + [("g", 9, "chr2", 3, 8), ("h", 10, "chr1", 3, 8)]
    got = sorted((r.gid, r.start_1, r.start_2, r.dist) for r in C.pairs_within(spark.createDataFrame(data, SCHEMA), ["gid"], 101).collect())
    starts = [(0, 0), (3, 1), (100, 2), (104, 3), (205, 4), (3, 5)]
    want = sorted(("g", a[0], b[0], b[0] - a[0] - 5) for a in starts for b in starts if a < b and b[0] - a[0] <= 101)
    assert got == want


def test_juice_strips_letters(spark):
    pairs = spark.createDataFrame([("chrUn_1", 1, 4, 10, 13), ("chr7", 0, 1, 2, 3)], "chr string, start_1 bigint, end_1 bigint, start_2 bigint, end_2 bigint")
    assert rows(C.juice(pairs)) == [("7", 0, "7", 2), ("Un_1", 2, "Un_1", 11)]


def test_histogram_spans_and_names(df):
    histogram = {r["class"]: r.groups for r in C.count_histogram(df, "gid", 3).collect()}
    assert histogram == {"F = 1": 1, "F = 2": 0, "F = 3": 0, "F > 3": 1}
    assert {(r.gid, r.chr): r.span for r in C.spans(df, ["gid", "chr"]).collect()} == {("a", "chr1"): 15, ("a", "chr2"): 10, ("b", "chr3"): 2}
    assert {r.name for r in C.lengths(df, "gid").collect()} == {f"a-5-{i}" for i in range(5)} | {"b-1-0"}
    assert C.hierarchy(df, "chr", "gid").filter("gid = 'a'").first().chr == "chr1"


def test_mask_and_union(spark):
    df = spark.createDataFrame([("chr1",), ("chrM",), ("chrUn_2",), ("chr2Het",), (None,)], "chr string")
    assert [r.chr for r in C.without_names(df, "chr").collect()] == ["chr1"]
    both = C.labelled_union({"DNA": df.limit(2), "RNA": df.limit(1)})
    assert sorted(r.type for r in both.collect()) == ["DNA", "DNA", "RNA"]


def test_group_contacts_know_no_reach(spark, monkeypatch):
    from strandloom.operators import genomic as G

    monkeypatch.setattr(G, "SLICE", 3)
    rnd = random.Random(4)
    data = [(rnd.choice("gh"), 0, rnd.choice(("chr1", "chr2")), s, s + rnd.randint(0, 900)) for s in (rnd.choice((rnd.randint(0, 3000), rnd.randint(0, 90_000_000))) for _ in range(80))]
    data += [("g", 0, "chr1", 5, 9)] * 2
    want = Counter()
    spans = {}
    for a, b in combinations(data, 2):
        if a[0] == b[0] and a[2] == b[2]:
            m = sorted((a[3] + a[4], b[3] + b[4]))
            for r in (1000, 2500, 5000, 1_000_000):
                want[r, a[2][3:], m[0] // 2 // r, a[2][3:], m[1] // 2 // r] += 1
            at = (a[2], m[0] // 2 // 5000, m[1] // 2 // 5000)
            spans[at] = max(spans.get(at, 0), (m[1] - m[0]) // 2)
    df = spark.createDataFrame(data, SCHEMA)
    got = rows(G.group_contacts(df, ["gid"], [5000, 1000, 2500, 1_000_000]))
    assert {tuple(r)[:5]: tuple(r)[5] for r in got} == want and len(got) == len(want)
    assert {(r.chr, r.bin_1, r.bin_2): r.span for r in G.group_bins(df, ["gid"], 5000).collect()} == spans and max(spans.values()) > 10_000_000
    assert rows(G.group_contacts(df.limit(0), ["gid"], [1000])) == []


def test_group_contacts_write_groups_only(spark, monkeypatch):
    """all resolutions come out of one pass; what is written is the bins of the groups, however many pairs they have."""
    from strandloom import storage
    from strandloom.operators import genomic as G

    real, written = storage.materialise, []

    def kept(df, name):
        out = real(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(storage, "materialise", kept)
    data = [("g", i, c, 7_000 * i, 7_000 * i + 10) for i in range(300) for c in ("chr1", "1", "chr2")] + [("h", 0, "chr2", 5, 9)]
    got = G.group_contacts(spark.createDataFrame(data, SCHEMA), ["gid"], [1000, 2_500_000, 1_000_000]).collect()
    n = Counter()
    for r in got:
        n[r.resolution, r.chr_1] += r.n
    assert written == [("groups", 3)] and len({tuple(r)[:5] for r in got}) == len(got)
    assert n == {(r, c): k * 300 * 299 // 2 for r in (1000, 1_000_000, 2_500_000) for c, k in (("1", 2), ("2", 1))}


def test_contact_bins_shuffle_fragments_once(spark, monkeypatch):
    """fragments are shuffled once, by complex and chromosome; of a group's bins only bin and count are written and sent to the bands."""
    from strandloom import storage
    from strandloom.operators import genomic as G
    from strandloom.plans import cluster_queries as Q

    real, written = storage.materialise, []

    def kept(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        written.append((df.columns, sum("Exchange hashpartitioning(lib" in x and "chr" in x for x in plan.splitlines()), sum("Exchange hashpartitioning(" in x and "start_pos" in x or "Exchange hashpartitioning(gid" in x for x in plan.splitlines())))
        return real(df, name)

    monkeypatch.setattr(storage, "materialise", kept)
    d = "/root/testdata/sf0.001"
    got = Q.contact_bins_all(spark, d)
    assert written == [(["chr", "bin", "n"], 1, 0)]
    apart = G.group_contacts(Q.frags(spark, d), ["gid"], Q.RESOLUTIONS)
    assert got.count() > 10_000 and got.exceptAll(apart).isEmpty() and apart.exceptAll(got).isEmpty()
    again = spark.createDataFrame([("a/1", "2", "chr1", 10, 20), ("a", "1", "chr1", 10, 20), ("a", "1", "chr1", 30, 40)], "lib string, complex string, chr string, start_pos bigint, end_pos bigint")
    assert [tuple(r) for r in G.group_contacts(again.coalesce(1), ["lib", "complex"], [1000], placed=True).collect()] == [(1000, "1", 0, "1", 0, 1)]
