"""Periods and gaps against a base-by-base count."""

import random

from strandloom.operators.cluster import merge, merge_with
from strandloom.operators.genomic import coverage, overlaps, peaks, without_overlap
from strandloom.operators.sweep import sweep


def brute(rows):
    out, groups = set(), {}
    for g, a, b in rows:
        if g is None or a is None or b is None or a == b:
            continue
        groups.setdefault(g, set()).update(range(min(a, b), max(a, b)))
    for g, bases in groups.items():
        at, kind = None, None
        first, last = min(bases), max(bases)
        for p in range(first, last + 2):
            now = "period" if p in bases else "gap"
            if now != kind or p == last + 1:
                if kind:
                    out.add((g, kind, at, p))
                at, kind = p, now
    return out


def cases(seed):
    rnd = random.Random(seed)
    rows = [("hot", s, s + rnd.randint(0, 9)) for s in (rnd.randint(-60, 400) for _ in range(120))]
    rows += [(f"g{rnd.randint(0, 9)}", *(rnd.randint(0, 60) for _ in range(2))) for _ in range(60)]
    return rows + rows[:10] + [(None, 1, 5), ("g1", None, 4), ("g1", 4, None), ("solo", 7, 7)]


def got(df, **more):
    return {tuple(r) for r in sweep(df, ["g"], "a", "b", **more).collect()}


def test_sweep_light_and_blocked(spark):
    rows = cases(1)
    df = spark.createDataFrame(rows, "g string, a bigint, b bigint").repartition(3)
    want = brute(rows)
    assert got(df, support=0.9) == want
    assert got(df, support=0.2, block=16) == want  # hot is swept in blocks
    assert got(df, support=0.002, block=7) == want  # every group is


def test_block_without_any_edge(spark):
    rows = [("a", 0, 1000), ("a", 10, 20), ("a", 1500, 1501)]
    df = spark.createDataFrame(rows, "g string, a bigint, b bigint")
    assert got(df, support=0.1, block=8) == {("a", "period", 0, 1000), ("a", "gap", 1000, 1500), ("a", "period", 1500, 1501)}


def test_touching_nested_reversed(spark):
    rows = [("a", 1, 5), ("a", 5, 9), ("a", 8, 2), ("b", 20, 10), ("b", 12, 13)]
    assert got(spark.createDataFrame(rows, "g string, a bigint, b bigint")) == {("a", "period", 1, 9), ("b", "period", 10, 20)}


def test_empty_and_clashing_columns(spark):
    assert got(spark.createDataFrame([], "g string, a bigint, b bigint")) == set()
    df = spark.createDataFrame([("x", 1, 3, 9, 9, "q"), ("x", 5, 6, 9, 9, "q")], "g string, a bigint, b bigint, _pos int, _lo int, kind string")
    assert got(df) == {("x", "period", 1, 3), ("x", "gap", 3, 5), ("x", "period", 5, 6)}


def test_merge_golden(spark):
    rows = [("g", "chr1", 100, 110, "p"), ("g", "chr1", 113, 120, "q"), ("g", "chr1", 124, 130, "r"), ("g", "chr2", 5, 5, "s"), ("g", "chr1", 101, 103, "t")]
    df = spark.createDataFrame(rows, "gid string, chr string, start_pos bigint, end_pos bigint, x string")
    # a gap of exactly 3 merges, one of 4 does not; the nested one does not shorten; empty ones count
    want = {("g", "chr1", 100, 120), ("g", "chr1", 124, 130), ("g", "chr2", 5, 5)}
    assert {tuple(r) for r in merge(df, ["gid"], distance=3).collect()} == want
    with_values = {tuple(r) for r in merge_with(df, ["gid"], "x", distance=3).collect()}
    assert with_values == {("g", "chr1", 100, 120, "p;t;q"), ("g", "chr1", 124, 130, "r"), ("g", "chr2", 5, 5, "s")}
    assert {tuple(r) for r in merge(df, ["gid"], extend=4, min_length=7).collect()} == {("g", "chr1", 100, 124)}


def test_coverage_integral_and_blocks(spark):
    rnd = random.Random(3)
    rows = [("c%d" % rnd.randint(1, 2), s, s + rnd.randint(0, 30)) for s in (rnd.randint(0, 300) for _ in range(80))]
    df = spark.createDataFrame(rows, "chr string, start_pos bigint, end_pos bigint")
    depth = {}
    for c, a, b in rows:
        for p in range(a, b):
            depth[c, p] = depth.get((c, p), 0) + 1
    for block in (1 << 20, 16):
        runs = coverage(df, block=block).collect()
        assert {(r.chr, p): r.depth for r in runs for p in range(r.start_pos, r.end_pos)} == depth
    assert coverage(df.limit(0)).collect() == []


def test_peaks_gap_and_length(spark):
    runs = spark.createDataFrame([("c", 0, 50, 6), ("c", 50, 80, 2), ("c", 80, 100, 9), ("c", 200, 210, 7)], "chr string, start_pos bigint, end_pos bigint, depth bigint")
    assert [tuple(r) for r in peaks(runs, cutoff=5, min_length=60, max_gap=30).collect()] == [("c", 0, 100, 9)]
    assert peaks(runs, cutoff=5, min_length=60, max_gap=29).collect() == []


def test_peaks_over_blocks(spark):
    rnd, rows, at = random.Random(6), [], {"c1": 0, "c2": 0}
    for _ in range(300):
        c = rnd.choice(["c1", "c2"])
        start = at[c] + rnd.randint(0, 12)
        at[c] = start + rnd.randint(1, 9)
        rows.append((c, start, at[c], rnd.randint(1, 9)))
    want = []
    for c, a, b, d in sorted(rows):
        if d >= 4:
            if want and want[-1][0] == c and a - want[-1][2] <= 10:
                want[-1][2:] = [b, max(d, want[-1][3])]
            else:
                want.append([c, a, b, d])
    want = {tuple(w) for w in want if w[2] - w[1] >= 15}
    runs = spark.createDataFrame(rows, "chr string, start_pos bigint, end_pos bigint, depth bigint").repartition(3)
    for block in (8, 64, 1 << 20):
        assert {tuple(r) for r in peaks(runs, cutoff=4, min_length=15, max_gap=10, block=block).collect()} == want


def test_overlaps_once_per_pair(spark):
    rnd = random.Random(5)
    make = lambda n: [(i, "c%d" % rnd.randint(1, 2), s, s + rnd.randint(0, 40)) for i, s in enumerate(rnd.randint(0, 200) for _ in range(n))]
    a, b = make(40), make(30)
    schema = "id bigint, chr string, start_pos bigint, end_pos bigint"
    da, db = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3] and x[2] < x[3] and y[2] < y[3])
    assert sorted((r.id, r.id_b) for r in overlaps(da, db, width=16).collect()) == want
    free = {x[0] for x in a} - {i for i, _ in want}
    assert {r.id for r in without_overlap(da, db, "id", width=16).collect()} == free
