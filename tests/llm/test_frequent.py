from collections import Counter

from strandloom.llm.frequent import frequent, summary

ROWS = [(f"v{i % 7}" if i % 3 else f"rare{i}",) for i in range(2000)] + [(None,)] * 50 + [("",)] * 60 + [("-",)] * 55 + [("x" * 50_000,)] * 52


def make(spark, rows=ROWS, parts=40):
    return spark.createDataFrame(rows, "v string").repartition(parts)


def test_exact_counts_over_many_partitions(spark):
    total, counts = len(ROWS), Counter(v for (v,) in ROWS if v is not None)
    want = {v: n for v, n in counts.items() if n * 50 >= total}
    found = frequent(make(spark), {"k": "v"}, 50, counters=60).collect()
    assert {r.value: r.n for r in found} == want and "" in want and "-" in want
    assert all(r.low <= r.n <= r.high for r in found)


def test_bounds_hold_with_few_counters(spark):
    counts = Counter(v for (v,) in ROWS if v is not None)
    rows = summary(make(spark), {"k": "v"}, 20).collect()
    assert len(rows) <= 20
    for r in rows:
        assert r.low <= counts[r.value] <= r.high and r.high - r.low <= len(ROWS) / 21
    missing = max(n for v, n in counts.items() if v not in {r.value for r in rows})
    assert missing <= len(ROWS) / 21


def test_two_columns_with_clashing_names(spark):
    df = spark.createDataFrame([("a", "b", 1, 2)] * 5 + [("c", None, 1, 2)], "value string, kind string, node int, low int")
    assert sorted((r.kind, r.value, r.n) for r in frequent(df, {"one": "value", "two": "kind"}, 2).collect()) == [("one", "a", 5), ("two", "b", 5)]


def test_empty_and_null(spark):
    assert frequent(make(spark, [], 1), {"k": "v"}, 10).collect() == []
    assert frequent(make(spark, [(None,)] * 4, 2), {"k": "v"}, 10).collect() == []


def test_ties_all_come_out(spark):
    rows = [(f"t{i}",) for i in range(10)] * 3
    assert len(frequent(make(spark, rows, 5), {"k": "v"}, 10).collect()) == 10


def test_deduction_of_a_summary_without_values(spark):
    """v stands 99 times in one partition and once in the other, whose values are all distinct."""
    common = [(0, "v")] * 99 + [(0, f"w{i % 10}") for i in range(19_901)]
    distinct = [(1, "v")] + [(1, f"d{i}") for i in range(19_999)]
    df = spark.createDataFrame(common + distinct, "part int, v string").repartitionByRange(2, "part")
    found = {r.value: (r.n, r.low, r.high) for r in frequent(df.select("v"), {"k": "v"}, 400, counters=4000).collect()}
    assert sorted(found) == ["v", *sorted(f"w{i}" for i in range(10))] and found["v"][0] == 100
    assert all(low <= n <= high for n, low, high in found.values())


def test_deduction_of_an_emptied_merge(spark):
    """The leaves of the first merge keep all their values, the merge drops them all; v stands once there and 63 times elsewhere."""
    df = spark.range(0, 6400, 1, 64).selectExpr("case when id = 0 or id between 3200 and 3262 then 'v' when id < 3200 then concat('d', id) else concat('w', id % 31) end v")
    found = {r.value: r.n for r in frequent(df, {"k": "v"}, 100, counters=100).collect()}
    assert found["v"] == 64 and len(found) == 32
