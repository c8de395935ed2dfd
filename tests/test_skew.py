"""Keys that hold most rows: counts and joins against plain Python."""

from collections import defaultdict

from strandloom.functions.ids import chromosome_key, group_number
from strandloom.operators.skew import distinct_counts, heavy_values, skew_join

ROWS = [("hot", i % 500) for i in range(3000)] + [(f"k{i}", i) for i in range(400)] + [("k1", 1), ("k1", 1), (None, 5), ("k2", None)]


def expected(rows):
    seen = defaultdict(set)
    for k, v in rows:
        if k is not None and v is not None:
            seen[k].add(v)
    return {k: len(v) for k, v in seen.items()}


def test_counts_hot_and_rare_keys(spark):
    df = spark.createDataFrame(ROWS, "key string, item int").repartition(5)
    for support in (0.5, 0.01, 0.0005):
        assert {r.key: r.n for r in distinct_counts(df, "key", "item", support).collect()} == expected(ROWS)


def test_counts_ignore_extra_columns_with_odd_names(spark):
    df = spark.createDataFrame([(k, v, 1, 2, "x") for k, v in ROWS[-8:]], "key string, item int, n int, _salt int, count string")
    assert {r.key: r.n for r in distinct_counts(df, "key", "item").collect()} == expected(ROWS[-8:])


def test_counts_empty_and_all_null(spark):
    assert distinct_counts(spark.createDataFrame([], "key string, item int"), "key", "item").collect() == []
    assert distinct_counts(spark.createDataFrame([(None, 1), ("a", None)], "key string, item int"), "key", "item").collect() == []


def test_very_long_keys(spark):
    long = "x" * 200_000
    df = spark.createDataFrame([(long, 1), (long, 2), ("", 3)], "key string, item int")
    assert {len(r.key): r.n for r in distinct_counts(df, "key", "item").collect()} == {200_000: 2, 0: 1}


def test_heavy_values_miss_no_heavy_key(spark):
    df = spark.createDataFrame(ROWS, "key string, item int")
    assert "hot" in heavy_values(df, "key", 0.2)
    assert heavy_values(spark.createDataFrame([], "key string"), "key") == []


def test_skew_join_equals_join(spark):
    left = spark.createDataFrame(ROWS, "key string, item int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k9", 4), (None, 5), ("gone", 6)], "key string, item int")
    for how in ("inner", "left"):
        want = sorted(map(str, left.join(right.withColumnRenamed("item", "item_right"), "key", how).collect()))
        for limit in (1000, 1):  # broadcast, and salted where the heavy side is too large
            got = skew_join(left, right, "key", how, support=0.1, max_rows=limit, salts=4)
            assert got.columns == ["key", "item", "item_right"]
            assert sorted(map(str, got.collect())) == want


def test_skew_join_with_empty_sides(spark):
    left, none = spark.createDataFrame([("a", 1)], "key string, x int"), spark.createDataFrame([], "key string, y int")
    assert [tuple(r) for r in skew_join(left, none, "key", "left").collect()] == [("a", 1, None)]
    assert skew_join(left.limit(0), none, "key").collect() == []


def test_ids(spark):
    cases = {" CELL_0012 ": 12, "cell_7": 7, "51": 51, "CELL_000": 0, "\tCELL_3 ": 3, "-": None, "NOT_FOUND": None, "": None, "CELL_": None, "COMPLEX_4": None, "CELL_1x": None, "CELL_99999999999999999999999": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert [r.n for r in df.select(group_number(df.v, "CELL").alias("n")).collect()] == list(cases.values())


def test_chromosomes(spark):
    df = spark.createDataFrame([(" chr4",), ("CHR4",), ("4",), ("chrUn_1",), ("",), (None,)], "v string")
    assert [r.k for r in df.select(chromosome_key(df.v).alias("k")).collect()] == ["4", "4", "4", "un_1", None, None]
