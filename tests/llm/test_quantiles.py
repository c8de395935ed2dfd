import numpy as np
from pyspark.sql import functions as F

from strandloom.llm import quantiles as S


def test_code_keeps_order_and_bounds():
    values = np.array(sorted({0, 1, -1, 2, 65535, 65536, 65537, 10**9, -(10**9), 2**62, 2**63 - 1, -(2**63), *np.random.default_rng(1).integers(-(2**62), 2**62, 300)}), np.int64)
    codes = S.encode(values)
    assert (np.diff(codes) >= 0).all() and codes.min() >= 0 and codes.max() < 1 << S.BITS
    for v, c in zip(values.tolist(), codes.tolist()):
        low, high = S.decode(c)
        assert low <= v <= high and high - low <= abs(v) / 2**S.MANTISSA + 1
    small = np.arange(-65536, 65536)
    assert all(S.decode(int(c)) == (v, v) for v, c in zip(small[::999].tolist(), S.encode(small)[::999]))


def share(x, low, high):
    return np.searchsorted(x, low) / len(x), np.searchsorted(x, high, "right") / len(x)


def test_rank_error_of_sketches(spark):
    rng = np.random.default_rng(5)
    for x in (rng.lognormal(6, 2, 120_000).astype(np.int64), rng.integers(0, 2 * 10**8, 120_000), np.repeat(rng.integers(0, 500, 40), 3000)):
        df = spark.createDataFrame([(int(v),) for v in x], "v bigint").repartition(6)
        x = np.sort(x)
        for r in S.percentiles(df, [], "v", [0.01, 0.25, 0.5, 0.9, 0.99]).collect():
            below, upto = share(x, r.low, r.high)
            assert below - S.RANK_ERROR <= r.q <= upto + S.RANK_ERROR and r.n == len(x)


def test_small_groups_are_exact(spark):
    rows = [("a", 5), ("a", 1), ("a", 9), ("b", -3), ("b", None), (None, 4), (None, 4)]
    got = {(r.g, r.q): (r.n, r.low, r.high) for r in S.percentiles(spark.createDataFrame(rows, "g string, v bigint"), ["g"], "v", [0.0, 0.5, 1.0]).collect()}
    assert got == {("a", 0.0): (3, 1, 1), ("a", 0.5): (3, 5, 5), ("a", 1.0): (3, 9, 9), **{("b", q): (1, -3, -3) for q in (0.0, 0.5, 1.0)}, **{(None, q): (2, 4, 4) for q in (0.0, 0.5, 1.0)}}


def test_days_merge_and_rows_can_be_deleted(spark):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 10**6, 60_000)
    df = spark.createDataFrame([(int(v), i % 3, 1) for i, v in enumerate(x)], "v bigint, day int, w int").repartition(4)
    gone = df.filter("day = 2").withColumn("w", F.lit(-1))
    parts = S.merge(S.build(df.unionByName(gone), ["day"], "v", "w"), 64)
    total = S.merge(S.regroup(parts, "day int", []), 1)
    left = np.sort(np.concatenate([x[0::3], x[1::3]]))
    r = S.ranks(total, [0.5]).first()
    below, upto = share(left, r.low, r.high)
    assert r.n == len(left) and below - S.RANK_ERROR <= 0.5 <= upto + S.RANK_ERROR


def test_empty_text_and_clashing_columns(spark):
    assert S.percentiles(spark.createDataFrame([], "g string, v bigint"), ["g"], "v", [0.5]).collect() == []
    df = spark.createDataFrame([("a", "7", 1, 1.0), ("a", "x", 1, 1.0), ("a", "", 2, 2.0)], "g string, v string, node int, sketch double")
    assert [(r.g, r.n, r.low) for r in S.percentiles(df, ["g"], "v", [0.5]).collect()] == [("a", 1, 7)]


def test_medians_of_wrong_brackets(spark):
    from strandloom.llm.queries import medians

    values = spark.createDataFrame([("a", v) for v in (1, 2, 3, 10)] + [("b", 5), ("c", 2), ("c", 2), ("c", 9)], "lib string, n_umi bigint")
    brackets = spark.createDataFrame([("a", 100, 200), ("b", 5, 5), ("c", 0, 3)], "lib string, low bigint, high bigint")
    assert {r.lib: (r.n, r.median) for r in medians(values, "lib", "n_umi", brackets).collect()} == {"a": (4, 2.5), "b": (1, 5.0), "c": (3, 2.0)}
