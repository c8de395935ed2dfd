"""Loop spans and densities against brute force in numpy."""

import math

import numpy as np

from strandloom.operators.density import density, density_mode, group_loop_spans, loop_spans


def brute(values, at, bandwidth):
    z = (np.asarray(at)[:, None] - np.asarray(values)[None, :]) / bandwidth
    return np.exp(-z * z / 2).sum(axis=1) / (len(values) * bandwidth * math.sqrt(2 * math.pi))


def test_density_is_that_of_every_value(spark):
    rng = np.random.default_rng(3)
    values = {"a": np.concatenate([rng.normal(0, 1, 300), rng.normal(6, 0.5, 200)]), "b": rng.normal(2, 2, 100)}
    rows = [(k, float(v), 1) for k, vs in values.items() for v in vs] + [(None, 1.0, 1), ("a", None, 1), ("b", float("nan"), 1)]
    df = spark.createDataFrame(rows, "k string, v double, density int").repartition(3)
    got = density(df, "v", "k", points=400, bandwidth=0.4).toPandas()
    assert sorted(got["k"].unique()) == ["a", "b"] and len(got) == 800
    for k, vs in values.items():
        part = got[got["k"] == k].sort_values("x")
        assert np.allclose(part["x"].iloc[[0, -1]], [vs.min() - 1.2, vs.max() + 1.2])
        assert np.abs(part["density"] - brute(vs, part["x"], 0.4)).max() < 1e-3
    modes = {r.k: r.mode for r in density_mode(density(df, "v", "k"), "k").collect()}
    assert abs(modes["a"]) < 0.7 or abs(modes["a"] - 6) < 0.4


def test_density_of_one_class_ties_and_nothing(spark):
    same = spark.createDataFrame([(5.0,)] * 40, "v double")
    out = density(same, "v", points=101)
    assert out.columns == ["x", "density"] and out.count() == 101
    assert abs(density_mode(out).first()["mode"] - 5.0) < 1e-6
    assert density(same.limit(0), "v").count() == 0
    one = density(spark.createDataFrame([(2.0,)], "v double"), "v", points=51, bandwidth=1.0).toPandas().sort_values("x")
    assert np.allclose(one["density"], brute([2.0], one["x"], 1.0), atol=1e-7)


def test_loop_spans(spark):
    rows = [("chr1", 0, 11, 100, 110), ("chr1", 2, 12, 100, 111), ("chr1", 0, 10, 5, 15), ("chr2", 0, 10, 0, 10), ("chr2", None, 10, 0, 10)]
    df = spark.createDataFrame(rows, "chr string, start_1 bigint, end_1 bigint, start_2 bigint, end_2 bigint")
    got = {(r.chr, r.bin_1, r.bin_2): (r.pets, r.span, r.log_span) for r in loop_spans(df, anchor=50).collect()}
    assert got == {("chr1", 0, 2): (2, 99, math.log10(99)), ("chr1", 0, 0): (1, 5, math.log10(5)), ("chr2", 0, 0): (1, 0, None)}
    assert loop_spans(df.limit(0)).count() == 0


def test_places_out_of_reach_have_density_zero(spark):
    df = spark.createDataFrame([(0.0,), (100.0,)], "v double")
    rows = density(df, "v", points=51, bandwidth=1.0).orderBy("x").collect()
    assert len(rows) == 51 and rows[25].density == 0.0


def test_group_loop_spans_shuffle_no_pairs(spark, monkeypatch):
    """pairs of bins are made in the task that sums them up; what is sent is the bins of a group, in the bands where it has some."""
    from strandloom.operators import genomic as G

    monkeypatch.setattr(G, "SLICE", 1000)
    own = [("g", "chr1", 50_000 * i, 50_000 * i + 10 + k) for i in range(400) for k in range(2)] + [("h", "chr1", 50_000 * i, 50_000 * i + 30) for i in range(0, 400, 2)]
    df = spark.createDataFrame(own, "gid string, chr string, start_pos bigint, end_pos bigint")
    out = group_loop_spans(df, ["gid"], 50_000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "MapInArrow" in plan
    got = {(r.bin_1, r.bin_2): (r.pets, r.span) for r in out.collect()}
    assert len(got) == 400 * 401 // 2 and got[0, 0] == (1, 0) and got[0, 1] == (4, 50_000) and got[0, 2] == (5, 100_000) and got[399, 399][0] == 1
