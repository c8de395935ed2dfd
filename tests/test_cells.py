import math
import random
from itertools import product

import pytest

from strandloom.operators import cells as X
from strandloom.plans import cell_queries as Q


def test_matrix_ids_and_dims(spark):
    rows = [("c", 0, 5, "x", 2), ("c", 0, 5, "y", 1), ("c", 9, 12, "x", 4), ("d", 1, 2, "z", 1)]
    counts = spark.createDataFrame(rows, "chr string, start_pos bigint, end_pos bigint, cell string, n bigint")
    entries, peaks, cells = X.matrix(counts)
    assert sorted(map(tuple, entries.collect())) == [(1, 1, 2), (1, 2, 1), (2, 1, 4), (3, 3, 1)]
    assert sorted(r.i for r in peaks.collect()) == [1, 2, 3] and {r.cell: r.j for r in cells.collect()} == {"x": 1, "y": 2, "z": 3}
    assert X.matrix_dims(counts).first().asDict() == {"peaks": 3, "cells": 3, "nnz": 4}
    only = X.filtered(counts, spark.createDataFrame([("z",), ("nobody",)], "cell string"))
    assert [tuple(r) for r in X.matrix(only)[0].collect()] == [(1, 1, 1)]
    assert X.matrix(counts.limit(0))[0].collect() == []


def test_ids_over_many_ranges(spark):
    df = spark.range(500).select((X.F.col("id") * 7 % 500).alias("k")).repartition(6)
    assert all(r.k + 1 == r.i for r in X._ids(df, ["k"], "i").collect())


def test_doublets_against_brute_force(spark):
    rnd = random.Random(6)
    rows = [(rnd.randint(1, 6), "c", s, s + rnd.randint(1, 4)) for s in (rnd.randint(0, 12) for _ in range(40))] + [(7, "d", 900, 901)]
    df = spark.createDataFrame(rows, "cell bigint, chr string, start_pos bigint, end_pos bigint")
    cells = sorted({r[0] for r in rows})
    starts, ends = ({c: {(r[1], r[i]) for r in rows if r[0] == c} for c in cells} for i in (2, 3))
    sim = {(a, b): len(starts[a] & ends[b]) + len(starts[b] & ends[a]) for a, b in product(cells, cells)}
    assert {(r.a, r.b): r.n for r in X.similarity(df).collect()} == {k: v for k, v in sim.items() if v}
    kept = {a for a in cells if max(cells, key=lambda b: (sim[a, b], -b)) == a}
    assert {r.cell for r in X.keep_singlets(df).collect()} == kept and 7 not in kept


def test_first_cell_without_meetings_stays(spark):
    df = spark.createDataFrame([(1, "c", 0, 9), (2, "c", 20, 31)], "cell bigint, chr string, start_pos bigint, end_pos bigint")
    assert [r.cell for r in X.keep_singlets(df).collect()] == [1]


def test_inflection_of_a_step(spark):
    totals = [(f"a{i}", 5000 - i) for i in range(300)] + [(f"b{i}", 300 - i // 4) for i in range(600)]
    df = spark.createDataFrame(totals, "cell string, total bigint")
    at = X.inflection(df).first().inflection
    assert at == 4701 and X.called(df).count() == 300
    assert X.inflection(df.limit(2)).first().inflection is None


def test_empty_droplets_calls_the_odd_cell(spark):
    rnd = random.Random(1)
    rows = [(f"empty{i}", f"g{rnd.randint(0, 19)}", 1) for i in range(300) for _ in range(4)]
    rows += [("real", f"g{i % 3}", 1) for i in range(90)] + [("ambient", f"g{rnd.randint(0, 19)}", 1) for _ in range(90)]
    counts = spark.createDataFrame(rows, "cell string, feature string, k int").groupBy("cell", "feature").agg({"k": "sum"}).withColumnRenamed("sum(k)", "n")
    got = {r.cell: (r.total, r.called) for r in X.empty_droplets(counts, ambient=20, rounds=1500, fdr=0.01).collect()}
    assert got == {"real": (90, True), "ambient": (90, False)}


def test_empty_droplets_as_registered_calls_a_cell(spark, monkeypatch):
    peak = [("c", 100 * i, 100 * i + 50) for i in range(40)]
    rnd = random.Random(2)
    rows = [(i, *rnd.choice(peak), 1) for i in range(300) for _ in range(4)] + [(1000 + c, *rnd.choice(peak), 1) for c in range(3) for _ in range(60)]
    rows += [(2000 + c, *peak[(c + j) % 40], 20) for c in range(3) for j in range(3)]
    counts = spark.createDataFrame(rows, "cell bigint, chr string, start_pos bigint, end_pos bigint, k int").groupBy("cell", "chr", "start_pos", "end_pos").agg(X.F.sum("k").alias("n"))
    monkeypatch.setattr(Q, "_counts", lambda s, d: counts)
    got = {r.cell: r for r in Q.cell_empty_droplets(spark, "").collect()}
    assert sorted(got) == [1000, 1001, 1002, 2000, 2001, 2002]
    assert {c for c, r in got.items() if r.called} == {2000, 2001, 2002} and got[2000].p < 0.001 < 0.01 < got[1000].p


def test_empty_droplets_p_against_the_exact_one(spark):
    rows = [(f"e{i}", f, 1) for i in range(300) for f in ("abb"[i % 3],)] + [("x", "a", 4), ("y", "a", 2), ("y", "b", 2)]
    got = {r.cell: r.p for r in X.empty_droplets(spark.createDataFrame(rows, "cell string, feature string, n int"), ambient=1).collect()}
    a = 101 / 302
    chance = {k: math.comb(4, k) * a**k * (1 - a) ** (4 - k) for k in range(5)}
    for cell, k in (("x", 4), ("y", 2)):
        assert abs(got[cell] - sum(v for v in chance.values() if v <= chance[k] * (1 + 1e-9))) < 0.02


def test_empty_droplets_refuses_too_few_rounds(spark):
    with pytest.raises(ValueError):
        X.empty_droplets(spark.createDataFrame([("x", "a", 4)], "cell string, feature string, n int"), rounds=200)


def test_sync_and_lookup(spark):
    atac = spark.createDataFrame([("k1", "A1"), ("k2", "A2")], "idb_key string, cell string")
    rna = spark.createDataFrame([("k1", "CELL_9"), ("k3", "CELL_8")], "idb_key string, cell string")
    synced = X.synchronise(atac, rna)
    assert {r.idb_key: r.cell for r in synced.collect()} == {"k1": "CELL_9", "k2": "ATAC-A2"}
    assert [r.cell for r in X.synchronised_only(synced).collect()] == ["CELL_9"]
    assert {r.idb_key: r.v for r in X.lookup(atac, rna.withColumnRenamed("cell", "v"), "idb_key", "v").collect()} == {"k1": "CELL_9", "k2": "-"}


def test_umis(spark):
    rows = [("c", "g", u) for u, k in (("AAAA", 5), ("AAAT", 2), ("AATT", 1), ("CCCC", 3), ("CCCG", 3)) for _ in range(k)] + [("c", "h", "AAAA")] * 2 + [("d", "g", "TTTT"), ("d", "h", "TTTT")]
    reads = spark.createDataFrame(rows, "cell string, gene string, umi string")
    assert {(r.cell, r.gene): r.umis for r in X.umi_counts(reads).collect()} == {("c", "g"): 5, ("c", "h"): 1, ("d", "g"): 1, ("d", "h"): 1}
    counted = reads.groupBy("cell", "gene", "umi").count().withColumnRenamed("count", "n")
    assert {(r.cell, r.gene): r.umis for r in X.collapse_umis(counted).collect()} == {("c", "g"): 2, ("c", "h"): 1, ("d", "g"): 1, ("d", "h"): 1}
    best = {(r.cell, r.umi): r.gene for r in X.one_gene_per_umi(reads).collect()}
    assert best[("c", "AAAA")] == "g" and ("d", "TTTT") not in best
