import math
import random
from collections import Counter, defaultdict
from itertools import combinations

from strandloom.llm.pairs import together


def brute(rows, one_in):
    records = defaultdict(set)
    for *key, item in rows:
        if item is not None and None not in key:
            records[tuple(key)].add(item)
    n, single, both = len(records), Counter(), Counter()
    for items in records.values():
        single.update(items)
        both.update(combinations(sorted(items, key=str.encode), 2))
    return {(a, b): (k, single[a], single[b], n) for (a, b), k in both.items() if k * one_in >= n}


def make(spark, rows, parts=4):
    return spark.createDataFrame(rows, "lib string, rec int, item string").repartition(parts)


def test_pairs_against_brute_force(spark):
    rnd = random.Random(2)
    rows = [("L%d" % rnd.randint(1, 2), rnd.randint(1, 60), rnd.choice("abcdefghijé") + str(rnd.randint(0, 2))) for _ in range(900)]
    rows += [("L1", 999, f"i{i}") for i in range(300)] + rows[:50] + [(None, 1, "a0"), ("L1", None, "a0"), ("L1", 1, None), ("L1", 5, ""), ("L2", 5, ""), ("L2", 5, "a0"), ("L1", 5, "a0")]
    for one_in in (10, 100):
        got = together(make(spark, rows), ["lib", "rec"], "item", one_in).collect()
        assert {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n) for r in got} == brute(rows, one_in)
        assert all(abs(r.lift - r.n_ab * r.n / (r.n_a * r.n_b)) < 1e-9 for r in got)


def test_llr_value(spark):
    rows = [("L", i, x) for i in range(20) for x in (["a", "b"] if i < 8 else ["a"] if i < 10 else ["b"] if i < 11 else ["c"])]
    r = next(r for r in together(make(spark, rows), ["lib", "rec"], "item", 20).collect() if r.item_a == "a" and r.item_b == "b")
    h = lambda *k: sum(x * math.log(x) for x in k if x)
    want = 2 * (h(8, 2, 1, 9) - h(10, 10) - h(9, 11) + h(20))
    assert abs(r.llr - want) < 1e-9


def test_hot_record_with_many_items(spark):
    rows = [("L", 1, f"i{i:04d}") for i in range(1500)] + [("L", 2, "i0000"), ("L", 2, "i0001")]
    got = together(make(spark, rows), ["lib", "rec"], "item", 1).collect()
    assert [(r.item_a, r.item_b, r.n_ab) for r in got] == [("i0000", "i0001", 2)]
    assert together(make(spark, rows), ["lib", "rec"], "item", 2).count() == 1500 * 1499 // 2


def test_empty_single_and_clashing_columns(spark):
    assert together(make(spark, [], 1), ["lib", "rec"], "item", 10).collect() == []
    assert together(make(spark, [("L", 1, "a"), ("L", 2, "b")]), ["lib", "rec"], "item", 10).collect() == []
    df = spark.createDataFrame([("r", "a", 1, "q"), ("r", "b", 1, "q")], "item string, thing string, k int, n_ab string")
    assert [(r.item_a, r.item_b) for r in together(df, ["item"], "thing", 1).collect()] == [("a", "b")]


def test_very_long_items(spark):
    a, b = "a" * 30_000, "b" * 30_000
    assert [(r.item_a, r.item_b) for r in together(make(spark, [("L", 1, a), ("L", 1, b)]), ["lib", "rec"], "item", 1).collect()] == [(a, b)]


def test_stripes_cut_in_parts_give_the_same(spark):
    rnd = random.Random(5)
    rows = [("L", rnd.randint(1, 80), f"p{rnd.randint(0, 40)}") for _ in range(1500)]
    whole = together(make(spark, rows), ["lib", "rec"], "item", 40).collect()
    parts = together(make(spark, rows), ["lib", "rec"], "item", 40, stripe=7).collect()
    assert sorted(whole) == sorted(parts) and {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n) for r in parts} == brute(rows, 40)


def test_stripes_are_added_across_batches():
    import pyarrow as pa

    from strandloom.llm import pairs as P

    stripe = lambda *rows: pa.RecordBatch.from_pylist([{"item": i, "part": p, "neighbours": list(n), "counts": c} for i, p, n, c in rows], pa.schema([("item", pa.string()), ("part", pa.int64()), ("neighbours", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]))
    given = [stripe(("a", 0, "bc", [1, 2]), ("a", 0, "b", [4])), stripe(("a", 0, "cd", [1, 1])), stripe(("a", 0, "d", [5]), ("a", 1, "x", [1]), ("b", 0, "c", [2])), stripe(), stripe(("b", 0, "c", [3]))]
    got = [tuple(r.values()) for b in P._add_stripes(iter(given)) for r in b.to_pylist()]
    assert sorted(got) == [("a", "b", 5), ("a", "c", 3), ("a", "d", 6), ("a", "x", 1), ("b", "c", 5)]


def test_only_significant_pairs(spark):
    rows = [("L", i, x) for i in range(60) for x in ("all", "even" if i % 2 == 0 else "odd", *(["rare", "with"] if i < 6 else []))]
    every, some = (together(make(spark, rows), ["lib", "rec"], "item", 20, significant=s).collect() for s in (None, 10.83))
    assert len(every) > len(some) and {(r.item_a, r.item_b) for r in some} == {(r.item_a, r.item_b) for r in every if r.llr >= 10.83} and ("rare", "with") in {(r.item_a, r.item_b) for r in some}
