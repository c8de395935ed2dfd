import random
from collections import Counter

import numpy as np

from strandloom.llm import leaks as L

rnd = random.Random(4)
VOCABULARY = [f"w{i}" for i in range(3000)]
ITEMS = [(i, " ".join(rnd.choices(VOCABULARY, k=40))) for i in range(12)] + [(50, "too short to leak"), (51, None), (52, "")]


def brute(docs, items, window=12):
    grams = lambda t: {tuple(w[i : i + window]) for w in [L.words_of(t)] for i in range(len(w) - window + 1)}
    return {(d, i) for d, t in docs for i, u in items if grams(t) & grams(u)}


def docs():
    out = [(i, " ".join(rnd.choices(VOCABULARY, k=rnd.randint(0, 120)))) for i in range(40)]
    for k in (11, 12, 13, 40):
        for i in range(6):
            words = ITEMS[i][1].split()[: k] if i % 2 else ITEMS[i][1].split()[-k:]
            out.append((100 + 10 * k + i, "before " * 9 + " ".join(words) + " after" * 7))
    w = ITEMS[7][1].split()
    out += [(900, " ".join(w[:6]) + " (Applause) " + " ".join(w[6:14])), (901, " ".join(w[:5]) + " w-\r\n" + w[5][1:] + " " + " ".join(w[6:13])), (902, " ".join(w).upper()), (903, None), (904, ""), (905, " ".join(VOCABULARY * 12 + w))]
    return [*out, out[-4], (None, " ".join(w))]


def test_found_equals_brute_force(spark):
    rows = docs()
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id bigint, text string, item_id int, key string").repartition(3)
    items = spark.createDataFrame([(i, t, "same") for i, t in ITEMS], "item_id bigint, text string, near string")
    got = {(r.doc_id, r.item_id) for r in L.leaks(df, "doc_id", items, "item_id").filter("same > 0").collect()}
    assert got == brute(rows, ITEMS) and {(900, 7), (901, 7), (902, 7), (905, 7), (None, 7)} <= got
    blocks = {(r.doc_id, r.item_id) for r in L.leaks(df, "doc_id", items, "item_id", block_words=150).filter("same > 0").collect()}
    assert blocks == got


def test_words():
    assert L.words_of("Skös-\ntaern (a [b] c) x [d] e-f café 1,5") == ["sköstaern", "a", "c", "x", "e", "f", "café", "1", "5"]


def test_near_finds_every_pair_within_radius():
    rng = np.random.default_rng(3)
    for radius in (L.PART_RADIUS, L.ITEM_RADIUS):
        own = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
        index = L.Index(own, np.arange(40), np.arange(40), 12, radius)
        flips = []
        for k in range(1200):
            bits = rng.choice(64, k % (radius + 3), replace=False)
            flips.append(own[k % 40] ^ np.bitwise_or.reduce(np.array([1 << int(b) for b in bits], np.uint64), initial=np.uint64(0)))
        prints = np.array(flips, np.uint64)
        at, of = index.near(prints)
        want = {(i, j) for i, p in enumerate(prints.tolist()) for j, q in enumerate(own.tolist()) if bin(p ^ q).count("1") <= radius}
        assert set(zip(at.tolist(), of.tolist())) == want and len(at) == len(want) >= 800


def test_item_windows_meet_the_grid():
    for size in [*range(0, 200), 1151, 1152, 1153, 5000]:
        found = list(L.item_windows(size))
        assert (size < 36) == (not found)
        for length, firsts in found:
            assert firsts.min() >= 0 and firsts.max() + length <= size and set(firsts % (length // L.GRID)) == set(range(length // L.GRID))


def edited(words, every):
    """A word in about `every` is replaced."""
    return [f"x{rnd.randint(0, 999)}" if rnd.random() < 1 / every else w for w in words]


def test_edited_passages_are_found(spark):
    items = [(i, " ".join(rnd.choices(VOCABULARY, k=rnd.randint(60, 300)))) for i in range(60)]
    rows, want = [], set()
    for d in range(240):
        i = d % 60
        words = edited(items[i][1].split(), 60)
        rows.append((d, " ".join(rnd.choices(VOCABULARY, k=rnd.randint(0, 90)) + words + rnd.choices(VOCABULARY, k=rnd.randint(0, 90)))))
        if L._weighted(words, items[i][1].split()) >= L.SIMILARITY:
            want.add((d, i))
    df, passages = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in L.leaks(df, "doc_id", passages, "item_id").filter("near > 0").collect()}
    assert len(want) > 150 and len(want & set(got)) >= 0.9 * len(want)
    assert all(i == d % 60 and s >= L.SIMILARITY for (d, i), s in got.items()) and any(s < 1 for s in got.values())


def test_recall_of_windows_at_the_similarity():
    """Of windows with a few changed words that are still similar, nine in ten lie within the radius."""
    hasher, met, similar = L.Hasher(), 0, 0
    for length in (64, 128):
        for _ in range(300):
            a = rnd.choices(VOCABULARY, k=length)
            b = edited(a, 50)
            if a != b and L._weighted(a, b) >= L.SIMILARITY:
                p, q = (int(L.fingerprints(hasher.shingles(w), length - L.SHINGLE + 1)[0]) for w in (a, b))
                similar, met = similar + 1, met + (bin(p ^ q).count("1") <= L.ITEM_RADIUS)
    assert similar > 100 and met >= 0.9 * similar


def test_fingerprints_by_hand():
    h = np.random.default_rng(1).integers(0, 1 << 63, 40, dtype=np.uint64)
    for w in (1, 3, 8, 11):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).astype(int)
        want = np.packbits(np.array([bits[i : i + w].sum(axis=0) * 2 > w for i in range(40 - w + 1)]), axis=1).view(np.uint64).ravel()
        assert (L.fingerprints(h, w) == want).all() and (L.fingerprints_at(L.sums_of_bits(h), np.arange(40 - w + 1), w) == want).all()
    assert (L.fingerprints_at(L.sums_of_bits(h, 4), np.arange(0, 33, 4), 8, 4) == L.fingerprints(h, 8)[::4]).all()


def test_weighted_similarity():
    a = [*"abcdefghijkl"]
    assert L._weighted(a, a) == 1 and L._weighted(a, a[::-1]) == 0
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    b = [*a[:-1], "x"]
    assert L._weighted(a, b) == sum((grams(a) & grams(b)).values()) / sum((grams(a) | grams(b)).values())


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert L.leaks(none, "doc_id", items, "item_id").collect() == []
    assert L.leaks(spark.createDataFrame([(1, ITEMS[0][1])], "doc_id bigint, text string"), "doc_id", items.limit(0), "item_id").collect() == []
