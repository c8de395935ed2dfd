import random

import pytest

from strandloom.llm.queries import tokenizer
from strandloom.llm.tokens import _encoder, cuts, encode, join, join_all, piece

PATH, PATTERN = tokenizer()
ALPHABET = ["a", "B", "é", "ß", " ", " ", "  ", "\n", "\t", " ", "'", "'s", "'re", "'ll", "1", "23", ".", "...", "-", "👩‍👧", "日本", "hello", " world", "<|endoftext|>", "\r\n", "é", "\x00"]


@pytest.fixture(scope="module")
def coder():
    return _encoder(PATH, PATTERN)


def texts(seed, n, size):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, size))) for _ in range(n)]


def test_join_is_exact_at_every_cut(coder):
    encoding, words = coder
    for t in [*texts(1, 25, 40), "they'll  go", "a'", "x" * 90, " " * 50 + "a", "we'relax", "1234567890" * 5]:
        for k in range(len(t) + 1):
            out = join(piece(t[:k], encoding, words), piece(t[k:], encoding, words), encoding, words, window=3)
            assert out.ids.tolist() == encoding.encode_ordinary(t), (t, k)
            assert out.starts.tolist() == [m.start() for m in words.finditer(t)]


def test_trees_are_exact(coder):
    encoding, words = coder
    for t in [*texts(2, 40, 600), "ab" * 2000, "ha" * 500 + " " * 700 + "ha" * 500, "\n" * 999]:
        for leaf in (5, 37, 256):
            pieces = [piece(t[a:b], encoding, words) for a, b in cuts(len(t), leaf)]
            assert join_all(pieces, encoding, words).ids.tolist() == encoding.encode_ordinary(t)


def test_same_ids_as_the_json_tokenizer(coder):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    for x in texts(3, 60, 200):
        assert t.encode(x, add_special_tokens=False).ids == coder[0].encode_ordinary(x)


def test_operator_defined_results(spark, coder):
    rows = [(1, "Hello world"), (2, ""), (3, None), (None, "they'll"), (1, "Hello world"), (5, "ab 'll" * 5000), (6, "z" * 30_000), (7, "日本 " * 4000), (8, "<|endoftext|>"), (9, " ")]
    df = spark.createDataFrame([(k, t, "x", 0) for k, t in rows], "doc_id bigint, text string, ids string, row int").repartition(3)
    for leaf in (4096, 500):
        got = encode(df, "doc_id", "text", PATH, PATTERN, leaf)
        assert got.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
        want = sorted((str(k), coder[0].encode_ordinary(t or "")) for k, t in rows)
        assert sorted((str(r.doc_id), list(r.ids)) for r in got.collect()) == want


def test_empty_table(spark):
    assert encode(spark.createDataFrame([], "doc_id bigint, text string"), "doc_id", "text", PATH, PATTERN).collect() == []
