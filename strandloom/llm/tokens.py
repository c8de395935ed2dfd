"""Token ids of whole texts by a public byte-level BPE tokenizer.

Texts of up to `leaf` characters are encoded as they are. A longer text is cut in halves, and those
again, down to `leaf` characters; the pieces are rows of their own, so that a very long text is
encoded by many tasks. Neighbours are joined as a tree: a window around the cut is encoded anew and
grows until it has a word boundary in common with the right piece.

Why this is exact: the pattern that splits text into words before the merges reads from left to
right, and a match looks at most LOOK characters beyond what it takes. So the boundaries of the left
piece that lie more than LOOK characters before the cut hold for the joined text, and a scan from
such a boundary is the scan of the joined text. Where that scan and the scan of the right piece stop
at the same place, both go on alike.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a piece.
LEAF = 4096
#: The longest contraction of the pattern has three characters; one more for the look-ahead.
LOOK = 4
# Fixed value: the split pattern of byte_bpe_50k.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), regex.compile(pattern)


class Piece:
    """A stretch of text with its ids and its word starts."""

    __slots__ = ("ids", "starts", "text")

    def __init__(self, text: str, ids: np.ndarray, starts: np.ndarray):
        self.text, self.ids, self.starts = text, ids, starts


def piece(text: str, encoding, words) -> Piece:
    return Piece(text, np.array(encoding.encode_ordinary(text), np.int32), np.fromiter((m.start() for m in words.finditer(text)), np.int64))


def _by_word(text: str, starts: np.ndarray, stop: int, encoding) -> list[int]:
    """Ids of text[:stop], word by word: cut off as a whole it could be split otherwise at its end.

    A word alone is one word: blanks that were two words before a letter would be one at the end.
    """
    ends = [*starts[1:].tolist(), stop]
    return [i for a, b in zip(starts.tolist(), ends) for i in encoding.encode_ordinary(text[a:b])]


def join(left: Piece, right: Piece, encoding, words, window: int = 64) -> Piece:
    """The piece of left.text + right.text."""
    safe = left.starts[left.starts <= len(left.text) - LOOK]
    begin = int(safe[-1]) if len(safe) else 0
    tail = left.text[begin:]
    kept = len(left.ids) - len(encoding.encode_ordinary(tail))
    size = min(window, len(right.text))
    while True:
        text = tail + right.text[:size]
        starts = np.fromiter((m.start() for m in words.finditer(text)), np.int64)
        whole = size == len(right.text)
        sure = starts if whole else starts[starts <= len(text) - LOOK]
        common = np.intersect1d(sure[sure >= len(tail)] - len(tail), right.starts)
        if len(common):
            end = int(common[0])
            break
        if whole:
            end = size
            break
        size = min(2 * size, len(right.text))
    inside = starts[starts < len(tail) + end]
    passed = len(_by_word(right.text, right.starts[right.starts < end], end, encoding))
    ids = np.concatenate([left.ids[:kept], np.array(_by_word(text, inside, len(tail) + end, encoding), np.int32), right.ids[passed:]])
    cut, inside = len(left.text), inside + begin
    return Piece(left.text + right.text, ids, np.concatenate([left.starts[left.starts < begin], inside, right.starts[right.starts >= end] + cut]))


def cuts(length: int, leaf: int) -> list[tuple[int, int]]:
    """Halves of halves of [0, length) with at most `leaf` each; a power of two of them."""
    parts = 1
    while -(-length // parts) > leaf:
        parts *= 2
    return [(length * i // parts, length * (i + 1) // parts) for i in range(parts)]


def join_all(pieces: list[Piece], encoding, words) -> Piece:
    while len(pieces) > 1:
        pieces = [join(pieces[i], pieces[i + 1], encoding, words) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    return pieces[0]


def _lists(ids: list) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32) if ids else np.zeros(1, np.int32)
    flat = np.concatenate([np.asarray(x, np.int32) for x in ids]) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(df: DataFrame, key: str, text: str, path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """`key` and `ids` (array<int>): the ids of `text`, without special tokens, one row per row.

    Null and empty texts have no ids. Strings that look like special tokens are ordinary text. Keys
    may be null or repeated. Other columns are not read. `path`: a rank file, which is sent to the
    executors; `pattern`: the pattern that splits text into words.

    The pieces of one text are joined in one task, as its ids are one row in the end.
    """
    from pyspark import SparkFiles

    df.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = f"key {kind}, ids array<int>"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = _encoder(SparkFiles.get(name), pattern)
        for batch in batches:
            ids = [encoding.encode_ordinary(t) if t else [] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), _lists(ids)], ["key", "ids"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column("text").to_pylist()):
                at = cuts(len(t), leaf)
                for j in range(0, len(at), 256):
                    n = len(at[j : j + 256])
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays([batch.column("row").slice(i, 1)] * n), pa.concat_arrays([batch.column("key").slice(i, 1)] * n), pa.array(range(j, j + n), pa.int32()), pa.array([t[a:b] for a, b in at[j : j + 256]], pa.string())],
                        ["row", "key", "part", "text"],
                    )

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, words = _encoder(SparkFiles.get(name), pattern)
        for batch in batches:
            done = [piece(t, encoding, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "key", "part", "text")), _lists([p.ids for p in done]), _lists([p.starts for p in done])], ["row", "key", "part", "text", "ids", "starts"])

    def joined(table: pa.Table) -> pa.Table:
        encoding, words = _encoder(SparkFiles.get(name), pattern)
        table = table.sort_by("part")
        pieces = [Piece(t, np.array(i, np.int32), np.array(s, np.int64)) for t, i, s in zip(*(table[c].to_pylist() for c in ("text", "ids", "starts")))]
        return pa.table({"key": table["key"].slice(0, 1).combine_chunks(), "ids": _lists([join_all(pieces, encoding, words).ids])})

    length = F.coalesce(F.length("text"), F.lit(0))
    short = rows.filter(length <= leaf).mapInArrow(whole, out)
    # a row's number depends on its place in the input alone, so a task that runs again repeats it
    cut = rows.withColumn("row", F.monotonically_increasing_id()).filter(length > leaf).select("row", "key", "text").mapInArrow(split, f"row bigint, key {kind}, part int, text string")
    pieces = cut.repartition("row", "part").mapInArrow(parts, f"row bigint, key {kind}, part int, text string, ids array<int>, starts array<int>")
    long = pieces.groupBy("row").applyInArrow(joined, out)
    return short.unionByName(long).withColumnRenamed("key", key)
