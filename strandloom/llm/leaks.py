"""Evaluation passages that stand, wholly or partly, in a corpus.

Passages are cut into windows of two sizes: parts, of as many words as make a leak, at every word;
and item-sized windows, of the largest power-of-two length that leaves a fifth of the passage, which
find it as a whole though words of it were changed. Documents have windows of both sizes: parts at
every word, item-sized ones at every eighth of their length. (An item has as many item-sized windows
as it takes for one of them to lie on that grid, wherever the passage stands.)

A window has a 64-bit SimHash of its shingles of five words. Fingerprints that differ in up to R bits
differ, in at least one of four blocks of 16 bits, in no more bits than that block allows, if the
blocks allow R - 3 in sum. So a table per block that has each passage window under every value its
block allows finds every such pair. What it finds is held against the words: whether the windows are
the same words, and the weighted similarity of the shingles.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.storage import materialise

BLOCKS, BLOCK_BITS = 4, 16
#: Bits in which fingerprints may differ: for parts, where one changed word is beyond SIMILARITY
#: anyway, and for item-sized windows, of which this finds nine in ten at SIMILARITY itself.
PART_RADIUS, ITEM_RADIUS = 3, 13
SHINGLE = 5
SIMILARITY = 0.8
#: Lengths of item-sized windows; a longer passage is cut in stretches with windows of the last length.
#: The grid and the number of shingles of a window are multiples of SHINGLE - 1.
LENGTHS = (32, 64, 128, 256, 512, 1024)
#: Grid of item-sized windows, as a part of their length.
GRID = 8
#: Words of one block of the query set; each block makes one pass over the corpus.
BLOCK_WORDS = 200_000
#: Words whose fingerprints are made at a time.
_STEP = 8192

_BREAK = re.compile(r"-\r?\n")
_BRACKETS = re.compile(r"\([^()\[\]]*\)|\[[^()\[\]]*\]")
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Words as defined for leaks: NFC, hyphenated breaks closed, innermost brackets blanked, lower case."""
    if not text:
        return []
    text = _BREAK.sub("", unicodedata.normalize("NFC", text))
    return _WORD.findall(_BRACKETS.sub(" ", text).lower())


_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, size=SHINGLE, dtype=np.uint64) | np.uint64(1)


class Hasher:
    """Hashes of words, kept for the words seen so far (up to a bound)."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def words(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 500_000:
            known.clear()
        for w in set(words) - known.keys():
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def shingles(self, words: list[str]) -> np.ndarray:
        h = self.words(words)
        n = len(h) - SHINGLE + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = h[:n] * _FACTORS[0]
        for k in range(1, SHINGLE):
            out += h[k : n + k] * _FACTORS[k]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(32))


def fingerprints(shingles: np.ndarray, per_window: int) -> np.ndarray:
    """SimHash of every `per_window` consecutive shingles: a bit is the majority's, a tie gives 0."""
    n = len(shingles) - per_window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1)
    if per_window > 255:
        bits = bits.astype(np.uint16)
    total, done, power, width = None, 0, bits, 1
    left = per_window
    while left:
        if left & 1:
            part = power[done : done + n]
            total = part.copy() if total is None else total + part
            done += width
        left >>= 1
        if left:
            power = power[:-width] + power[width:]
            width *= 2
    return np.packbits(total > per_window // 2, axis=1).view(np.uint64).ravel()


def sums_of_bits(shingles: np.ndarray, group: int = 1) -> np.ndarray:
    """Row i: how often each bit is set in the first i * group shingles."""
    groups = len(shingles) // group
    bits = np.unpackbits(shingles[: groups * group].view(np.uint8).reshape(-1, 8), axis=1)
    if group > 1:
        bits = bits.reshape(groups, group, 64).sum(axis=1, dtype=np.uint8)
    out = np.zeros((groups + 1, 64), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=out[1:])
    return out


def fingerprints_at(sums: np.ndarray, first: np.ndarray, per_window: int, group: int = 1) -> np.ndarray:
    """As fingerprints, of the windows that begin with the shingles `first` alone; all in multiples of `group`."""
    return np.packbits((sums[(first + per_window) // group] - sums[first // group]) * 2 > per_window, axis=1).view(np.uint64).ravel()


def _allowed(radius: int) -> list[int]:
    """Bits that each block may differ in, so that fingerprints within `radius` meet in one of them."""
    rest = radius - (BLOCKS - 1)
    return [rest // BLOCKS + (b < rest % BLOCKS) for b in range(BLOCKS)]


def _block(prints: np.ndarray, b: int) -> np.ndarray:
    return ((prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint16)


class Index:
    """Windows of one length, by the blocks of their fingerprints.

    windows: (item, first word) of each, as positions in the words of all items.
    """

    def __init__(self, prints: np.ndarray, first: np.ndarray, of: np.ndarray, length: int, radius: int):
        self.prints, self.first, self.of, self.length, self.radius = prints, first, of, length, radius
        self.tables = []
        for b, bits in enumerate(_allowed(radius)):
            masks = np.array([sum(1 << p for p in places) for k in range(bits + 1) for places in combinations(range(BLOCK_BITS), k)], np.uint16)
            value = (_block(prints, b)[:, None] ^ masks).ravel()
            order = np.argsort(value, kind="stable")
            self.tables.append((np.searchsorted(value[order], np.arange((1 << BLOCK_BITS) + 1)), (order // len(masks)).astype(np.int32)))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in `prints`, passage window) of all pairs within the radius, once each."""
        found = []
        for b, (starts, order) in enumerate(self.tables):
            value = _block(prints, b).astype(np.int64)
            first, n = starts[value], starts[value + 1] - starts[value]
            hit = np.flatnonzero(n)
            at = np.repeat(hit, n[hit])
            of = order[np.repeat(first[hit] - np.cumsum(n[hit]) + n[hit], n[hit]) + np.arange(len(at))].astype(np.int64)
            close = np.bitwise_count(prints[at] ^ self.prints[of]) <= self.radius
            found.append(at[close] * len(self.of) + of[close])
        both = np.unique(np.concatenate(found)) if len(self.of) else np.zeros(0, np.int64)
        return (both // len(self.of), both % len(self.of)) if len(both) else (both, both)


class Passages:
    """The words of the passages with an Index of parts and one for each item-sized length in use."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        texts = [words_of(text) for _, text in items]
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        self.words = [w for t in texts for w in t]
        shingles = Hasher().shingles(self.words)
        sums = sums_of_bits(shingles)
        ones: dict[int, list[tuple[int, np.ndarray]]] = {}
        for at, (start, size) in enumerate(zip(starts, sizes)):
            if size >= window:
                ones.setdefault(window, []).append((at, start + np.arange(size - window + 1)))
            for length, firsts in item_windows(int(size)):
                ones.setdefault(-length, []).append((at, start + firsts))
        self.parts, self.whole = None, []
        for length, found in sorted(ones.items(), reverse=True):
            first, of = np.concatenate([f for _, f in found]), np.repeat([a for a, _ in found], [len(f) for _, f in found])
            prints = fingerprints_at(sums, first, abs(length) - SHINGLE + 1)
            index = Index(prints, first, of, abs(length), PART_RADIUS if length > 0 else ITEM_RADIUS)
            if length > 0:
                self.parts = index
            else:
                self.whole.append(index)


def item_windows(size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, first words) of the item-sized windows of a passage of `size` words.

    Of each stretch there are as many, one after the other, as lie between two points of the grid.
    Passages too short for the shortest length have none: for them parts must do.
    """
    fits = [n for n in LENGTHS if n + n // GRID <= size]
    if fits:
        length = fits[-1]
        stretch = length + length // GRID
        firsts = [start + np.arange(length // GRID) for start in range(0, size - stretch + 1, stretch)]
        yield length, np.unique(np.concatenate([*firsts, size - stretch + np.arange(length // GRID)]))


def _weighted(a: list[str], b: list[str]) -> float:
    """Weighted Jaccard similarity of the shingles, each with its number of occurrences as weight."""
    x, y = (Counter(tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)) for w in (a, b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def _search(items: list[tuple[int, str]], window: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages, hasher = Passages(items, window), Hasher()
        longest = max([window, *(i.length for i in passages.whole)])

        def hits(words: list[str], ends: np.ndarray) -> Iterator[tuple[int, int, bool, float]]:
            """(document, item, whether the same part, similarity) of the windows of some documents."""
            h = hasher.shingles(words)
            for first in range(0, len(h), _STEP):
                some = h[first : first + _STEP + longest - SHINGLE]
                sums = sums_of_bits(some, SHINGLE - 1) if passages.whole else None
                for index in ([passages.parts] if passages.parts else []) + passages.whole:
                    part, per_window = index is passages.parts, index.length - SHINGLE + 1
                    step = 1 if part else index.length // GRID
                    prints = fingerprints(some, per_window)[:_STEP] if part else fingerprints_at(sums, np.arange(0, max(0, min(_STEP, len(some) - per_window + 1)), step), per_window, SHINGLE - 1)
                    at, of = index.near(prints)
                    at = at * step + first
                    doc = np.searchsorted(ends, at, side="right")
                    inside = at + index.length <= ends[doc] if len(at) else np.zeros(0, bool)
                    for a, o, d in zip(at[inside].tolist(), of[inside].tolist(), doc[inside].tolist()):
                        mine, start = words[a : a + index.length], int(index.first[o])
                        theirs = passages.words[start : start + index.length]
                        same = mine == theirs
                        if part:
                            if same:
                                yield d, int(index.of[o]), True, 0.0
                        elif (likeness := 1.0 if same else _weighted(mine, theirs)) >= SIMILARITY:
                            yield d, int(index.of[o]), False, likeness

        for batch in batches:
            out: dict[tuple[int, int], list] = {}
            waiting: list[tuple[int, list[str]]] = []

            def flush() -> None:
                words = [w for _, ws in waiting for w in ws]
                for d, o, part, likeness in hits(words, np.cumsum([len(ws) for _, ws in waiting])):
                    seen = out.setdefault((waiting[d][0], o), [0, 0, None])
                    if part:
                        seen[0] += 1
                    else:
                        seen[1] += 1
                        seen[2] = max(seen[2] or 0.0, likeness)
                waiting.clear()

            held = 0
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                if len(words) >= window:
                    waiting.append((i, words))
                    held += len(words)
                if held > _STEP:
                    flush()
                    held = 0
            flush()
            rows = pa.array([d for d, _ in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(rows), pa.array([items[i][0] for _, i in out], pa.int64()), pa.array([v[0] for v in out.values()], pa.int64()), pa.array([v[1] for v in out.values()], pa.int64()), pa.array([v[2] for v in out.values()], pa.float64())],
                ["key", "item_id", "same", "near", "similarity"],
            )

    return search


def leaks(docs: DataFrame, key: str, items: DataFrame, item: str, window: int = 12, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents with passages: `key`, item_id, same, near, similarity.

    `same`: pairs of equal parts, windows of `window` words; `near`: pairs of item-sized windows with
    a similarity of SIMILARITY or more whose fingerprints lie within ITEM_RADIUS; `similarity`: the
    largest of those, or null. Both tables have a column `text`; null and empty texts and texts under
    `window` words have no windows. A document that stands twice in `docs` gives two rows. Empty
    tables give no rows.

    The passages are the query set: they go to every task in blocks of about `block_words` words,
    whatever their number, and the corpus is read once per block and never shuffled. With several
    blocks, the rows of each are written before the passages of the next come to the driver.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), "text").filter("text is not null")
    queries = items.select(F.col(item).cast("bigint").alias("id"), "text").filter("id is not null and text is not null")
    words = queries.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-words // block_words))
    out = None
    for b in range(blocks):
        own = [(r.id, r.text) for r in queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()]
        found = rows.mapInArrow(_search(own, window), f"key {kind}, item_id bigint, same bigint, near bigint, similarity double")
        if blocks > 1:
            found = materialise(found, "leaks")
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("key", key)
