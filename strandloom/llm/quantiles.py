"""Percentiles per group by dyadic Count-sketches.

A value is encoded as an integer of BITS bits that keeps the order (exact below 2**MANTISSA, then
with MANTISSA leading bits, so with a relative error below 2**-MANTISSA). For each length of prefix
of the code there is one signed sketch of how many values have each prefix: prefixes of up to TOP
bits are counted exactly, longer ones in a Count-sketch of DEPTH rows of WIDTH counters. Sketches of
parts merge by addition, and a value is deleted by adding it with weight -1. A rank is inverted by
going down from the top, at each level to the child that holds it.

Small groups are kept as the list of their codes with counts, which is merged and deleted from in
the same way, and becomes a sketch once it has more than BUFFER codes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MANTISSA = 16
#: A sign and 63 - MANTISSA + 1 blocks of 2**MANTISSA codes, so that every bigint has a code.
BITS = 23
TOP = 12
DEPTH = 5
WIDTH = 2048
BUFFER = 1024
#: Sketches of one key merged by one task.
FAN_IN = 32
#: Numbers that one task holds in lists and sketches of all its keys before it hands them on (64 MB).
#: That is some 75 keys with sketches: fewer keys stay in place to the end, whatever their rows.
HELD = 1 << 23
#: Stated error of a rank, as a share of the group; the sketches above keep well inside it.
RANK_ERROR = 0.01

_LEVELS = range(TOP + 1, BITS + 1)
_SIZE = (1 << TOP) + len(_LEVELS) * DEPTH * WIDTH
_SEEDS = np.random.default_rng(20240229).integers(1, 1 << 63, size=(len(_LEVELS), DEPTH, 4), dtype=np.uint64) | np.uint64(1)
_HALF = 1 << (BITS - 1)


def encode(values: np.ndarray) -> np.ndarray:
    """int64 -> code; the larger the value, the larger the code."""
    v = values.astype(np.int64)
    size = np.where(v < 0, ~v, v).astype(np.uint64)
    exponent = np.zeros(len(v), np.int64)
    rest = size >> np.uint64(MANTISSA)
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1) << np.uint64(step)
        exponent[big] += step
        rest[big] >>= np.uint64(step)
    exponent += (size >> np.uint64(MANTISSA)) > 0
    # exponent e > 0: size lies in [2**(MANTISSA + e - 1), 2**(MANTISSA + e))
    shift = np.maximum(exponent - 1, 0).astype(np.uint64)
    code = np.where(exponent > 0, exponent * (1 << MANTISSA) + ((size >> shift).astype(np.int64) - (1 << MANTISSA)), size.astype(np.int64))
    return np.where(v < 0, _HALF - 1 - code, _HALF + code)


def decode(code: int) -> tuple[int, int]:
    """The smallest and the largest value with this code."""
    if code < _HALF:
        low, high = decode(2 * _HALF - 1 - code)
        return ~high, ~low
    exponent, part = divmod(code - _HALF, 1 << MANTISSA)
    if exponent == 0:
        return part, part
    low = (part + (1 << MANTISSA)) << (exponent - 1)
    return low, low + (1 << (exponent - 1)) - 1


def _place(prefixes: np.ndarray, level: int, row: int) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, e = _SEEDS[level, row]
    x = prefixes.astype(np.uint64)
    mixed = (x ^ (x >> np.uint64(7))) * a + b
    mixed ^= mixed >> np.uint64(29)
    mixed *= c
    bucket = (mixed >> np.uint64(64 - WIDTH.bit_length() + 1)).astype(np.int64)
    sign = (((mixed ^ (mixed >> np.uint64(31))) * e) >> np.uint64(63)).astype(np.int64) * 2 - 1
    return bucket, sign


def _sketch(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(_SIZE, np.int64)
    order = np.argsort(codes, kind="stable")
    codes, weights = codes[order], weights[order]
    for i in reversed(range(len(_LEVELS))):
        prefix = codes >> (BITS - _LEVELS[i])
        first = np.flatnonzero(np.diff(prefix, prepend=-1))
        codes, weights, at = codes[first], np.add.reduceat(weights, first), prefix[first]
        for row in range(DEPTH):
            bucket, sign = _place(at, i, row)
            base = (1 << TOP) + (i * DEPTH + row) * WIDTH
            out[base : base + WIDTH] += np.bincount(bucket, sign * weights, WIDTH).astype(np.int64)
    out[: 1 << TOP] = np.bincount(codes >> (BITS - TOP), weights, 1 << TOP).astype(np.int64)
    return out


class Part:
    """What is known of one group: codes with counts, or a sketch."""

    __slots__ = ("codes", "sketch", "waiting", "weights")

    def __init__(self):
        self.codes, self.weights, self.sketch, self.waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), None, []

    def add(self, codes: np.ndarray, weights: np.ndarray) -> None:
        self.waiting.append((codes, weights))
        if sum(len(c) for c, _ in self.waiting) > 4 * BUFFER:
            self.fold()

    def fold(self) -> None:
        if not self.waiting:
            return
        codes = np.concatenate([self.codes, *[c for c, _ in self.waiting]])
        weights = np.concatenate([self.weights, *[w for _, w in self.waiting]])
        self.waiting = []
        at, back = np.unique(codes, return_inverse=True)
        total = np.zeros(len(at), np.int64)
        np.add.at(total, back, weights)
        at, total = at[total != 0], total[total != 0]
        if self.sketch is None and len(at) <= BUFFER:
            self.codes, self.weights = at, total
            return
        self.codes, self.weights = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(at):
            more = _sketch(at, total)
            self.sketch = more if self.sketch is None else self.sketch + more

    def add_sketch(self, sketch: np.ndarray) -> None:
        self.sketch = sketch.copy() if self.sketch is None else self.sketch + sketch

    def finish(self) -> None:
        self.fold()
        if self.sketch is not None and len(self.codes):
            self.sketch = self.sketch + _sketch(self.codes, self.weights)
            self.codes, self.weights = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def held(self) -> int:
        """Numbers in memory."""
        return (0 if self.sketch is None else _SIZE) + 2 * (len(self.codes) + sum(len(c) for c, _ in self.waiting))

    def total(self) -> int:
        return int(self.sketch[: 1 << TOP].sum() if self.sketch is not None else self.weights.sum())

    def code_at(self, rank: int) -> int:
        """The code at `rank` (from 0): exact for a list, else by going down the levels."""
        if self.sketch is None:
            return int(self.codes[min(np.searchsorted(np.cumsum(self.weights), rank, side="right"), len(self.codes) - 1)])
        sums = np.cumsum(self.sketch[: 1 << TOP])
        node = int(min(np.searchsorted(sums, rank, side="right"), (1 << TOP) - 1))
        held = float(self.sketch[node])
        rank = rank - float(sums[node] - self.sketch[node])
        for i in range(len(_LEVELS)):
            left = self._estimate(i, 2 * node)
            right = self._estimate(i, 2 * node + 1)
            # both children are estimated; half of what they miss or exceed the parent by goes to each
            left = min(max(left + (held - left - right) / 2, 0.0), held)
            if rank < left:
                node, held = 2 * node, left
            else:
                node, held, rank = 2 * node + 1, held - left, rank - left
        return node

    def _estimate(self, level: int, prefix: int) -> float:
        at = np.array([prefix])
        found = []
        for row in range(DEPTH):
            bucket, sign = _place(at, level, row)
            found.append(self.sketch[(1 << TOP) + (level * DEPTH + row) * WIDTH + bucket[0]] * sign[0])
        return float(np.median(found))


_PART = "node bigint, codes binary, weights binary, sketch binary"


def _record(part: Part) -> tuple[bytes | None, bytes | None, bytes | None]:
    if part.sketch is not None:
        return None, None, part.sketch.tobytes()
    return part.codes.astype(np.int32).tobytes(), part.weights.tobytes(), None


def _load(part: Part, codes: bytes | None, weights: bytes | None, sketch: bytes | None) -> None:
    if sketch is not None:
        part.add_sketch(np.frombuffer(sketch, np.int64))
    elif codes:
        part.add(np.frombuffer(codes, np.int32).astype(np.int64), np.frombuffer(weights, np.int64))


def build(df: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Sketches of `value` (cast to bigint) per group and partition: keys (as they are) and the parts.

    Rows with a null value or weight, or a value that is no number of that range, are no
    observations; null keys form a group. `weight` counts a
    row so many times, -1 deletes it. Nothing is shuffled, and a task holds HELD numbers and the last
    key's part at most.
    """
    group = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit("{}")
    rows = df.select(group.alias("g"), F.col(value).try_cast("bigint").alias("v"), (F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")).alias("w")).filter("v is not null and w is not null")

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        node, parts = TaskContext.get().partitionId(), {}

        def hand_on() -> Iterator[pa.RecordBatch]:
            for name, part in parts.items():
                part.finish()
                codes, weights, sketch = _record(part)
                yield pa.RecordBatch.from_pydict({"g": pa.array([name], pa.string()), "node": pa.array([node], pa.int64()), "codes": pa.array([codes], pa.binary()), "weights": pa.array([weights], pa.binary()), "sketch": pa.array([sketch], pa.binary())})
            parts.clear()

        for batch in batches:
            names = batch.column("g").dictionary_encode()
            codes, weights = encode(batch.column("v").to_numpy(zero_copy_only=False)), batch.column("w").to_numpy(zero_copy_only=False)
            of = names.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.diff(of[order], prepend=-1))
            for first, last in zip(cuts, [*cuts[1:], len(of)]):
                rows = order[first:last]
                parts.setdefault(names.dictionary[int(of[rows[0]])].as_py(), Part()).add(codes[rows], weights[rows])
            if sum(part.held() for part in parts.values()) > HELD:
                yield from hand_on()
        yield from hand_on()

    return rows.mapInArrow(leaf, f"g string, {_PART}")


def merge(parts: DataFrame, sources: int) -> DataFrame:
    """One part per group. `sources`: upper bound of the `node` numbers; FAN_IN nodes go to a task."""

    def one(key: tuple, table: pa.Table) -> pa.Table:
        part = Part()
        for codes, weights, sketch in zip(*(table[c].to_pylist() for c in ("codes", "weights", "sketch"))):
            _load(part, codes, weights, sketch)
        part.finish()
        codes, weights, sketch = _record(part)
        return pa.table({"g": pa.array([key[0].as_py()], pa.string()), "node": pa.array([key[1].as_py()], pa.int64()), "codes": pa.array([codes], pa.binary()), "weights": pa.array([weights], pa.binary()), "sketch": pa.array([sketch], pa.binary())})

    while True:
        sources = -(-sources // FAN_IN)
        parts = parts.withColumn("node", F.expr(f"node div {FAN_IN}")).groupBy("g", "node").applyInArrow(one, f"g string, {_PART}")
        if sources <= 1:
            return parts


def regroup(parts: DataFrame, old: str, keys: list[str]) -> DataFrame:
    """Parts keyed by the columns of the schema `old` keyed by `keys` alone, such as days to a total."""
    told = F.from_json("g", old)
    return parts.select(F.to_json(F.struct(*[told[k].alias(k) for k in keys]), {"ignoreNullFields": "false"}).alias("g"), "node", "codes", "weights", "sketch")


def ranks(parts: DataFrame, shares: list[float]) -> DataFrame:
    """For each group and share q: `n`, and the range of values at rank q * (n - 1), rounded down."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("g", "q", "n", "low", "high")}
            for g, codes, weights, sketch in zip(*(batch.column(c).to_pylist() for c in ("g", "codes", "weights", "sketch"))):
                part = Part()
                _load(part, codes, weights, sketch)
                part.finish()
                n = part.total()
                if n <= 0:
                    continue
                for q in shares:
                    low, high = decode(part.code_at(int(q * (n - 1))))
                    for k, v in (("g", g), ("q", q), ("n", n), ("low", low), ("high", high)):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict({"g": pa.array(out["g"], pa.string()), "q": pa.array(out["q"], pa.float64()), "n": pa.array(out["n"], pa.int64()), "low": pa.array(out["low"], pa.int64()), "high": pa.array(out["high"], pa.int64())})

    return parts.select("g", "codes", "weights", "sketch").mapInArrow(read, "g string, q double, n bigint, low bigint, high bigint")


def percentiles(df: DataFrame, keys: list[str], value: str, shares: list[float], weight: str | None = None) -> DataFrame:
    """Percentiles of `value` per group: keys, `q`, `n`, `low`, `high`.

    The value at a rank within RANK_ERROR * n of q * (n - 1) lies from `low` to `high`, which differ
    by less than 2**-MANTISSA of the value. Ties and repeated rows count each time; nulls don't; an
    empty table gives no rows. Groups may be of any size: parts are merged FAN_IN at a time.
    """
    parts = merge(build(df, keys, value, weight), df.rdd.getNumPartitions())
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    out = ranks(parts, shares)
    if not keys:
        return out.drop("g")
    told = F.from_json("g", schema)
    return out.select(*[told[k].alias(k) for k in keys], "q", "n", "low", "high")
