"""Items that appear together: stripes of neighbours, merged by item, with lift and log-likelihood ratio.

A stripe is an item with an array of its neighbours and how often each stood beside it. Tasks build
the stripes of their records, stripes are shuffled by item, and those of one item are added up
neighbour by neighbour. A stripe that may be long is cut by a hash of the neighbour, so that no task
has to hold all neighbours of an item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.storage import materialise, maybe_broadcast

#: Pairs of one step of the counting, and pairs that a task holds before it hands its stripes on.
_STEP, _HELD = 1 << 20, 1 << 22
#: Neighbours of an item that one task adds up; items that may have more are cut in parts.
STRIPE = 1 << 16
#: Critical value of chi-squared with one degree of freedom at 0.1%.
SIGNIFICANT = 10.83


def _pair_codes(ids: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Codes a << 32 | b of the pairs inside each record, in arrays of about _STEP at most."""
    sizes = np.diff(offsets)
    for m in np.unique(sizes[sizes > 1]):
        records = ids[offsets[:-1][sizes == m][:, None] + np.arange(m)]
        for i in range(m - 1):
            step = max(1, _STEP // (m - 1 - i))
            for r in range(0, len(records), step):
                part = records[r : r + step]
                yield ((part[:, i : i + 1] << 32) | part[:, i + 1 :]).ravel()


def _stripes(parts: int):
    """Stripes (item, part, neighbours, counts) of the records of a task; a neighbour is in the part of its hash."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[str, int] = {}
        names: list[str] = []
        part_of = np.zeros(0, np.int64)
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []

        def fold() -> None:
            nonlocal codes, counts, waiting
            fresh, n = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (codes[:0], counts[:0])
            both, back = np.unique(np.concatenate([codes, fresh]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, back, np.concatenate([counts, n]))
            codes, counts, waiting = both, total, []

        def hand_on() -> Iterator[pa.RecordBatch]:
            nonlocal codes, counts
            heads, part = codes >> 32, part_of[codes & 0xFFFFFFFF]
            order = np.argsort(heads * parts + part, kind="stable")
            heads, part, tails, n = heads[order], part[order], codes[order] & 0xFFFFFFFF, counts[order]
            cuts = np.flatnonzero(np.diff(heads * parts + part, prepend=-1))
            text = pa.array(names, pa.string())
            for first in range(0, len(cuts), 256):
                some = cuts[first : first + 256]
                end = cuts[first + 256] if first + 256 < len(cuts) else len(codes)
                at = slice(some[0], end)
                offsets = pa.array(np.array([*some, end]) - some[0], pa.int32())
                neighbours = pa.ListArray.from_arrays(offsets, text.take(pa.array(tails[at])))
                yield pa.RecordBatch.from_arrays([text.take(pa.array(heads[some])), pa.array(part[some]), neighbours, pa.ListArray.from_arrays(offsets, pa.array(n[at]))], ["item", "part", "neighbours", "counts"])
            codes, counts = codes[:0], counts[:0]

        for batch in batches:
            lists = batch.column("items")
            flat = lists.flatten().dictionary_encode()
            local = np.array([index.setdefault(v, len(index)) for v in flat.dictionary.to_pylist()], np.int64)
            fresh = list(index)[len(names) :]
            names.extend(fresh)
            part_of = np.concatenate([part_of, np.array([xxhash.xxh64_intdigest(v) % parts for v in fresh], np.int64)])
            offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            ids = local[flat.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.int64)
            for pairs in _pair_codes(ids, offsets):
                waiting.append(pairs)
                if sum(map(len, waiting)) > _HELD:
                    fold()
                    if len(codes) > _HELD:
                        yield from hand_on()
        fold()
        if len(codes):
            yield from hand_on()

    return build


def _add_stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of a task, sorted by (item, part), added neighbour by neighbour.

    Only the stripe that the next batch may go on with is kept from one batch to the next.
    """
    names = ["item", "part", "neighbour", "n"]
    open_ = pa.table({"item": pa.array([], pa.string()), "part": pa.array([], pa.int64()), "neighbour": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
    for batch in batches:
        if not batch.num_rows:
            continue
        of = pc.list_parent_indices(batch.column("neighbours"))
        flat = pa.table([batch.column("item").take(of), batch.column("part").take(of), batch.column("neighbours").flatten(), batch.column("counts").flatten()], names)
        summed = pa.concat_tables([open_, flat]).group_by(["item", "part", "neighbour"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
        last = pc.and_(pc.equal(summed["item"], batch.column("item")[-1]), pc.equal(summed["part"], batch.column("part")[-1]))
        open_ = summed.filter(last).select(names)
        yield from _added(summed.filter(pc.invert(last)))
    yield from _added(open_)


def _added(table: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from table.select(["item", "neighbour", "n"]).rename_columns(["item_a", "item_b", "n_ab"]).combine_chunks().to_batches(max_chunksize=1 << 16)


def _xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.log(x.cast("double"))).otherwise(0.0)


def log_likelihood_ratio(both: Column, a: Column, b: Column, n: Column) -> Column:
    """G2 of the two by two table of records with and without the items."""
    inner = _xlogx(both) + _xlogx(a - both) + _xlogx(b - both) + _xlogx(n - a - b + both)
    outer = _xlogx(a) + _xlogx(n - a) + _xlogx(b) + _xlogx(n - b)
    return F.greatest(F.lit(0.0), 2 * (inner - outer + _xlogx(n)))


def together(df: DataFrame, record: list[str], item: str, one_in: int, significant: float | None = None, stripe: int = STRIPE) -> DataFrame:
    """Pairs of items that stand together in at least one of `one_in` records.

    Columns: item_a < item_b (by bytes), n_ab, n_a, n_b, n (records), lift, llr. A row of `df` puts
    `item` into the record of the columns `record`; repeated rows count once. Null items and records
    with a null key don't count. An empty table gives no rows. Other columns are not read.
    significant: pairs whose log-likelihood ratio is below it are left out (SIGNIFICANT for 0.1%).

    Items rarer than the share can be in no such pair, so they are left out before records are
    gathered; a record then has at most one_in * (mean items per record) items, however large it is.
    A task adds the pairs of its records up to stripes (item, neighbours, counts). Stripes are what is
    shuffled, by item and part, and what is added: an item with more than `stripe` possible
    neighbours is cut in parts by a hash of the neighbour.
    """
    held = df.select(*[F.col(c).alias(f"_r{j}") for j, c in enumerate(record)], F.col(item).cast("string").alias("item"))
    held, record = materialise(held.dropna().distinct(), "items"), [f"_r{j}" for j in range(len(record))]
    total = held.select(*record).distinct().count()
    support = materialise(held.groupBy("item").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") * one_in >= total), "support")
    known = maybe_broadcast(support)
    baskets = held.join(known.select("item"), "item").groupBy(*record).agg(F.sort_array(F.collect_list("item")).alias("items")).filter(F.size("items") > 1)
    parts = -(-support.count() // stripe) or 1
    stripes = baskets.select("items").mapInArrow(_stripes(parts), "item string, part bigint, neighbours array<string>, counts array<bigint>")
    by_item = stripes.repartition("item", "part").sortWithinPartitions("item", "part")
    pairs = by_item.mapInArrow(_add_stripes, "item_a string, item_b string, n_ab bigint").filter(F.col("n_ab") * one_in >= total)
    n = F.lit(total).cast("bigint")
    told = (
        pairs.join(known.select(F.col("item").alias("item_a"), F.col("k").alias("n_a")), "item_a")
        .join(known.select(F.col("item").alias("item_b"), F.col("k").alias("n_b")), "item_b")
        .select("item_a", "item_b", "n_ab", "n_a", "n_b", n.alias("n"), (F.col("n_ab") * n / (F.col("n_a") * F.col("n_b"))).alias("lift"), log_likelihood_ratio(F.col("n_ab"), F.col("n_a"), F.col("n_b"), n).alias("llr"))
    )
    return told if significant is None else told.filter(F.col("llr") >= significant)
