"""Read trimming: quality, adapters, fixed clips, poly-A, RRBS, UMIs and pair validation.

All functions work on one row (seq, qual) at a time, so trimming never shuffles. Phred offset 33.
A trimmed read keeps seq and qual of equal length; null reads stay null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The adapters that are searched for, by name.
ADAPTERS = {"Illumina": "AGATCGGAAGAGC", "Nextera": "CTGTCTCTTATA", "smallRNA": "TGGAATTCTCGG"}


#: Cells of a matrix of reads that a worker holds at a time.
_CELLS = 1 << 24


def _matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts as a matrix padded with 0, and their lengths."""
    n = np.array([len(t) for t in texts], np.int64)
    width = max(1, int(n.max(initial=0)))
    return np.array([t.encode("latin-1", "replace") for t in texts], f"S{width}").view(np.uint8).reshape(len(texts), width), n


def _in_steps(values: list[pd.Series], work) -> pd.Series:
    """`work` on lists of texts, so many rows at a time that their matrix stays small; null gives null."""
    whole = pd.concat(values, axis=1)
    known = whole.notna().all(axis=1)
    rows = [whole.iloc[:, j][known].tolist() for j in range(whole.shape[1])]
    out = np.zeros(int(known.sum()), np.int64)
    first = 0
    while first < len(out):
        step = max(1, _CELLS // max(1, max(len(t) for t in rows[0][first : first + 4096])))
        last = min(first + min(step, 4096), len(out))
        out[first:last] = work(*[r[first:last] for r in rows])
        first = last
    result = pd.Series(pd.NA, index=whole.index, dtype="Int64")
    result[known] = out
    return result


def _quality_cut(cutoff: int):
    def work(quals: list[str], seqs: list[str] | None = None) -> np.ndarray:
        scores, n = _matrix(quals)
        scores = scores.astype(np.int32) - 33
        if seqs is not None:
            bases, _ = _matrix(seqs)
            width = min(scores.shape[1], bases.shape[1])
            scores[:, :width][bases[:, :width] == ord("G")] = cutoff - 1
        inside = np.arange(scores.shape[1]) < n[:, None]
        total = np.cumsum(np.where(inside, cutoff - scores, 0)[:, ::-1], axis=1)
        total[np.minimum.accumulate(total, axis=1) < 0] = 0
        best = total.argmax(axis=1)
        return np.where(total.max(axis=1) > 0, scores.shape[1] - 1 - best, n)

    return work


def quality_cut(qual: Column, cutoff: int = 20, seq: Column | None = None) -> Column:
    """Bases kept when the 3' end is trimmed at `cutoff`.

    Going from the 3' end, cutoff - score is summed; the read is cut where the sum is largest, and
    the search ends where it falls below 0. With `seq`, the score of a G counts as cutoff - 1
    (two-colour machines call dark cycles G).

    An Arrow-batched function over matrices of reads: as nested array expressions Catalyst would
    copy the read's own expression into every step.
    """
    if seq is None:
        return F.pandas_udf(lambda q: _in_steps([q], _quality_cut(cutoff)), "bigint")(qual)
    return F.pandas_udf(lambda q, s: _in_steps([q, s], _quality_cut(cutoff)), "bigint")(qual, seq)


def keep_first(df: DataFrame, n: Column, seq: str = "seq", qual: str = "qual") -> DataFrame:
    """The first n bases."""
    return df.withColumn("_n", n.cast("int")).withColumns({c: F.substr(F.col(c), F.lit(1), F.col("_n")) for c in (seq, qual)}).drop("_n")


def trim_quality(df: DataFrame, cutoff: int = 20, two_colour: bool = False) -> DataFrame:
    return keep_first(df, quality_cut(F.col("qual"), cutoff, F.col("seq") if two_colour else None))


def adapter_counts(df: DataFrame, first: int | None = None, order: str | None = None) -> DataFrame:
    """One row: reads, and reads that hold each adapter; of the `first` reads by `order` if given."""
    rows = df.orderBy(order).limit(first) if first else df
    return rows.agg(F.count(F.lit(1)).alias("reads"), *[F.count_if(F.instr("seq", a) > 0).alias(k) for k, a in ADAPTERS.items()])


def detect_adapter(counts: DataFrame, already_trimmed: int | None = None) -> DataFrame:
    """name and sequence of the adapter to trim, from adapter_counts.

    The most frequent one. On a tie Illumina if it is among the best, else Nextera. With
    `already_trimmed`, X (nothing to trim) if the best count does not exceed it.
    """
    most = F.greatest(*ADAPTERS)
    name = F.when(F.col("Illumina") == most, "Illumina").when(F.col("Nextera") == most, "Nextera").otherwise("smallRNA")
    if already_trimmed is not None:
        name = F.when(most <= already_trimmed, "none").otherwise(name)
    seq = F.create_map(*[F.lit(x) for k, a in (*ADAPTERS.items(), ("none", "X")) for x in (k, a)])
    return counts.select(name.alias("adapter"), seq[name].alias("sequence"), "reads", *ADAPTERS)


def _adapter_start(adapter: bytes, error_rate: float, min_overlap: int):
    def work(seqs: list[str]) -> np.ndarray:
        bases, n = _matrix(seqs)
        width = bases.shape[1]
        wrong = np.zeros(bases.shape, np.int16)
        for k, letter in enumerate(adapter[:width]):
            wrong[:, : width - k] += (bases[:, k:] != letter) & (bases[:, k:] != 0)
        overlap = np.minimum(len(adapter), n[:, None] - np.arange(width))
        fits = (overlap >= max(1, min_overlap)) & (wrong <= np.floor(overlap * error_rate))
        return np.where(fits.any(axis=1), fits.argmax(axis=1), n) + 1

    return work


def adapter_start(seq: Column, adapter: str, error_rate: float = 0.1, min_overlap: int = 1) -> Column:
    """First place (1-based) from which the read goes on as the adapter, or length + 1.

    At least min_overlap bases; substitutions up to error_rate of the overlap, rounded down. No
    insertions or deletions. Arrow-batched, as quality_cut.
    """
    return F.pandas_udf(lambda s: _in_steps([s], _adapter_start(adapter.encode(), error_rate, min_overlap)), "bigint")(seq)


def trim_adapter(df: DataFrame, adapter: str, error_rate: float = 0.1, min_overlap: int = 1) -> DataFrame:
    return keep_first(df, adapter_start(F.col("seq"), adapter, error_rate, min_overlap) - 1)


def clip(df: DataFrame, five: int = 0, three: int = 0) -> DataFrame:
    """Cut `five` bases from the start and then `three` from the end, each only from reads longer than that."""
    for n, front in ((five, True), (three, False)):
        if n:
            longer = F.length("seq") > n
            part = lambda c: F.substr(F.col(c), F.lit(n + 1)) if front else F.substr(F.col(c), F.lit(1), F.length("seq") - n)
            cut = {c: F.when(longer, part(c)).otherwise(F.col(c)) for c in ("qual", "seq")}
            df = df.withColumns(cut)
    return df


def hard_trim(df: DataFrame, n: int, end: int) -> DataFrame:
    """Keep n bases of the 5' end (end = 5) or of the 3' end (end = 3)."""
    if end == 5:
        return keep_first(df, F.lit(n))
    return df.withColumns({c: F.when(F.length(c) > n, F.substr(F.col(c), F.length(c) - n + 1)).otherwise(F.col(c)) for c in ("qual", "seq")})


def long_enough(df: DataFrame, least: int = 20, most: int | None = None, max_n: float | None = None) -> DataFrame:
    """Reads of at least `least` and at most `most` bases with up to max_n N (below 1: a share)."""
    n = F.length("seq") - F.length(F.replace("seq", F.lit("N"), F.lit("")))
    ok = F.length("seq") >= least
    if most is not None:
        ok = ok & (F.length("seq") <= most)
    if max_n is not None:
        ok = ok & ((n <= max_n) if max_n >= 1 or max_n == 0 else (n <= max_n * F.length("seq")))
    return df.filter(ok)


def validate_pairs(r1: DataFrame, r2: DataFrame, key: str, least: int = 20, unpaired: tuple[int, int] | None = None, max_n: int | None = None) -> DataFrame:
    """Mates joined on their ordinal: key, seq1, qual1, seq2, qual2, state.

    state: dropped if either mate has more than `max_n` N; pair if both mates have `least` bases; with
    `unpaired` = (least1, least2) also only1 or only2 where one mate alone is long enough; else
    dropped. A read without mate raises an error: one of the files was cut short.
    """
    a = r1.select(key, F.col("seq").alias("seq1"), F.col("qual").alias("qual1"), F.lit(True).alias("_1"))
    b = r2.select(key, F.col("seq").alias("seq2"), F.col("qual").alias("qual2"), F.lit(True).alias("_2"))
    both = a.join(b, key, "full_outer")
    missing = F.col("_1").isNull() | F.col("_2").isNull()
    good = (F.length("seq1") >= least) & (F.length("seq2") >= least)
    state = F.when(missing, F.raise_error(F.concat(F.lit("a mate is missing: "), F.col(key).cast("string"))))
    if max_n is not None:
        unknown = lambda c: F.length(c) - F.length(F.replace(F.upper(c), F.lit("N"), F.lit("")))
        state = state.when((unknown(F.col("seq1")) > max_n) | (unknown(F.col("seq2")) > max_n), "dropped")
    state = state.when(good, "pair")
    if unpaired:
        state = state.when(F.length("seq1") >= unpaired[0], "only1").when(F.length("seq2") >= unpaired[1], "only2")
    return both.select(key, "seq1", "qual1", "seq2", "qual2", state.otherwise("dropped").alias("state"))


def transfer_umi(pairs: DataFrame, n: int = 8) -> DataFrame:
    """The first n bases of read 2 go to the end of both names and off read 2."""
    umi = F.substr(F.col("seq2"), F.lit(1), F.lit(n))
    named = {c: F.concat(F.col(c), F.lit(":"), umi) for c in ("name1", "name2")}
    return pairs.withColumns(named).withColumns({c: F.substr(F.col(c), F.lit(n + 1)) for c in ("seq2", "qual2")})


def clock_trim(pairs: DataFrame) -> DataFrame:
    """Epigenetic clock: 8 bases UMI, CAGT, one base, then the fragment. Every pair comes out.

    Names get UMIs and the constant bases of both mates; `lacking` tells whether either mate lacks
    CAGT at its place.
    """
    part = lambda c, at, n: F.substr(F.col(c), F.lit(at), F.lit(n))
    label = F.concat(F.lit(":R1:"), part("seq1", 1, 8), F.lit(":R2:"), part("seq2", 1, 8), F.lit(":F1:"), part("seq1", 9, 4), F.lit(":F2:"), part("seq2", 9, 4))
    lacking = (part("seq1", 9, 4) != "CAGT") | (part("seq2", 9, 4) != "CAGT")
    out = pairs.withColumns({"name1": F.concat("name1", label), "name2": F.concat("name2", label), "lacking": lacking})
    return out.withColumns({c: F.substr(F.col(c), F.lit(14)) for c in ("seq1", "qual1", "seq2", "qual2")})


def trim_rrbs(df: DataFrame, before: str = "full_length", directional: bool = True) -> DataFrame:
    """Two bases more off the 3' end of reads from which an adapter was cut (shorter than `before`).

    Non-directional reads that begin with CAA or CGA lose two bases of the 5' end instead.
    """
    cut = (F.length("seq") < F.col(before)) & (F.length("seq") >= (2 if directional else 3))
    back = lambda c: F.substr(F.col(c), F.lit(1), F.length(c) - 2)
    front = lambda c: F.substr(F.col(c), F.lit(3))
    if directional:
        return df.withColumns({c: F.when(cut, back(c)).otherwise(F.col(c)) for c in ("qual", "seq")})
    filled = F.col("seq").rlike("^C[AG]A") & (F.length("seq") > 2)
    return df.withColumns({c: F.when(filled, front(c)).when(cut, back(c)).otherwise(F.col(c)) for c in ("qual", "seq")})


def detect_poly(df: DataFrame) -> DataFrame:
    """One row: reads with ten A, with ten T, and the polymer to trim (A unless T is more frequent)."""
    counts = df.agg(F.count_if(F.instr("seq", "A" * 10) > 0).alias("poly_a"), F.count_if(F.instr("seq", "T" * 10) > 0).alias("poly_t"))
    return counts.withColumn("polymer", F.when(F.col("poly_t") > F.col("poly_a"), "T").otherwise("A"))


def trim_poly(df: DataFrame, letter: str = "A", end: int = 3, least: int = 3) -> DataFrame:
    """A run of at least `least` of `letter` off the 3' end, or off the 5' end; the name gets its length in front and behind.

    Names become n:name_PolyA:n, which is how trimmed tails can be told later. Read 1 loses the
    polymer of detect_poly at its 3' end, read 2 the other one at its 5' end.
    """
    run = F.length(F.regexp_extract("seq", f"({letter}{{{least},}})$" if end == 3 else f"^({letter}{{{least},}})", 1))
    size = F.col("_run").cast("string")
    kept = df.withColumn("_run", run).withColumn("name", F.when(F.col("_run") > 0, F.concat(size, F.lit(":"), F.col("name"), F.lit(f"_Poly{letter}:"), size)).otherwise(F.col("name")))
    if end == 3:
        return keep_first(kept, F.length("seq") - F.col("_run")).drop("_run")
    return kept.withColumns({c: F.substr(F.col(c), F.col("_run") + 1) for c in ("seq", "qual")}).drop("_run")


def trim_poly_a(df: DataFrame, least: int = 3) -> DataFrame:
    """A's off the 3' end."""
    return trim_poly(df, "A", 3, least)


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), "ACGT", "TGCA")


def reject_colour_space(df: DataFrame) -> DataFrame:
    """The reads, or an error at the first whose sequence holds digits."""
    return df.withColumn("seq", F.when(F.col("seq").rlike("[0-9]"), F.raise_error(F.concat(F.lit("colour-space read: "), F.col("seq")))).otherwise(F.col("seq")))


def remove_prefixes(df: DataFrame, adapters: DataFrame) -> DataFrame:
    """Reads without the longest of the 5' adapters (column `adapter`) that they begin with.

    An equi-join per adapter length on the read's prefix.
    """
    from strandloom.storage import maybe_broadcast

    sizes = sorted((r[0] for r in adapters.select(F.length("adapter")).distinct().collect() if r[0]), reverse=True)
    table = maybe_broadcast(adapters.select(F.col("adapter").alias("_adapter"), F.length("adapter").alias("_size")).distinct())
    out = df.withColumn("_cut", F.lit(0))
    for n in sizes:
        own = table.filter(F.col("_size") == n).select(F.col("_adapter").alias("_prefix"), F.lit(n).alias("_found"))
        out = out.withColumn("_prefix", F.substr(F.col("seq"), F.lit(1), F.lit(n))).join(own, "_prefix", "left")
        out = out.withColumn("_cut", F.when(F.col("_cut") > 0, F.col("_cut")).otherwise(F.coalesce("_found", F.lit(0)))).drop("_found", "_prefix")
    return out.withColumns({c: F.substr(F.col(c), F.col("_cut") + 1) for c in ("seq", "qual")}).drop("_cut")


def report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: reads and bases before and after, as the trimming report gives them."""
    a = before.agg(F.count(F.lit(1)).alias("reads_in"), F.sum(F.length("seq")).alias("bases_in"))
    b = after.agg(F.count(F.lit(1)).alias("reads_out"), F.sum(F.length("seq")).alias("bases_out"))
    return a.withColumn("_k", F.lit(1)).join(b.withColumn("_k", F.lit(1)), "_k").drop("_k")


def summary(df: DataFrame, adapter: str, cutoff: int = 20, error_rate: float = 0.1, min_overlap: int = 1) -> DataFrame:
    """One row on quality and then adapter trimming: reads, with_adapter, bases_in, bases_quality (cut for quality), bases_adapter and bases_out.

    One pass over the reads; null sequences count as reads without bases.
    """
    by_quality = trim_quality(df.select("seq", "qual", F.length("seq").alias("_all")), cutoff).withColumn("_kept", F.length("seq"))
    cut = trim_adapter(by_quality, adapter, error_rate, min_overlap).select("_all", "_kept", F.length("seq").alias("_left"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return cut.agg(
        F.count(F.lit(1)).alias("reads"), F.count_if(F.col("_left") < F.col("_kept")).alias("with_adapter"), total(F.col("_all")).alias("bases_in"),
        total(F.col("_all") - F.col("_kept")).alias("bases_quality"), total(F.col("_kept") - F.col("_left")).alias("bases_adapter"), total(F.col("_left")).alias("bases_out"),
    )


def adapter_lengths(df: DataFrame, adapter: str, error_rate: float = 0.1, min_overlap: int = 1) -> DataFrame:
    """How often how many bases are cut from the adapter on: length, reads, expected and max_errors.

    expected is the number of reads that would end in as many bases of the adapter by chance;
    max_errors the substitutions allowed in them. Reads that keep all their bases have no row.
    """
    cut = F.length("seq") - (adapter_start(F.col("seq"), adapter, error_rate, min_overlap) - 1)
    counts = df.select(cut.cast("bigint").alias("length")).groupBy("length").agg(F.count(F.lit(1)).alias("reads"))
    matched = F.least("length", F.lit(len(adapter)))
    total = counts.agg(F.sum("reads").alias("_n"))
    return counts.filter("length > 0").join(F.broadcast(total)).select("length", "reads", (F.col("_n") * F.pow(F.lit(0.25), matched)).alias("expected"), F.floor(matched * error_rate).alias("max_errors"))
