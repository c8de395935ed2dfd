"""Barcodes: extraction from reads, correction against a whitelist, and identifiers.

A whitelist is (ord bigint, seq string). Sequences are plain text over A, C, G, T and N, so there is
no limit on their length. A read's barcode is corrected by equality joins only: either the whitelist
is expanded by its neighbours (few barcodes, many reads) or the reads that had no exact hit are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.storage import materialise, maybe_broadcast

LETTERS = "ACGT"
#: A candidate is accepted if it holds this share of the weights.
POSTERIOR = 0.975


def valid(seq: Column) -> Column:
    """Only A, C, G, T, N, in either case."""
    return seq.rlike("(?i)^[ACGTN]+$")


def without_n(df: DataFrame, seq: str) -> DataFrame:
    """Rows whose sequence is made of A, C, G and T alone."""
    return df.filter(F.upper(seq).rlike("^[ACGT]+$"))


def mean_quality_at_least(qual: Column, least: int) -> Column:
    """Whether the mean of the Phred scores (offset 33) is at least `least`; false for an empty string."""
    letters = F.filter(F.split(qual, ""), lambda c: c != "")
    return F.when(F.length(qual) > 0, F.aggregate(letters, F.lit(0), lambda a, c: a + F.ascii(c) - 33) >= least * F.length(qual)).otherwise(False)


def neighbours(seq: Column, letters: str = LETTERS) -> Column:
    """Array of structs (place, variant): all sequences that differ from `seq` in one place."""
    places = F.sequence(F.lit(1), F.length(seq))
    at = lambda i: F.transform(F.array(*[F.lit(x) for x in letters]), lambda x: F.struct(i.alias("place"), F.concat(F.substr(seq, F.lit(1), i - 1), x, F.substr(seq, i + 1)).alias("variant")))
    return F.filter(F.flatten(F.transform(places, at)), lambda v: v["variant"] != seq)


def expand(whitelist: DataFrame, mismatches: int = 1, letters: str = LETTERS, among: DataFrame | None = None) -> DataFrame:
    """variant, ord, dist: every sequence within `mismatches` substitutions of a barcode.

    Where barcodes compete for a variant the smaller distance wins, then the smaller ordinal;
    `conflicts` counts the others. among: the variants (distinct) that are wanted, all by default.
    """
    found = whitelist.select("ord", F.col("seq").alias("variant"), F.lit(0).alias("dist"))
    frontier = found
    for k in range(1, mismatches + 1):
        # as neighbours, but with rows for places and letters, which Spark compiles
        places = frontier.select("ord", "variant", F.explode(F.sequence(F.lit(1), F.length("variant"))).alias("i"))
        changed = F.concat(F.substr("variant", F.lit(1), F.col("i") - 1), "letter", F.substr("variant", F.col("i") + 1))
        parts = places.select("ord", "variant", "i", F.explode(F.array(*[F.lit(x) for x in letters])).alias("letter"))
        frontier = parts.select("ord", F.col("variant").alias("_from"), changed.alias("variant")).filter("variant <> _from").select("ord", "variant", F.lit(k).alias("dist"))
        found = found.unionByName(frontier)
    if among is not None:
        found = found.join(maybe_broadcast(among), "variant", "left_semi")
    per_barcode = found.groupBy("variant", "ord").agg(F.min("dist").alias("dist"))
    return per_barcode.groupBy("variant").agg(F.min(F.struct("dist", "ord")).alias("b"), (F.count(F.lit(1)) - 1).alias("conflicts")).select("variant", "b.ord", "b.dist", "conflicts")


def correct_exact(reads: DataFrame, whitelist: DataFrame, seq: str) -> DataFrame:
    """`reads` with `ord` of the equal barcode or null."""
    return reads.join(maybe_broadcast(whitelist.select(F.col("seq").alias(seq), "ord")), seq, "left")


def correct_sparse(reads: DataFrame, whitelist: DataFrame, seq: str, mismatches: int = 1) -> DataFrame:
    """`reads` with `ord` and `dist` of the barcode within `mismatches`, by the expanded whitelist.

    N never matches. The expanded table is broadcast if small, else joined by shuffle.
    """
    table = materialise(expand(whitelist, mismatches).select(F.col("variant").alias(seq), "ord", "dist"), "variants")
    return reads.join(maybe_broadcast(table), seq, "left")


def candidates(reads: DataFrame, whitelist: DataFrame, key: str, seq: str, qual: str, distance: int = 1) -> DataFrame:
    """key, ord, q: barcodes exactly `distance` substitutions away from a read without exact hit, with the sum of the Phred scores there.

    The read is expanded, so that an N in it may stand for any letter. Places are changed from left
    to right, so that each variant comes once.
    """
    missed = reads.join(maybe_broadcast(whitelist.select(F.col("seq").alias(seq))), seq, "left_anti")
    variants = missed.select(key, F.col(qual).alias("_qual"), F.explode(neighbours(F.col(seq))).alias("v")).select(key, "_qual", "v", F.expr("0L").alias("_before"))
    score = (F.ascii(F.substr("_qual", F.col("v.place"), F.lit(1))) - 33).cast("bigint")
    for _ in range(distance - 1):
        variants = variants.select(key, "_qual", (F.col("_before") + score).alias("_before"), F.explode(F.filter(neighbours(F.col("v.variant")), lambda w: w["place"] > F.col("v.place"))).alias("v"))
    return variants.select(key, F.col("v.variant").alias("seq"), (F.col("_before") + score).alias("q")).join(maybe_broadcast(whitelist), "seq").select(key, "ord", "q")


def decide(found: DataFrame, key: str, mode: str, priors: DataFrame | None = None) -> DataFrame:
    """key, ord, share: the accepted candidate of each read.

    minq: the smallest score. fcfg: the smallest ordinal. rnat: the smallest score, if one candidate
    holds POSTERIOR of the weights 10 ** (-q / 10). atact (also default): the candidate with that
    share, weights times max(prior, 1); priors: ord, prior. Ties go to the smaller ordinal.
    """
    weight = F.pow(F.lit(10.0), -F.col("q") / 10.0)
    if mode in ("atact", "default"):
        if priors is None:
            raise ValueError("mode atact needs priors")
        found = found.join(maybe_broadcast(priors), "ord", "left")
        weight = weight * F.greatest(F.coalesce("prior", F.lit(1)), F.lit(1))
    elif mode not in ("rnat", "minq", "fcfg"):
        raise ValueError(f"unknown mode {mode}")
    weighed = found.withColumn("_w", weight)
    by_score, by_weight = F.struct("q", "ord"), F.struct((-F.col("_w")).alias("w"), F.col("ord").alias("o"))
    summed = weighed.groupBy(key).agg(
        F.min_by("ord", by_score).alias("nearest"), F.min("ord").alias("first"), F.min_by("ord", by_weight).alias("likeliest"), (F.max("_w") / F.sum("_w")).alias("share")
    )
    if mode == "fcfg":
        return summed.select(key, F.col("first").alias("ord"), "share")
    if mode == "minq":
        return summed.select(key, F.col("nearest").alias("ord"), "share")
    chosen = "nearest" if mode == "rnat" else "likeliest"
    return summed.filter(F.col("share") >= POSTERIOR).select(key, F.col(chosen).alias("ord"), "share")


def exact_counts(reads: DataFrame, whitelist: DataFrame, seq: str) -> DataFrame:
    """ord, prior: reads with exactly this barcode."""
    return reads.join(maybe_broadcast(whitelist.select(F.col("seq").alias(seq), "ord")), seq).groupBy("ord").agg(F.count(F.lit(1)).alias("prior"))


def correct(reads: DataFrame, whitelist: DataFrame, key: str, seq: str, qual: str, mode: str = "default", mismatches: int = 1) -> DataFrame:
    """Two rounds: exact hits first, whose counts are the priors; then what was missed, by `mode`.

    The second round goes through the distances 1 to `mismatches`: at each only the reads that the ones
    before left undecided are expanded, and all candidates found so far are weighed together.
    Columns key, ord, round (0 or 1). Reads without a barcode drop out.
    """
    out = reads.join(maybe_broadcast(whitelist.select(F.col("seq").alias(seq), "ord")), seq).select(key, "ord", F.lit(0).alias("round"))
    priors = exact_counts(reads, whitelist, seq) if mode in ("default", "atact") else None
    return out.unionByName(resolve(reads, whitelist, key, seq, qual, mode, priors, mismatches).select(key, "ord", F.lit(1).alias("round")))


def resolve(reads: DataFrame, whitelist: DataFrame, key: str, seq: str, qual: str, mode: str, priors: DataFrame | None, mismatches: int = 1) -> DataFrame:
    """key, ord of the reads without an exact hit that `mode` decides, going through the distances 1 to `mismatches`."""
    out = found = None
    for distance in range(1, mismatches + 1):
        level = candidates(reads, whitelist, key, seq, qual, distance)
        found = level if found is None else found.unionByName(level)
        last = distance == mismatches
        found = found if last else materialise(found, "candidates")
        later = decide(found, key, mode, priors).select(key, "ord")
        if not last:
            later = materialise(later, "decided")
            reads, found = (x.join(later.select(key), key, "left_anti") for x in (reads, found))
        out = later if out is None else out.unionByName(later)
    return out


def random_codes(reads: DataFrame, seq: str, kind: str) -> DataFrame:
    """Each distinct sequence is a code of its own: code (kind:seq) and reads."""
    return reads.filter(F.col(seq).isNotNull()).groupBy(F.concat(F.lit(f"{kind}:"), F.col(seq)).alias("code")).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Hole:
    """One place of a chain: alternatives (whitelist names) in order of priority, and how far to look."""

    name: str
    alternatives: tuple[str, ...]
    space: int = 0
    laxity: int = 0
    length: tuple[int, int] = (16, 16)


def scan_chain(reads: DataFrame, key: str, seq: str, holes: list[Hole], barcodes: DataFrame, position: int = 1) -> DataFrame:
    """Barcodes of a chain read from left to right: key, `pos` (next base) and name, name_type per hole.

    barcodes: type, ord, seq (variants of expand with their type are as good). At each hole every
    alternative, shift up to `laxity` and length are tried; the first hit in that order of precedence
    is taken and the cursor moves to its end. A hole without a hit gives null and moves the cursor by
    its space and longest length. Each hole is one explode and one equality join.
    """
    state = reads.select(key, F.col(seq).alias("_seq"), F.lit(position).cast("int").alias("pos"))
    kept: list[str] = []
    table = maybe_broadcast(barcodes.select(F.col("type").alias("_type"), F.col("ord").alias("_ord"), F.col("seq").alias("_sub")))
    for hole in holes:
        tries = F.array(
            *[
                F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("type"), F.lit(hole.space + shift + size).alias("move"), F.substr("_seq", F.col("pos") + hole.space + shift, F.lit(size)).alias("sub"))
                for rank, (kind, shift, size) in enumerate((kind, shift, size) for kind in hole.alternatives for shift in range(hole.laxity + 1) for size in range(hole.length[0], hole.length[1] + 1))
            ]
        )
        tried = state.select(key, F.explode(tries).alias("t")).select(key, F.col("t.rank").alias("_rank"), F.col("t.move").alias("_move"), F.col("t.type").alias("_type"), F.col("t.sub").alias("_sub"))
        hits = tried.join(table, ["_type", "_sub"]).groupBy(key).agg(F.min(F.struct("_rank", "_ord", "_type", "_move")).alias("_hit"))
        state = state.join(hits, key, "left").select(
            key, "_seq", *kept, (F.col("pos") + F.coalesce("_hit._move", F.lit(hole.space + hole.length[1]))).alias("pos"), F.col("_hit._ord").alias(hole.name), F.col("_hit._type").alias(f"{hole.name}_type")
        )
        kept += [hole.name, f"{hole.name}_type"]
    return state.select(key, "pos", *kept)


def chain_status(scanned: DataFrame, names: list[str]) -> DataFrame:
    """Reads by which holes were found (bit i for hole i), with 0 for combinations that don't occur."""
    mask = sum((F.when(F.col(n).isNotNull(), 1 << i).otherwise(0) for i, n in enumerate(names)), F.lit(0)).cast("bigint")
    n = scanned.groupBy(mask.alias("mask")).agg(F.count(F.lit(1)).alias("reads"))
    return scanned.sparkSession.range(1 << len(names)).withColumnRenamed("id", "mask").join(n, "mask", "left").select("mask", F.coalesce("reads", F.lit(0)).cast("bigint").alias("reads"))


def identifier_key(parts: list[tuple[str, bool]]) -> Column:
    """Key of an identifier: the ordinals of its holes joined by -, without variable ones; null if a hole is missing.

    parts: (column, variable). Variable holes (such as those that tell DNA from RNA) are needed but
    not part of the key, so reads of both kinds share an id.
    """
    found = F.lit(True)
    for column, _ in parts:
        found = found & F.col(column).isNotNull()
    return F.when(found, F.concat_ws("-", *[F.col(c).cast("string") for c, variable in parts if not variable]))


def matches_at(types: Column, pattern: list[set[str] | None], anchor: int | None = None) -> Column:
    """First place (0-based) where the array `types` of found barcode types fits the pattern, or null.

    An element of the pattern is a set of types or None for any; null in `types` is a barcode that
    was not found and fits nothing. With `anchor` only that place is tried.
    """

    def fits(i: Column) -> Column:
        ok = F.lit(True)
        for k, allowed in enumerate(pattern):
            value = F.get(types, i + k)
            ok = ok & F.coalesce(value.isNotNull() if allowed is None else value.isin(sorted(allowed)), F.lit(False))
        return ok

    places = F.array(F.lit(anchor)) if anchor is not None else F.when(F.size(types) >= len(pattern), F.sequence(F.lit(0), F.size(types) - len(pattern))).otherwise(F.array().cast("array<int>"))
    return F.get(F.filter(places, fits), F.lit(0))


def assign_ids(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """key, id, n: ids 1, 2, ... of distinct keys in key order, and rows of each.

    known: an earlier table (key, id). Its keys keep their ids, new ones follow its largest id. Keys
    are numbered in ranges of the order, so that no task holds all of them. Null keys get no id.
    """
    from strandloom.operators.cells import _ids

    counted = keys.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    if known is None:
        return _ids(counted, [key], "id").select(key, "id", "n")
    old = counted.join(known.select(key, "id"), key)
    start = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_start"))
    new = _ids(counted.join(known, key, "left_anti"), [key], "_new").join(F.broadcast(start)).select(key, (F.col("_start") + F.col("_new")).alias("id"), "n")
    return old.select(key, "id", "n").unionByName(new)


def read_types(df: DataFrame, dna: Column, rna: Column, full: Column) -> DataFrame:
    """Counts of DNA, RNA and other reads, fully barcoded or not: one row of ten counters."""
    other = ~dna & ~rna
    cases = {"dna": dna, "rna": rna, "ndnr": other}
    out = [F.count(F.lit(1)).alias("reads"), F.count_if(full).alias("full")]
    out += [F.count_if(c).alias(k) for k, c in cases.items()]
    out += [F.count_if(c & full).alias(f"{k}_full") for k, c in cases.items()]
    out += [F.count_if(dna & rna).alias("both"), F.count_if(~full).alias("partial")]
    return df.agg(*out)
