"""The refinement stage of the methods: from alignments with annotated names to groups, pairs and matrices.

A pipeline composes operators and returns DataFrames. Building one runs the steps that others depend
on (heavy keys, written intermediate tables); its results run when they are written.
Aligners stand outside: a pipeline takes alignments (qname, flag, rname, pos, mapq, cigar).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators import alignments as A
from strandloom.operators import cells as X
from strandloom.operators import cluster as C
from strandloom.operators import genomic as G


#: Resolutions of the contact maps, in bases.
RESOLUTIONS = [2_500_000, 1_000_000, 500_000, 250_000, 100_000, 50_000, 25_000, 10_000, 5_000, 1_000]


@dataclass(frozen=True)
class Method:
    """How a method refines: which alignments it takes, how it groups, and what is made of the groups.

    unique: alignments of exactly this mapping quality, whatever their flag; else primary ones of at
    least min_mapq. mate: one mate alone. mask: alignments over the blacklist go first. by: what makes
    two fragments of a group duplicates. merge: distance and extension; no duplicates are removed then.
    """

    group: str
    parent: str | None = None
    min_mapq: int = 30
    unique: int | None = None
    mate: int | None = None
    tn5: bool = False
    strict: bool = False
    mask: bool = False
    by: tuple[str, ...] = ("chr", "start_pos")
    merge: tuple[int, int] | None = None
    without_names: bool = False
    split: bool = False
    contacts: bool = False
    matrix: bool = False
    rna: int | None = None


METHODS = {
    "chiadrop": Method("COMPLEX", mate=1, merge=(3000, 100), split=True, without_names=True, contacts=True),
    "sprite": Method("COMPLEX", mask=True, split=True),
    "rdsprite": Method("COMPLEX", split=True, rna=255),
    "scsprite": Method("COMPLEX", parent="CELL", unique=255, split=True),
    "scatac": Method("CELL", strict=True, tn5=True, by=tuple(C.FRAGMENT), matrix=True),
    "arcatac": Method("CELL", strict=True, tn5=True, by=tuple(C.FRAGMENT), matrix=True),
}


def taken(alignments: DataFrame, method: Method, blacklist: DataFrame | None = None) -> DataFrame:
    """The alignments that a method groups."""
    rows = alignments.filter(F.col("mapq") == method.unique) if method.unique is not None else A.usable(alignments, method.min_mapq)
    if method.mask and blacklist is not None:
        placed = rows.withColumns({"chr": F.col("rname"), "start_pos": F.col("pos"), "end_pos": F.col("pos") + A.reference_length(F.col("cigar"))})
        place = ["qname", "flag", "chr", "start_pos", "end_pos"]
        hit = G.overlaps(placed.select(*place), blacklist.select(*C.FRAGMENT)).select(*place).distinct()
        rows = placed.join(hit, place, "left_anti").select(*alignments.columns)
    return A.one_mate(rows, method.mate) if method.mate else rows


def grouped_fragments(alignments: DataFrame, method: Method, blacklist: DataFrame | None = None) -> DataFrame:
    """Fragments in the long form: gid, parent (or null), idx, chr, start_pos, end_pos.

    Fragments with no id of the method's kind are left out. idx orders by place, which is the order
    of a sorted alignment file.
    """
    placed = A.fragment(A.mates(taken(alignments, method, blacklist), method.strict))
    if method.tn5:
        placed = A.tn5_shift(placed)
    ids = A.split_name(F.col("qname"))["ids"]
    parent = ids[method.parent] if method.parent else F.lit(None).cast("string")
    rows = placed.select(ids[method.group].alias("gid"), parent.alias("parent"), "qname", *C.FRAGMENT).filter("gid is not null")
    return rows.withColumn("idx", F.struct("chr", "start_pos", "end_pos", "qname")).drop("qname")


def refine(alignments: DataFrame, name: str, blacklist: DataFrame | None = None, peak: dict | None = None, rna: DataFrame | None = None, contacts: bool = True) -> dict[str, DataFrame]:
    """The results of a method by name.

    All: `fragments`. Those that remove duplicates: `dedup`. By method: `regions` (with sub_id, the
    group and the place of its chromosome), `lengths` of the refined fragments, `spans` and `histogram`
    of the regions, `contacts` (of all pairs of a region, whatever their distance), `coverage`, `peaks`
    and `counts`; with alignments `rna`: `rna` (its own results) and `mixed`, the lengths of both kinds.
    Contact maps are written one from the other, so they are made at once; `contacts` = False leaves them out.
    """
    method = METHODS[name]
    return _refine(alignments, replace(method, contacts=method.contacts and contacts), blacklist, peak, rna)


def _refine(alignments: DataFrame, method: Method, blacklist: DataFrame | None, peak: dict | None, rna: DataFrame | None) -> dict[str, DataFrame]:
    frags = grouped_fragments(alignments, method, blacklist)
    keys = ["parent", "gid"] if method.parent else ["gid"]
    out = {"fragments": frags}
    if method.merge:
        refined = C.merge(frags, ["gid"], *method.merge).withColumn("idx", F.struct("chr", "start_pos", "end_pos"))
    else:
        refined = out["dedup"] = C.dedup(frags, keys, list(method.by))
    if method.split:
        regions = C.split_by_chromosome(refined, "gid")
        out["regions"] = C.without_names(regions, "chr") if method.without_names else regions
        out["lengths"] = C.lengths(out["regions"] if method.merge else refined, "sub_id" if method.merge else "gid", "start_pos")
        out["spans"] = C.spans(out["regions"], ["sub_id"])
        out["histogram"] = C.count_histogram(out["regions"], "sub_id")
    if method.contacts:
        out["contacts"] = G.group_contacts(out["regions"], ["sub_id"], RESOLUTIONS)
    if method.matrix:
        single = out["dedup"].withColumnRenamed("gid", "cell")
        out["coverage"] = G.coverage(single)
        out["peaks"] = G.peaks(out["coverage"], **(peak or {}))
        out["counts"] = X.peak_cell_counts(single, out["peaks"])
    if rna is not None and method.rna is not None:
        out["rna"] = _refine(rna, replace(method, unique=method.rna, rna=None), None, None, None)
        out["mixed"] = C.labelled_union({"DNA": out["lengths"], "RNA": out["rna"]["lengths"]})
    return out


def atac_cells(refined: dict[str, DataFrame], lower: int = 100) -> DataFrame:
    """Cells of an ATAC run beyond the inflection of their fragment counts."""
    totals = refined["dedup"].groupBy(F.col("gid").alias("cell")).agg(F.count(F.lit(1)).alias("total"))
    return X.called(totals, lower)
