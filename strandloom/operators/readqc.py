"""Quality control of reads (seq, qual; Phred offset 33), one function per module.

Every module is a partial aggregation with few keys (position, base, score), so that only counts are
shuffled. Percentiles come from the counts per score, exactly. Grades are pass, warn or fail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Thresholds (warn, fail) of the modules.
LIMITS = {
    "quality_lower": (10, 5), "quality_median": (25, 20), "sequence_quality": (27, 20), "composition": (10, 20), "gc": (15, 30), "n_content": (5, 20),
    "duplication": (70, 50), "overrepresented": (0.1, 1), "adapter": (5, 10), "tile": (5, 10), "kmer": (2, 5),
}

# Adapters whose content is reported.
ADAPTERS = {
    "Illumina Universal Adapter": "AGATCGGAAGAG",
    "Illumina Small RNA 3' Adapter": "TGGAATTCTCGG",
    "Illumina Small RNA 5' Adapter": "GATCGTCGGACT",
    "Nextera Transposase Sequence": "CTGTCTCTTATA",
    "SOLID Small RNA Adapter": "CGCCTTGGCCGT",
}


def grade(value: Column, limit: str) -> Column:
    """Against LIMITS: beyond the second fails, beyond the first warns; below where small is bad."""
    warn, fail = LIMITS[limit]
    bad = (lambda x: value < x) if fail < warn else (lambda x: value > x)
    return F.when(bad(fail), "fail").when(bad(warn), "warn").otherwise("pass")


def _bases(df: DataFrame) -> DataFrame:
    return df.select(F.posexplode(F.split("seq", "")).alias("i", "base")).filter("base <> ''").select((F.col("i") + 1).cast("bigint").alias("pos"), "base")


def _scores(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.posexplode(F.split("qual", "")).alias("i", "c")).filter("c <> ''").select(*keep, (F.col("i") + 1).cast("bigint").alias("pos"), (F.ascii("c") - 33).cast("bigint").alias("q"))


def basic(df: DataFrame) -> DataFrame:
    """reads, shortest, longest, gc (percent, rounded down)."""
    strong = F.length("seq") - F.length(F.regexp_replace("seq", "[GCgc]", ""))
    known = F.length("seq") - F.length(F.regexp_replace("seq", "[ACGTacgt]", ""))
    return df.agg(F.count(F.lit(1)).alias("reads"), F.min(F.length("seq")).cast("bigint").alias("shortest"), F.max(F.length("seq")).cast("bigint").alias("longest"), F.floor(F.sum(strong) * 100 / F.sum(known)).alias("gc"))


def per_base_quality(df: DataFrame) -> DataFrame:
    """pos, mean, and the scores at 10, 25, 50, 75, 90 percent of the reads (lower ranks), with grade."""
    counts = _scores(df).groupBy("pos", "q").agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("pos").orderBy("q")
    ranked = counts.withColumn("upto", F.sum("k").over(w)).withColumn("n", F.sum("k").over(Window.partitionBy("pos")))
    at = lambda p: F.min(F.when(F.col("upto") * 100 >= F.col("n") * p, F.col("q"))).alias(f"p{p}")
    out = ranked.groupBy("pos").agg((F.sum(F.col("q") * F.col("k")) / F.sum("k")).alias("mean"), *[at(p) for p in (10, 25, 50, 75, 90)])
    lower, median = grade(F.col("p25"), "quality_lower"), grade(F.col("p50"), "quality_median")
    return out.withColumn("grade", F.when((lower == "fail") | (median == "fail"), "fail").when((lower == "warn") | (median == "warn"), "warn").otherwise("pass"))


def per_sequence_quality(df: DataFrame) -> DataFrame:
    """Reads by mean score, rounded down."""
    codes = F.transform(F.filter(F.split("qual", ""), lambda c: c != ""), lambda c: (F.ascii(c) - 33).cast("bigint"))
    mean = F.aggregate(codes, F.lit(0).cast("bigint"), lambda a, x: a + x) / F.length("qual")
    return df.filter(F.length("qual") > 0).groupBy(F.floor(mean).alias("mean_quality")).agg(F.count(F.lit(1)).alias("reads"))


def composition(df: DataFrame) -> DataFrame:
    """pos, percent of a, c, g, t among them, and the grade of the larger difference of A to T and G to C."""
    letters = {b: F.count_if(F.upper("base") == b) for b in "ACGT"}
    known = F.count_if(F.upper("base").isin(*"ACGT"))
    out = _bases(df).groupBy("pos").agg(*[(100.0 * n / known).alias(b.lower()) for b, n in letters.items()])
    return out.withColumn("grade", grade(F.greatest(F.abs(F.col("a") - F.col("t")), F.abs(F.col("g") - F.col("c"))), "composition"))


def gc_content(df: DataFrame) -> DataFrame:
    """Reads by GC percent (rounded), and what a normal distribution with the same mode and spread gives."""
    strong = F.length("seq") - F.length(F.regexp_replace("seq", "[GCgc]", ""))
    counts = df.filter(F.length("seq") > 0).groupBy(F.round(strong * 100 / F.length("seq")).cast("bigint").alias("gc")).agg(F.count(F.lit(1)).alias("reads"))
    shape = counts.agg(F.max_by("gc", F.struct("reads", "gc")).alias("mode"), F.sum("reads").alias("n"), F.collect_list(F.struct("gc", "reads")).alias("all"))
    spread = F.sqrt(F.aggregate("all", F.lit(0.0), lambda a, x: a + F.pow((x["gc"] - F.col("mode")).cast("double"), 2) * x["reads"]) / F.greatest(F.col("n") - 1, F.lit(1)))
    theory = counts.join(F.broadcast(shape.select("mode", "n", spread.alias("sd"))))
    bell = F.col("n") * F.exp(-F.pow(F.col("gc") - F.col("mode"), 2) / (2 * F.pow("sd", 2))) / (F.col("sd") * 2.5066282746310002)
    return theory.select("gc", "reads", F.when(F.col("sd") > 0, bell).otherwise(F.col("reads")).alias("expected"))


def gc_grade(df: DataFrame) -> DataFrame:
    """`value`: by how many percent of the reads the GC curve and the expected one differ, summed over 0 to 100 percent; graded."""
    counts = gc_content(df).select("gc", "reads")
    n, mode = F.sum("reads"), F.max_by("gc", F.struct("reads", "gc"))
    shape = counts.agg(n.alias("n"), mode.alias("mode"), F.collect_list(F.struct("gc", "reads")).alias("all")).filter("n is not null")
    spread = F.sqrt(F.aggregate("all", F.lit(0.0), lambda a, x: a + F.pow((x["gc"] - F.col("mode")).cast("double"), 2) * x["reads"]) / F.greatest(F.col("n") - 1, F.lit(1)))
    grid = shape.select("n", "mode", spread.alias("sd"), F.map_from_entries("all").alias("seen"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(100).cast("bigint"))).alias("gc"))
    seen = F.coalesce(F.col("seen")[F.col("gc")], F.lit(0))
    bell = F.col("n") * F.exp(-F.pow(F.col("gc") - F.col("mode"), 2) / (2 * F.pow("sd", 2))) / (F.col("sd") * 2.5066282746310002)
    off = F.when(F.col("sd") > 0, F.abs(seen - bell)).otherwise(0.0)
    return grid.agg((100.0 * F.sum(off) / F.max("n")).alias("value")).withColumn("grade", grade(F.col("value"), "gc"))


def lengths_grade(df: DataFrame) -> DataFrame:
    """`value`: how many lengths there are; warns where reads differ in length, fails where one is empty."""
    d = lengths(df).agg(F.count(F.lit(1)).cast("double").alias("value"), F.min("length").alias("_least"))
    return d.select("value", F.when(F.col("_least") == 0, "fail").when(F.col("value") > 1, "warn").otherwise("pass").alias("grade"))


def adapter_grade(df: DataFrame) -> DataFrame:
    """`value`: the largest percent of reads that have begun an adapter, graded."""
    return adapter_content(df).agg(F.max("percent").alias("value")).withColumn("grade", grade(F.col("value"), "adapter"))


def n_content(df: DataFrame) -> DataFrame:
    """pos and percent of N, graded."""
    return _bases(df).groupBy("pos").agg((100.0 * F.count_if(F.upper("base") == "N") / F.count(F.lit(1))).alias("n")).withColumn("grade", grade(F.col("n"), "n_content"))


def lengths(df: DataFrame) -> DataFrame:
    """Reads by length."""
    return df.groupBy(F.length("seq").cast("bigint").alias("length")).agg(F.count(F.lit(1)).alias("reads"))


def _cut(seq: str = "seq") -> Column:
    return F.when(F.length(seq) > 75, F.substr(F.col(seq), F.lit(1), F.lit(50))).otherwise(F.col(seq))


def duplication(df: DataFrame) -> DataFrame:
    """Duplication levels (1 to 9, then 10 and more): sequences, reads. Reads over 75 bases count by their first 50.

    All reads are tracked, not only those first seen early, so the levels are those of the library.
    """
    levels = df.groupBy(_cut().alias("s")).agg(F.count(F.lit(1)).alias("k"))
    return levels.groupBy(F.least("k", F.lit(10)).alias("level")).agg(F.count(F.lit(1)).alias("sequences"), F.sum("k").alias("reads"))


def remaining(df: DataFrame) -> DataFrame:
    """Percent of the reads that would remain after removing duplicates, graded."""
    d = duplication(df).agg((100.0 * F.sum("sequences") / F.sum("reads")).alias("remaining"))
    return d.withColumn("grade", grade(F.col("remaining"), "duplication"))


def overrepresented(df: DataFrame, percent: float = 0.1) -> DataFrame:
    """Sequences (first 50 bases of reads over 75) in more than `percent` of the reads: sequence, reads, percent, grade."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    counts = df.groupBy(_cut().alias("sequence")).agg(F.count(F.lit(1)).alias("reads"))
    share = counts.join(F.broadcast(n)).select("sequence", "reads", (100.0 * F.col("reads") / F.col("n")).alias("percent"))
    return share.filter(F.col("percent") > percent).withColumn("grade", grade(F.col("percent"), "overrepresented"))


def contaminants(found: DataFrame, known: DataFrame, overlap: int = 20) -> DataFrame:
    """`found` (sequence) with the known contaminants (name, contaminant) that share `overlap` bases exactly.

    Equi-join on windows of `overlap` bases; one mismatch is allowed by halves: a shared half of the
    window and up to one difference in the whole.
    """
    half = overlap // 2
    windows = lambda c: F.transform(F.sequence(F.lit(1), F.length(c) - overlap + 1), lambda i: F.substr(F.col(c), i, F.lit(overlap)))
    cut = lambda df, c, name: df.filter(F.length(c) >= overlap).select("*", F.explode(windows(c)).alias(name)).withColumn("_half", F.explode(F.array(F.concat(F.lit("L"), F.substr(F.col(name), F.lit(1), F.lit(half))), F.concat(F.lit("R"), F.substr(F.col(name), F.lit(half + 1))))))
    a, b = cut(found.select("sequence"), "sequence", "_a"), cut(known, "contaminant", "_b")
    wrong = F.size(F.filter(F.sequence(F.lit(1), F.lit(overlap)), lambda i: F.substr("_a", i, F.lit(1)) != F.substr("_b", i, F.lit(1))))
    return a.join(b, "_half").filter(wrong <= 1).select("sequence", "name").distinct()


def adapter_content(df: DataFrame) -> DataFrame:
    """adapter, pos, percent of the reads that have begun it by that place."""
    n = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("seq")).alias("longest"))
    seen = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("adapter"), F.instr("seq", a).alias("pos")) for k, a in ADAPTERS.items()])).alias("s")).select("s.*")
    starts = seen.groupBy("adapter", "pos").agg(F.count(F.lit(1)).alias("k"))
    names = df.sparkSession.createDataFrame([(k,) for k in ADAPTERS], "adapter string")
    grid = names.join(F.broadcast(n)).select("adapter", "n", F.explode(F.sequence(F.lit(1), F.col("longest"))).alias("pos"))
    w = Window.partitionBy("adapter").orderBy("pos")
    upto = F.sum(F.coalesce("k", F.lit(0))).over(w)
    return grid.join(starts, ["adapter", "pos"], "left").select("adapter", F.col("pos").cast("bigint").alias("pos"), (100.0 * upto / F.col("n")).alias("percent"))


def kmers(df: DataFrame, k: int = 7) -> DataFrame:
    """kmer, pos, seen, expected (its even share of the k-mers at that place), ratio, z.

    z is the normal approximation of the binomial test; every read counts.
    """
    at = F.transform(F.sequence(F.lit(1), F.length("seq") - k + 1), lambda i: F.substr("seq", i, F.lit(k)))
    rows = df.filter(F.length("seq") >= k).select(F.posexplode(at).alias("i", "kmer")).select((F.col("i") + 1).cast("bigint").alias("pos"), "kmer").filter("kmer not like '%N%'")
    seen = rows.groupBy("kmer", "pos").agg(F.count(F.lit(1)).alias("seen"))
    of_kmer = seen.groupBy("kmer").agg(F.sum("seen").alias("_k"))
    of_pos = seen.groupBy("pos").agg(F.sum("seen").alias("_p"))
    whole = of_pos.agg(F.sum("_p").alias("_n"))
    joined = seen.join(of_kmer, "kmer").join(F.broadcast(of_pos.join(F.broadcast(whole))), "pos")
    expected = F.col("_k") / F.col("_n") * F.col("_p")
    return joined.select("kmer", "pos", "seen", expected.alias("expected"), (F.col("seen") / expected).alias("ratio"), ((F.col("seen") - expected) / F.sqrt(expected * (1 - F.col("_k") / F.col("_n")))).alias("z"))


def tiles(df: DataFrame, name: str = "name") -> DataFrame:
    """tile, pos, mean score less the mean of all tiles there, graded; the tile is the fifth field of the name."""
    rows = _scores(df.withColumn("tile", F.get(F.split(name, ":"), F.lit(4))).filter("tile is not null"), "tile").groupBy("tile", "pos").agg(F.sum("q").alias("s"), F.count(F.lit(1)).alias("k"))
    all_tiles = rows.groupBy("pos").agg(F.sum("s").alias("ss"), F.sum("k").alias("kk"))
    off = rows.join(F.broadcast(all_tiles), "pos").select("tile", "pos", (F.col("s") / F.col("k") - F.col("ss") / F.col("kk")).alias("deviation"))
    return off.withColumn("grade", grade(-F.col("deviation"), "tile"))
