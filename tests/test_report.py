"""Reports of the methods."""

import pytest

from strandloom.plans.report import METRICS, report

READS = [(True, "1", "9"), (True, "1", "8"), (False, None, None), (None, "2", "9")]
DEDUP = [("a", 2), ("a", 1), ("b", 4)]


@pytest.mark.parametrize("method", sorted(METRICS))
def test_report(spark, method):
    reads = spark.createDataFrame(READS, "full boolean, cell string, complex string")
    dedup = spark.createDataFrame(DEDUP, "gid string, dup bigint")
    counts = spark.createDataFrame([("1", 3), ("2", 1)], "cell string, n bigint")
    peaks = spark.createDataFrame([("chr1",)], "chr string")
    tables = {"dedup": dedup, "counts": counts, "peaks": peaks}
    got = {r.metric: r.value for r in report(method, reads, tables).collect()}
    assert sorted(got) == sorted(METRICS[method])
    known = {"Total_read_pairs": "4", "Read_pairs_with_full_barcodes": "2", "Fully_barcode_rate": "0.5", "Total_fragments": "7", "Duplicated_fragments": "4", "Duplication_rate": "0.571428"}
    known |= {"Cell_count_at_fastq": "2", "Complex_count_at_fastq": "2", "Refined_complex": "2", "Total_qualified_fragment": "3", "Fragments_overlap_peak": "4", "Peak_count": "1", "Cell_count": "2"}
    assert got == {m: known[m] for m in METRICS[method]}
    empty = {r.metric: r.value for r in report(method, reads.limit(0), {k: v.limit(0) for k, v in tables.items()}).collect()}
    assert empty["Total_fragments"] == "0" and empty["Duplication_rate"] is None
