"""Report lines and the samples that can be run again, on small cases."""

from lanefold.operators import store
from lanefold.operators import verdict as V


def test_provisional_report(spark):
    kind = "sample string, flags array<string>, reliable boolean, estimated_genome_size long, size_min long, size_max long, coverage double, coverage_status string, kmercov double, fit string"
    rows = [("x", [], True, 1234567, 1200000, 1234567, 60.25, "EXCELLENT", 1.25, "reseeded"), ("y", ["a", "b"], False, 0, None, 0, 0.0, V.UNRELIABLE, None, None), (None, None, None, None, None, None, None, None, 0.0, None)]
    got = {}
    for r in V.report_lines(spark.createDataFrame(rows, kind)).orderBy("line_no").collect():
        got.setdefault(r["sample"], []).append(r["line"])
        assert r.line_no == len(got[r["sample"]])
    x, y, none = (" | ".join(got[k]) for k in ("x", "y", None))
    assert "Verdict: PROVISIONAL" in x and "ASSEMBLY CROSS-CHECK:" not in x and "  Fit: reseeded (" in x
    assert "  Estimated genome size: 1,234,567 bp |   Genome size range: 1,200,000 - 1,234,567 bp" in x
    assert "  Status: EXCELLENT coverage (60.2x)" in x and "kmercov): 1.2x" in x and "none detected" in x
    assert "  Estimated genome size: none |   Estimated heterozygosity: NA - NA" in y and "Fit:" not in y.replace("Model fit", "").replace("Fitted", "")
    assert "  Genome size warnings: a, b |   Status: UNRELIABLE_GENOME_SIZE_ESTIMATE (theoretical coverage 0.0x, not trustworthy)" in y
    assert "Sample ID: NA" in none and "reliable: no" in none and "Status: NA coverage (0.0x) |   Recommendation: NA" in none
    assert V.report_lines(spark.createDataFrame([], kind)).count() == 0


def test_safe_to_rerun(spark):
    rows = [("a", "1", True, True), ("b", "1", False, None), ("b", "1", True, False), ("c", "1", None, True), ("d", None, True, None)]
    got = store.safe_to_rerun(spark.createDataFrame(rows, "og_id string, seq_date string, valid boolean, committed boolean"), ["og_id", "seq_date"])
    assert sorted(tuple(r) for r in got.collect()) == [("b", "1"), ("c", "1"), ("d", None)]
