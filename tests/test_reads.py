"""Reasons of filtering, summaries, profiles and shares of reads on small cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanefold.operators import reads as R
from lanefold.sources.sheets import read_assignments

PAIR = "sample string, read_id long, seq1 string, seq2 string, qual1 string, qual2 string"


def test_filter_reasons(spark):
    good = "I" * 20
    rows = [
        ("a", 1, "A" * 20, "C" * 20, good, good), ("a", 2, "A" * 20, "C" * 20, good, "#" * 9 + "I" * 11), ("a", 3, "A" * 20, "C" * 20, "#" * 8 + "I" * 12, good),
        ("a", 4, "N" * 6 + "A" * 14, "C" * 20, good, good), ("a", 5, "N" * 6 + "A" * 14, "C" * 3, good, "III"), ("a", 6, "A" * 31, "C" * 3, "I" * 31, "III"),
        ("a", 7, "A" * 20, None, good, None), ("b", 8, "", None, "", None), (None, 9, "G" * 20, "G" * 20, None, None),
    ]
    judged = R.filter_reasons(spark.createDataFrame(rows, PAIR), longest=30)
    got = {r.read_id: r.reason for r in judged.collect()}
    assert got == {1: "passed", 2: "low_quality", 3: "passed", 4: "too_many_n", 5: "too_short", 6: "too_long", 7: "too_short", 8: "too_short", 9: "passed"}
    by = {r["sample"]: r for r in R.filter_summary(judged).collect()}
    a = by["a"]
    assert (a.passed_filter_reads, a.low_quality_reads, a.too_many_n_reads, a.too_short_reads, a.too_long_reads) == (4, 2, 2, 3, 2)
    assert (a.raw_total_reads, a.raw_total_bases, a.total_reads, a.total_bases, a.q30_bases, a.gc_content) == (13, 237, 4, 80, 72, 0.5)
    assert (a.raw_read1_mean_length, a.raw_read2_mean_length, a.read1_mean_length, a.read2_mean_length) == (21, 14, 20, 20)
    assert (by["b"].total_reads, by["b"].gc_content, by["b"].read2_mean_length, by["b"].too_short_reads) == (0, 0.0, 0, 1)
    assert (by[None].total_bases, by[None].q20_bases, by[None].gc_content) == (40, 0, 1.0)
    none = spark.createDataFrame([], PAIR)
    assert R.filter_summary(R.filter_reasons(none)).count() == 0
    assert R.mates(spark.createDataFrame(rows, PAIR)).count() == 16


def test_dedup_keeps_qualities(spark):
    rows = [("a", 5, "AC", "GT", "II", "##"), ("a", 2, "AC", "GT", "5#", None), ("a", 3, "AC", None, "II", None), ("a", 4, "AC", None, "##", None)]
    got = sorted(tuple(r) for r in R.dedup_pairs(spark.createDataFrame(rows, PAIR)).select("read_id", "qual1", "qual2", "copies").collect())
    assert got == [(2, "5#", None, 2), (3, "II", None, 2)]


def test_profile_and_shares(spark):
    reads = spark.createDataFrame([("a", "AN", "I#"), ("a", "C", "5"), ("a", "A", None), ("b", "", ""), ("b", None, None)], "sample string, seq string, qual string")
    got = {(r["sample"], r.pos): r for r in R.position_profile(reads).collect()}
    assert set(got) == {("a", 1), ("a", 2)}
    one = got["a", 1]
    assert (one.n, one.n_a, one.n_c, one.n_g, one.n_t, one.n_other, one.gc, one.quality_sum, one.q50) == (3, 2, 1, 0, 0, 0, 1, 60, 30.0)
    assert (got["a", 2].n_other, got["a", 2].q10) == (1, 2.0)
    report = spark.createDataFrame([("a", 0, "U", 30), ("a", 1, "R", 70), ("a", 9, "D", 25), ("b", 9, "D", 0)], "sample string, taxid long, rank string, clade_reads long")
    got = {(r["sample"], r.taxid): (r.removed_reads, r.share_pct) for r in R.retention_shares(report, [9, 10]).collect()}
    assert got == {("a", 9): (25, 25.0), ("b", 9): (0, 0.0)}


def test_read_assignments(spark):
    lines = ["C\tr1\t562\t150|149\t562:10 |:| 0:3", "U\tr2\t0\t80\t0:4", "C\tr3\tSome name (taxid 9606)\t7|\tA:1", "C\tr4\tx\t1\t", "short\tline", "", None]
    got = [tuple(r) for r in read_assignments(spark.createDataFrame([(x, "s") for x in lines], "value string, sample string")).collect()]
    assert got == [("s", True, "r1", 562, 150, 149), ("s", False, "r2", 0, 80, None), ("s", True, "r3", 9606, 7, None)]


@pytest.mark.parametrize("letters", [1, 50, 1 << 20])
def test_tails_of_many_reads_at_once(spark, letters, monkeypatch):
    from lanefold.functions import sequences

    monkeypatch.setattr(sequences, "LETTERS", letters)
    rng = np.random.default_rng(3)
    quals = ["", "I", "!!!", "IIII", "!!!!", None, "I" * 4000 + "#" * 3000, "é" * 5, *("".join(rng.choice(list("I5#A!"), n)) for n in range(120))]

    def kept(x, w=4, q=20):
        if x is None or len(x) < w:
            return x and len(x)
        return next((e for e in range(len(x), w - 1, -1) if sum(ord(c) - 33 for c in x[e - w : e]) >= q * w), 0)

    rows = spark.createDataFrame([(i, x) for i, x in enumerate(quals)], "i int, qual string").repartition(2)
    got = rows.select("i", sequences.cut_tail_length(F.col("qual"), 4, 20).alias("n"))
    assert {r["i"]: r["n"] for r in got.collect()} == {i: len(x) if x is not None and len(x) < 4 else kept(x) for i, x in enumerate(quals)}
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()  # no step a place and window


def test_filter_summary_measures_reads_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rng = np.random.default_rng(5)
    rows = [(None, 1, 1, "GC", "II"), (None, 1, 2, "AC", "I#"), ("a", 1, 1, "GNNA", None), ("a", 2, 2, "", ""), ("a", 3, 1, None, None)]
    for k in range(400):  # lone mates, and some reads twice
        n = int(rng.integers(0, 30))
        rows.append((str(rng.choice(["a", "b"])), int(rng.integers(10, 200)), int(rng.integers(1, 3)), "".join(rng.choice(list("ACGTN"), n)), "".join(rng.choice(list("!#05?I"), n))))
    reads = spark.createDataFrame(rows, "sample string, read_id long, mate int, seq string, qual string")
    rules = {"shortest": 6, "q": 18, "low_pct": 50}
    want = sorted(map(tuple, R.filter_summary(R.filter_reasons(R.repair_pairs(reads), **rules)).collect()), key=repr)
    got = R.filter_summary(R.filter_reasons(R.measured_pairs(reads.mapInArrow(told, reads.schema), 18), **rules)).collect()
    assert sorted(map(tuple, got), key=repr) == want and seen.value == len(rows)


def test_counts_of_letters(spark):
    from lanefold.functions.sequences import count_of, quality_at_least

    texts = ["", None, "GATTACA", "", "é€😀G", "!" * 9 + "5I", "N" * 3000, "", "~\x7f\x1f 0"]
    t = spark.createDataFrame(list(enumerate(texts)), "i int, x string").coalesce(1)
    got = {r.i: (r.g, r.q, r.n) for r in t.select("i", count_of(F.col("x"), "GCN").alias("g"), quality_at_least(F.col("x"), 20).alias("q"), count_of(F.lit(None).cast("string"), "A").alias("n")).collect()}
    below = {chr(c) for c in range(33, 53)}
    assert got == {i: (None if x is None else sum(c in "GCN" for c in x), None if x is None else sum(c not in below for c in x), None) for i, x in enumerate(texts)}
    assert "translate" not in t.select(count_of(F.col("x"), "GC"))._jdf.queryExecution().toString()
