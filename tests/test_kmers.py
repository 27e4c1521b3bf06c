"""k-mers by minimizer buckets against windows of text, at any bucket number and piece length, and linear in the length."""

import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanefold.functions import minimizers as M
from lanefold.functions.sequences import kmer_text
from lanefold.operators import kmers as K

RNG = np.random.default_rng(11)
SCHEMA = "sample string, seq string"


def windows(seq, k):
    flip = str.maketrans("ACGT", "TGCA")
    for i in range(len(seq or "") - k + 1):
        w = seq[i : i + k]
        if not set(w) - set("ACGT"):
            yield min(w, w[::-1].translate(flip))


def brute(rows, k):
    return Counter((s, w) for s, seq in rows for w in windows(seq, k))


def letters(n, of="ACGT"):
    return "".join(RNG.choice(list(of), n))


ROWS = [(s, letters(int(RNG.integers(0, 300)), "ACGTN" if s == "b" else "ACGT")) for s in ("a", "b", None) for _ in range(12)]
ROWS += [("a", None), ("a", ""), ("c", "acgt"), ("c", "NNNN"), ("d", "A" * 4000), ("d", "ACGTT" * 700), ("d", "ACGTT" * 700), ROWS[0], ROWS[0]]


@pytest.mark.parametrize(("k", "buckets", "piece", "slice_", "chunk"), [(1, 3, 50, 64, 8), (4, 1, 7, 100, 100), (21, 4096, 1 << 14, 1 << 20, 1 << 20), (21, 16, 64, 300, 50), (31, 7, 100, 1000, 10)])
def test_counts(spark, monkeypatch, k, buckets, piece, slice_, chunk):
    for name, value in (("PIECE", piece), ("SLICE", slice_), ("CHUNK", chunk)):
        monkeypatch.setattr(K, name, value)
    monkeypatch.setattr(M, "MANY", 40)
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = {(r["sample"], r["text"]): r["cnt"] for r in K.count_kmers(df, k, buckets).withColumn("text", kmer_text(F.col("kmer"), k)).collect()}
    assert got == brute(ROWS, k)


def test_joint_spectrum(spark):
    contigs = [("a", ROWS[0][1]), ("a", letters(200)), ("d", "A" * 100 + "ACGTT" * 30), ("new", letters(90)), (None, letters(60))]
    reads, assembly = (spark.createDataFrame(x, SCHEMA) for x in (ROWS, contigs))
    r, a = brute(ROWS, 21), brute(contigs, 21)
    want = Counter((s, r[s, w], a[s, w]) for s, w in r.keys() | a.keys())
    spectrum = K.joint_spectrum(reads, assembly).cache()
    assert {(x["sample"], x["multiplicity"], x["copies"]): x["n"] for x in spectrum.collect()} == want
    by_counts = K.joint_of_counts(K.count_kmers(reads.filter("sample is not null")), K.count_kmers(assembly.filter("sample is not null")))
    assert sorted(map(tuple, by_counts.collect())) == sorted(map(tuple, spectrum.filter("sample is not null").collect()))
    qv = {x["sample"]: (x["only_kmers"], x["total_kmers"]) for x in K.qv_of(spectrum).collect()}
    for s in ("a", "d", "new", None):
        assert qv[s] == (sum(n for (t, w), n in a.items() if t == s and not r[t, w]), sum(n for (t, _), n in a.items() if t == s))
    assert K.count_kmers(reads.limit(0)).collect() == [] and K.qv_of(K.joint_spectrum(reads.limit(0), assembly.limit(0))).collect() == []


def test_skewed_bucket_leaves_a_task_once(spark):
    """A k-mer that fills the data is counted before the shuffle."""
    df = spark.createDataFrame([("s", "A" * 300_000)] * 4, SCHEMA).repartition(2)
    runs = K._runs(df, 21, 0, K.BUCKETS)
    assert runs.filter("kmers is not null").count() <= 2 and runs.count() <= 20
    assert [tuple(r) for r in K.count_kmers(df).collect()] == [("s", 0, 4 * (300_000 - 20))]


def test_five_million_letters(spark):
    """Time grows with the letters: a contig of 5 Mb takes seconds."""
    seq = letters(5_000_000)
    began = time.time()
    n, total = K.count_kmers(spark.createDataFrame([("s", seq)], SCHEMA)).agg(F.count("*"), F.sum("cnt")).head()
    assert total == 5_000_000 - 20 and 0 <= total - n < 1000 and time.time() - began < 30


def test_k_is_bounded(spark):
    with pytest.raises(ValueError):
        K.count_kmers(spark.createDataFrame([], SCHEMA), 32)


def test_counts_of_several_tables_meet_in_their_buckets(spark):
    tables = [spark.createDataFrame([(s, "".join(RNG.choice(list("ACGTN"), 300, p=[0.3, 0.3, 0.2, 0.19, 0.01]))) for s in ("a", "b", None)] * 3, "sample string, seq string") for _ in range(2)]
    got = K.count_together(*tables, k=5, buckets=7)
    want = K.union_sum(*(K.count_kmers(t, 5) for t in tables))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert all("cnt" not in line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Repartition" in line or "Aggregate" in line)  # no count is shuffled


def test_packed_runs_of_a_bucket_are_gathered_into_one_row(spark):
    df = spark.createDataFrame([("a", "".join(RNG.choice(list("ACGT"), 200))) for _ in range(20_000)], SCHEMA).coalesce(1)
    rows = K._runs(df, 21, 0, 64).collect()
    assert len(rows) == len({r["bucket"] for r in rows}) and sum(sum(r["sizes"]) for r in rows if r["sizes"]) == 20_000 * 180
    text = spark.createDataFrame([(0,), (27,), (None,), (4**21 - 1,)], "kmer long").coalesce(1).select(kmer_text(F.col("kmer"), 21).alias("t"))
    assert [r["t"] for r in text.collect()] == ["A" * 21, "A" * 18 + "CGT", None, "T" * 21]
    assert "conv(" not in text._jdf.queryExecution().optimizedPlan().toString()
