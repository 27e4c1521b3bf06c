"""Blocks of CIGARs, and depth by the sweep, against counting base by base."""

import re
from collections import Counter

import numpy as np
import pytest

from lanefold.operators import contigs as C
from lanefold.operators import coverage as V

RNG = np.random.default_rng(9)
SCHEMA = "sample string, contig string, a_start long, cigar string, mapq int, flag int, nm int"


def cigar():
    ops = [f"{RNG.integers(1, 9)}{RNG.choice(list('MID=XNP'))}" for _ in range(int(RNG.integers(1, 7)))]
    return ("3S" if RNG.random() < 0.3 else "") + "".join(ops) + ("2H" if RNG.random() < 0.2 else "")


def reads():
    out = [(s, c, int(RNG.integers(0, 400)), cigar(), int(RNG.integers(0, 60)), int(RNG.choice([0, 0, 16, 4, 256, 1024])), int(RNG.integers(0, 4))) for s in ("a", "b", None) for c in ("k1", "k2") for _ in range(60)]
    return [*out, *[("a", "hot", 100, "50M", 60, 0, 0)] * 300, ("a", "k1", 5, None, 60, 0, 1), ("a", "k1", 5, "*", 60, 0, 1), ("a", "k1", None, "5M", 60, 0, 1), ("a", "far", 10**8 - 7, "10M", 60, 0, None)]


def depth(rows, counted, mapq=0):
    out = Counter()
    for s, c, at, cig, q, flag, _ in rows:
        if q < mapq or flag & 1796 or at is None or cig is None:
            continue
        for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cig):
            if op in counted:
                for p in range(at, at + int(n)):
                    out[s, c, p] += 1
            at += int(n) if op in "M=XDN" else 0
    return out


ROWS = reads()


@pytest.mark.parametrize("bin_size", [1, 7, 64, 1 << 16])
@pytest.mark.parametrize("counted", ["M=XD", "M=X", "M=XDN"])
def test_sweep(spark, bin_size, counted):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got, ends = Counter(), {}
    for r in V.depth_runs(V.alignment_blocks(V.good_alignments(df, 20), counted), bin_size).collect():
        for p in range(r["start"], r["end"]):
            assert (r["sample"], r["contig"], p) not in got
            got[r["sample"], r["contig"], p] = r["depth"]
        ends[r["sample"], r["contig"]] = max(r["end"], ends.get((r["sample"], r["contig"]), 0))
    assert got == depth(ROWS, counted, 20)


def test_regions_and_contigs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    places = [(s, c, f"g{k}", int(x), int(x) + int(RNG.integers(1, 90))) for s in ("a", "b") for c in ("k1", "k2", "hot") for k, x in enumerate(RNG.integers(0, 400, 6))]
    regions = spark.createDataFrame([*places, ("a", "none", "g", 0, 10), ("a", "far", "g", 10**8 - 5, 10**8 + 50)], "sample string, contig string, gene string, start long, end long")
    want = depth(ROWS, "M=XD", 20)
    runs = V.depth_runs(V.alignment_blocks(V.good_alignments(df, 20)), 50)
    for got in (V.depth_in_regions(runs, regions, 16), C.region_depth(df, regions)):
        for r in got.collect():
            assert r["depth_sum"] == sum(want[r["sample"], r["contig"], p] for p in range(r["start"], r["end"])), r
    lengths = spark.createDataFrame([("a", "k1", 300), ("b", "k2", 500), ("a", "none", 10), ("a", "hot", 120), ("a", "far", 10**8), ("b", "zero", 0)], "sample string, contig string, length long")
    mean = {(r["sample"], r["contig"]): r["meandepth"] for r in C.contig_depth(df, lengths).collect()}
    want = depth(ROWS, "M=X")
    for s, c, n in (("a", "k1", 300), ("b", "k2", 500), ("a", "hot", 120)):
        assert mean[s, c] == pytest.approx(sum(v for (t, k, p), v in want.items() if (t, k) == (s, c) and p < n) / n)
    assert mean["a", "none"] == 0 and mean["b", "zero"] is None and mean["a", "far"] == 7 / 10**8


def test_errors_and_edges(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r["sample"]: r for r in V.mapping_errors(df).collect()}
    bases = lambda ops: sum(int(n) for s, _, _, c, _, f, _ in ROWS if s == "b" and not f & 260 and c for n, op in re.findall(r"(\d+)([MIDNSHP=X])", c) if op in ops)
    assert (got["b"]["mapped_bases"], got["b"]["deleted_bases"], got["b"]["clipped_bases"]) == (bases("MI=X"), bases("D"), bases("SH"))
    assert got["b"]["error_rate"] == pytest.approx(sum(r[6] for r in ROWS if r[0] == "b" and not r[5] & 260) / bases("MI=X"))
    assert V.depth_runs(V.alignment_blocks(df.limit(0))).collect() == [] and V.mapping_errors(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        V.alignment_blocks(df, "MS")


@pytest.mark.parametrize("bin_size", [1, 40, 1 << 16])
def test_regions_meet_positions_not_alignments(spark, bin_size):
    """Deep coverage of crowded regions: no table on the way is larger than both sides together."""
    deep = spark.range(400).selectExpr("'a' as sample", "'k' as contig", "id % 50 as a_start", "id % 50 + 100 as a_end", "60 as mapq", "0 as flag")
    crowded = spark.range(300).selectExpr("'a' as sample", "'k' as contig", "id as gene", "id % 60 as start", "id % 60 + 80 as end").unionByName(spark.sql("select 'a' as sample, 'empty' as contig, 1L as gene, 3L as start, 9L as end"))
    got = C.region_depth(deep, crowded, bin_size=bin_size)
    assert len(got.collect()) == 301
    for r in got.collect():
        assert r["depth_sum"] == (r["contig"] == "k") * sum(8 * max(0, min(r["end"], s + 100) - max(r["start"], s)) for s in range(50))
    assert "sequence(" not in got._jdf.queryExecution().optimizedPlan().toString()  # nothing is dealt to bins
