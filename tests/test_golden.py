"""Published golden values and invariants of the verdict, depth and accounting rules."""

from pyspark.sql import functions as F

from lanefold.operators import accounting as A
from lanefold.operators import contigs as C
from lanefold.operators import depth as D
from lanefold.operators import kmers as K
from lanefold.operators import taxonomy as X
from lanefold.operators import verdict as V


def test_reseed_choice(spark):
    rows = [(1, 83.5, 17.9, 96.7, 8.3, 9.2), (2, 80.9, 16.0, 62.8, 7.7, 6.3), (3, 80.0, 10.0, 95.0, 40.0, 9.2), (4, 90.0, 20.0, 90.5, 10.0, 9.2), (5, 80.0, 17.9, 96.0, 8.3, None)]
    t = spark.createDataFrame(rows, "sample int, fit_full double, kmercov double, new_fit_full double, new_kmercov double, lam double")
    t = t.withColumns({c: F.lit(None).cast("double") for c in ("het_max", "new_het_max", "fit_all", "new_fit_all")}).withColumn("new_size_max", F.lit(None).cast("long"))
    got = {r["sample"]: (r["winner"], r["reason"]) for r in V.reseed_choice(t).collect()}
    assert got == {1: ("reseeded", "better_and_closer"), 2: ("original", "gain_below_minimum"), 3: ("original", "no_closer"), 4: ("original", "gain_below_minimum"), 5: ("original", "no_lambda")}


def recheck_rows(spark, rows):
    cols = "sample int, flags array<string>, estimated_genome_size long, coverage double, coverage_before double, coverage_status string, kmercov double, lam double, host_ratio double, host_haploid_size long, host_size long, partition_status string, partition_confidence string, assembly_size long, busco_complete double, depth_measured boolean"
    return spark.createDataFrame(rows, cols)


def test_recheck_golden_and_idempotent(spark):
    base = lambda n, size, asm, lam, k, ratio, flags=(): (n, list(flags), size, 30.0, 31.0, "GOOD", k, lam, ratio, None, None, None, None, asm, None, True)
    t = recheck_rows(spark, [
        base(1, 123_000_000, 400_000_000, 2.5, 39.1, None), base(2, 123_000_000, 400_000_000, 30.0, 30.0, 0.18), base(3, 123_000_000, 400_000_000, 2.5, 2.5, None),
        base(4, 114_000_000, 327_693_880, 3.8, 28.9, 0.15, ["no_kmer_peak"]), base(5, 359_000_000, 375_000_000, 30.2, 29.7, 0.75),
        (6, [], 4_000_000, 30.0, 31.0, "GOOD", None, None, None, None, 40_000_000, "ok", None, 400_000_000, None, True),
        (7, [], 1, 30.0, 31.0, "GOOD", None, None, None, None, None, None, None, 400_000_000, None, False),
    ])
    once = V.recheck(t)
    got = {r["sample"]: r for r in once.collect()}
    assert "fitted_coverage_disagrees_with_read_depth" in got[1]["flags"]
    assert got[2]["flags"] == ["assembly_not_dominated_by_host"]
    assert got[3]["flags"] == ["host_coverage_too_low"]
    assert got[4]["flags"] == ["no_kmer_peak", "fitted_coverage_disagrees_with_read_depth", "assembly_not_dominated_by_host", "host_coverage_too_low"]
    assert got[5]["flags"] == [] and got[5]["reliable"]
    assert got[6]["flags"] == ["genome_size_disagrees_with_assembly"] and got[6]["assembly_ratio_basis"] == "host"
    assert got[7]["flags"] == ["no_genome_size_estimate"] and got[7]["estimated_genome_size"] == 0
    assert sorted(map(str, V.recheck(once.select(*t.columns)).select("sample", "flags").collect())) == sorted(map(str, once.select("sample", "flags").collect()))


def test_lambda_calibration(spark):
    t = spark.createDataFrame([(70.0, 146.0), (70.0, 15.0), (None, 146.0)], "d double, l double")
    got = [r[0] for r in t.select(D.lambda_of(F.col("d"), F.col("l"))).collect()]
    assert round(got[0], 1) == 30.2 and got[1:] == [None, None]


def test_partition_and_mode(spark):
    t = spark.createDataFrame([(1, i, 1_000_000, 130.0) for i in range(36)] + [(1, 99 + i, 1_000_000, 70.0) for i in range(13)], "sample int, contig int, length long, meandepth double")
    r = D.partition(t.withColumn("host_depth", F.lit(133.6))).first()
    assert (r["host_size"], r["host_collapsed_size"], r["host_haplotig_size"]) == (49_000_000, 36_000_000, 13_000_000)
    t = spark.createDataFrame([(1, i, 1_000_000, 6.0 if i < 8 else 27.0) for i in range(10)], "sample int, contig int, length long, meandepth double")
    assert 5 < D.depth_mode(t).first()["depth_mode"] < 7


def test_confidence(spark):
    t = spark.createDataFrame([(60, 27.4, 6.2, 0.8), (25, 51.2, 50.0, 0.8), (447, 30.8, 24.7, 0.3), (260, 70.0, 69.8, 0.9)], "r int, a double, m double, f double")
    got = [r[0] for r in t.select(D.confidence(F.col("r"), F.col("a"), F.col("m"), F.col("f"))).collect()]
    assert got == ["anchor_off_mode", "few_busco_regions", "no_dominant_mode", "high"]


def test_peak(spark):
    import math

    peaked = [(1, c, int(8e8 / c**3) + int(3e6 * math.exp(-((c - 60) ** 2) / 450)) + 10) for c in range(1, 401)]
    flat = [(2, c, int(8e8 / c**2) + 10) for c in range(1, 401)]
    short = [(3, c, 5) for c in range(1, 10)]
    got = {r["sample"]: (r["peak_cov"], r["reason"]) for r in K.find_kmer_peak(spark.createDataFrame(peaked + flat + short, "sample int, cov int, cnt long")).collect()}
    assert got[1] == (60, "ok") and got[2] == (None, "no_trough_histogram_monotone") and got[3] == (None, "histogram_too_short")


def test_clean_species(spark):
    t = spark.createDataFrame([("Morus sp. 2 (TBC)",), ('"Caridea" cf. nana x',), ("",), (None,)], "n string")
    assert [r[0] for r in t.select(X.clean_species(F.col("n"))).collect()] == ["Morus", "Caridea nana", "", None]


def test_durations(spark):
    t = spark.createDataFrame([("1-02:03:04",), ("03:04.5",), ("12",)], "d string")
    assert [r[0] for r in t.select(A.duration_seconds(F.col("d"))).collect()] == [93784.0, 184.5, 12.0]


def test_actions_partition_the_sequence(spark):
    contigs = spark.createDataFrame([("s", 1, "ACGTACGTAC"), ("s", 2, "TTTT"), ("s", 3, "GGGG")], "sample string, contig int, seq string")
    actions = spark.createDataFrame([("s", 1, "TRIM", 3, 4), ("s", 1, "TRIM", 9, 10), ("s", 2, "EXCLUDE", 1, 4), ("other", 3, "EXCLUDE", 1, 4)], "sample string, contig int, action string, a_start long, a_end long")
    got = sorted((r["contig"], r["piece"], r["seq"]) for r in C.apply_actions(contigs, actions).collect())
    assert got == [(1, 1, "AC"), (1, 2, "ACGT"), (3, 1, "GGGG")]


def test_fingerprint_ignores_order(spark):
    t = spark.createDataFrame([("a", "r1", 1, 10), ("a", "r2", 2, 20)], "sample string, component string, event_id long, bytes long")
    one = A.fingerprint(t, args="k 21 -t 4 --num-cpu-threads=4 -m 8").first()["fingerprint"]
    assert one == A.fingerprint(t.orderBy(F.desc("event_id")), args="k   21").first()["fingerprint"]
    assert one != A.fingerprint(t, args="k 31").first()["fingerprint"]
