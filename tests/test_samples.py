"""Sample, store and sink operators on rows with nulls, ties and empty tables."""

import pytest
from pyspark.sql import functions as F

from lanefold.operators import accounting as A
from lanefold.operators import samples as P
from lanefold.operators import store as S
from lanefold.operators import taxonomy as X
from lanefold.sources import reports as R
from lanefold.sources import sinks


def test_pairs_take_the_first_path(spark):
    files = spark.createDataFrame([("/b/S1.R1.fq",), ("/a/S1.R1.fq",), ("/a/S1_R2.fq",), ("/a/S1.x_R2.fastq.gz",), ("/a/S2.R1.fq",), ("/a/S3.fq",), (None,), ("/a/S4.R1.fq.bak",)], "path string")
    whole, rest = P.discover_pairs(files)
    assert sorted(map(tuple, whole.collect())) == [("S1", "/a/S1.R1.fq", "/a/S1.x_R2.fastq.gz")]
    assert sorted(map(tuple, rest.collect())) == [("S1_R2", "missing R1"), ("S2", "missing R2")]


def test_roles(spark):
    names = {"a.R1.fq": "R1", "a_R2": "R2", "R1_a.fq": "R1", "a_R2_001.fastq": "R2", "aR1.fq": None, "": None}
    t = spark.createDataFrame([(n,) for n in names], "n string").withColumn("r", P.read_role(F.col("n")))
    assert {r["n"]: r["r"] for r in t.collect()} == names


def test_lineage_needs_its_required_sets(spark):
    with pytest.raises(ValueError, match="vertebrata"):
        P.lineage_set(F.lit("Aves"), {"actinopterygii": "x"}, "m")


def test_components_on_empty_tables(spark):
    c = spark.createDataFrame([], "og_id string, seq_date string, component string, name string, parsed boolean")
    w = spark.createDataFrame([("a", "1", "x", True), ("a", "1", "y", False)], "og_id string, seq_date string, component string, optional boolean")
    assert {(r["component"], r["outcome"], r["name"]) for r in P.select_components(w, c, {}).collect()} == {("x", "optional", None), ("y", "missing", None)}


def test_curated_match_prefers_tier_then_taxid(spark):
    cur = spark.createDataFrame(
        [(None, "c1", "Aus bus", "Old name, Xus yus", "Aus", "Aidae", "Aiformes"), (5, "c2", "Aus cus", None, "Aus", "Aidae", None), (4, "c3", "Aus dus", None, "Aus", "Aidae", None)],
        "taxid long, class string, species string, synonym string, genus string, family string, order_name string",
    )
    names = spark.createDataFrame([(1, "aus BUS", "Aus bus", "Aus"), (2, "xus yus", None, "Xus"), (3, "Aus zus", "Aus zus", "Aus"), (4, None, None, None), (5, "Aida", "Aida", "Aida")], "id int, raw string, clean string, genus string")
    got = {r["id"]: (r["species"], r["match_level"]) for r in X.curated_match(names, cur, 0.5).collect()}
    assert got == {1: ("Aus bus", "species_exact"), 2: ("Aus bus", "synonym_exact"), 3: ("Aus dus", "genus_exact"), 5: ("Aus dus", "family_fuzzy")}


def test_candidates(spark):
    t = spark.createDataFrame([("Aus bus",), ("Aus sp. 3",), ("Aus b2",), ("  ",), (None,)], "n string")
    assert [r[0] for r in t.select(X.candidates(F.col("n"))).collect()][:4] == [["Aus bus", "Aus"], ["Aus"], ["Aus"], []]


@pytest.mark.parametrize(("unkeyed", "stale", "want"), [("invalidate", "fail", ["invalidated-unkeyed-fresh", "refused-stale"]), ("adopt", "archive", ["adopted-unkeyed-continue", "invalidated-stale-fresh"])])
def test_recompute_policies(spark, unkeyed, stale, want):
    t = spark.createDataFrame([(1, True, "", "k", False, True, True), (2, True, "j", "k", True, True, True)], "id int, present boolean, stored_key string, key string, done boolean, has_output boolean, checkpoint boolean")
    assert [r["decision"] for r in A.recompute_decision(t, unkeyed, stale).orderBy("id").collect()] == want


def test_partial_upsert_refuses_unknown_keys(spark):
    stored = spark.createDataFrame([(1, 2.0, "x")], "k int, v double, w string")
    kept, refused = S.partial_upsert(stored, spark.createDataFrame([(1, None), (2, 3.0)], "k int, v double"), ["k"], ["v"])
    assert list(map(tuple, kept.collect())) == [(1, None, "x")] and list(map(tuple, refused.collect())) == [(2, 3.0)]


def test_reports_without_their_lines_are_null(spark):
    t = spark.createDataFrame([("s", ""), ("n", None), ("x", "nothing\nhere")], "sample string, text string")
    for f in (R.completeness, R.short_contigs, R.quality_values, R.contiguity, R.sequence_total):
        assert all(v is None for r in f(t).collect() for v in r[1:]), f


def test_run_table_sorts_numbers_as_numbers(spark):
    a, b = spark.createDataFrame([("10", 1)], "sample_id string, z int"), spark.createDataFrame([("9", 2)], "sample_id string, b int")
    assert list(map(tuple, sinks.run_table([a, b]).collect())) == [("9", 2, None), ("10", None, 1)]
    c = spark.createDataFrame([("x", 3)], "sample_id string, b int")
    assert [r[0] for r in sinks.run_table([a, b, c]).collect()] == ["10", "9", "x"]


def test_sinks_read_back(spark, tmp_path):
    t = spark.createDataFrame([("b", 2, None), ("a", 1, "x")], "og_id string, n int, w string")
    sinks.write_partitioned(t, f"{tmp_path}/p", files=2)
    assert sorted(r["og_id"] for r in spark.read.parquet(f"{tmp_path}/p").collect()) == ["a", "b"]
    sinks.write_sorted(t, f"{tmp_path}/s", "og_id")
    assert [r[0] for r in spark.read.csv(f"{tmp_path}/s", sep="\t").orderBy(F.input_file_name()).collect()] == ["a", "b"]
    sinks.write_sheet(t, f"{tmp_path}/c", ("n", "og_id"))
    assert spark.read.csv(f"{tmp_path}/c", header=True).columns == ["n", "og_id"]
