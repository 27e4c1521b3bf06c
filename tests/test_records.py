"""Sheets, records and resolution on rows with nulls, ties, odd texts and empty tables."""

import pytest

from lanefold.operators import samples as P
from lanefold.operators import store as S
from lanefold.sources import records as R
from lanefold.sources import sheets as H

FIT = """GenomeScope version 2.0
input file = OG1.ilmn.250101.meryl.hist
name prefix = reseed

property                      min               max
Homozygous (aa)               99.579%           99.6248%
Heterozygous (ab)             0.375176%         0.421044%
Genome Haploid Length         2,499,788 bp      Inf bp
Model Fit                     80.9337%          98.6498%
"""


def test_fit_stats(spark):
    r = R.fit_stats(spark.createDataFrame([(FIT,), ("",), (None,)], "text string")).collect()
    assert (r[0]["og_id"], r[0]["seq_date"], r[0]["genomesize_min"], r[0]["genomesize"], r[0]["modelfit_allkmers"], r[0]["error"]) == ("OG1", "250101", 2499788, None, 80.9337, None)
    assert [x["error"] for x in r[1:]] == ["no finite genome size"] * 2


def test_json_records_of_odd_texts(spark):
    t = spark.createDataFrame([("OG1.ilmn.250101.x", "{}"), ("OG1", "no json"), ("", ""), (None, None)], "name string, text string")
    assert all(x["error"] for x in R.fastp(t).collect()) and all(x["error"] for x in R.busco(t).collect())
    assert R.kmer_depth(t).count() == 4 and [x["has_regions"] for x in R.verdict(t).collect()] == [False] * 4
    assert R.fastp_wide(t).count() == 4 and R.fastp(t.limit(0)).count() == 0


def test_busco_takes_results_first(spark):
    text = '{"metrics": {"Complete": 80, "n_markers": 9}, "results": {"complete": "95.5%", "N50 contig": "1,200.9"}, "parameters": {"in": "/a/OG3.ilmn.250101_v.fna"}}'
    r = R.busco(spark.createDataFrame([("x", text)], "name string, text string")).first()
    assert (r["og_id"], r["seq_date"], r["complete"], r["n_markers"], r["contigs_n50"], r["error"]) == ("OG3", "250101", 95.5, 9, 1200, None)


def test_sheet_refuses_other_columns(spark):
    with pytest.raises(ValueError, match="extra"):
        H.validate_samplesheet(spark.createDataFrame([], ", ".join(f"{c} string" for c in [*H.SHEET_RULES, "extra"])))


def test_manifest_is_all_or_nothing(spark):
    t = spark.createDataFrame([(2, " OG1 ", "250101", "/db/metazoa_odb12"), (3, "OG1", "250101", None), (4, None, None, None), (5, "OG2", "25010", None)], "line long, og_id string, seq_date string, busco_lineage string")
    m = H.manifest(t)
    assert {r["line"]: (r["tag"], r["error"]) for r in m.collect()} == {2: ("meta", None), 3: (None, "duplicate target"), 4: (None, "og_id and seq_date are required"), 5: (None, "seq_date must be six digits")}
    with pytest.raises(ValueError, match="3 rows"):
        S.all_or_nothing(m)
    assert S.all_or_nothing(m.filter("line = 2")).columns == ["line", "og_id", "seq_date", "tag"]


def test_a_relative_never_gives_the_taxid(spark):
    t = spark.createDataFrame([("a", "genus_exact", 5, "c", 9, "d", "species"), ("b", "species_exact", None, "c", None, None, None), ("c", None, None, None, 9, "", "order"), ("d", "order_fuzzy", 5, "c", 9, "d", "genus")], "s string, match_level string, db_taxid long, db_class string, tax_taxid long, tax_class string, tax_rank string")
    assert {r["s"]: (r["taxid"], r["class"], r["source"], r["rank_used"]) for r in P.resolve(t).collect()} == {
        "a": (9, "c", "db+taxdump", "species"), "b": (None, "c", "unresolved", ""), "c": (9, None, "unresolved", "order"), "d": (9, "d", "taxdump", "genus"),
    }


def test_dumps_and_inventories_skip_what_does_not_fit(spark):
    lines = spark.createDataFrame([("1\t|\t1\t|\tno rank\t|\t8\t|",), ("x",), ("",), (None,), ("7\t|\tAus bus\t|\t\t|\tscientific name\t|",)], "value string")
    assert [tuple(r) for r in H.tax_nodes(lines).collect()] == [(1, 1, "no rank")]
    assert [tuple(r) for r in H.tax_names(lines).collect()] == [(7, "Aus bus")]
    assert H.clade_report(lines).count() == 0
    files = spark.createDataFrame([("/a/OG1.ilmn.NOVA_250131_AD.fastp.json",), ("short",), (None,)], "path string")
    assert sorted(map(tuple, H.artifact_inventory(files, {"x": "json$|short"}).select("sample_id", "component").collect())) == [("OG1.ilmn.250131", "x"), ("short", "x")]


def test_bundles_and_parameters_on_nulls(spark):
    files = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "3")], "sample string, path string")
    assert [tuple(r) for r in P.bundle(files, spark.createDataFrame([("a",)], "sample string"), ["z"]).collect()] == [("a", ["1", "2", "z"])]
    rows = spark.createDataFrame([("T", "-s OG1 r1", None), ("T", "-s OG2 r1", None), (None, None, None)], "tool string, params string, notes string")
    assert [tuple(r) for r in P.collapse_parameters(rows, {"T": 1}, "r1").collect()] == [(1, "T", "-s <sample> <run>", "", 2), (999, None, "", "", 1)]
