"""Contig statistics on lengths beyond 32 bits, and samples that share contig names."""

from lanefold.operators import contigs as C


def test_nstar_of_long_contigs(spark):
    rows = [("a", k, n) for k, n in enumerate([50_000, 50_000, 3_000, 20])] + [("b", 1, 2_000_000_000), ("b", 2, 2_000_000_000), ("c", 1, 0), ("c", 2, None)]
    df = spark.createDataFrame(rows, "sample string, contig long, length int")
    got = {(r["sample"], r["pct"]): (r["n"], r["l"]) for r in C.nstar(df, (50, 90, 100)).collect()}
    assert got["a", 50] == (50_000, 2) and got["a", 90] == (50_000, 2) and got["a", 100] == (20, 4) and got["b", 90] == (2_000_000_000, 2)
    aun = {r["sample"]: r["aun"] for r in C.nstar(df, (50,)).collect()}
    assert aun == {"a": (2 * 50_000**2 + 3_000**2 + 400) / 103_020, "b": 2e9, "c": None}
    sizes = spark.createDataFrame([("a", 200_000), ("b", -1)], "sample string, expected long")
    ng = {(r["sample"], r["pct"]): (r["n"], r["l"]) for r in C.nstar(df, (20, 50, 90), sizes).collect()}
    assert ng["a", 20] == (50_000, 1) and ng["a", 50] == (50_000, 2) and ng["a", 90] == (None, None) and {k[0] for k in ng} == {"a"}  # no usable size, no NG*
    assert C.nstar(df.limit(0)).collect() == []


def test_samples_share_contig_names(spark):
    seq = "ACGT" * 200
    contigs = spark.createDataFrame([(s, c, seq, len(seq)) for s in "AB" for c in ("k1", "k2", "k3")], "sample string, contig string, seq string, length int")
    actions = spark.createDataFrame([("A", "k1", "EXCLUDE", 1, 800), ("B", "k2", "TRIM", 1, 300), ("A", "k3", "REVIEW", 1, 800), (None, "k2", "EXCLUDE", 1, 2)], "sample string, contig string, action string, a_start long, a_end long")
    pieces = {(r["sample"], r["contig"]): len(r["seq"]) for r in C.apply_actions(contigs, actions).collect()}
    assert pieces == {("A", "k2"): 800, ("A", "k3"): 800, ("B", "k1"): 800, ("B", "k2"): 500, ("B", "k3"): 800}
    adaptors = C.adaptor_actions(spark.createDataFrame([("B", "k1", 800, "ACTION_TRIM", "1..100, 700..800"), ("A", "k2", 800, "ACTION_EXCLUDE", ""), ("B", "k3", 800, "FIX", "x")], "sample string, contig string, length int, action string, ranges string"))
    classes = spark.createDataFrame([("B", "k3 len=800\tbacteria"), ("A", "k2 len=800\teukarya"), ("B", "k1 len=3\tnone")], "sample string, line string")
    clean = {(r["sample"], r["contig"]): len(r["seq"]) for r in C.decontaminate(contigs, actions, adaptors=adaptors, classes=classes).collect()}
    assert clean == {("B", "k1"): 599, ("B", "k2"): 500}
    summary = {(r["sample"], r["action"]): (r["contigs"], r["bp"]) for r in C.action_summary(actions.filter("sample is not null")).collect()}
    assert summary["A", "EXCLUDE"] == (1, 800) and summary["B", "EXCLUDE"] == (0, 0) and summary["B", "TRIM"] == (1, 300)
    genes = spark.createDataFrame([("A", 1, "Complete", "k1", 10, 20, "+"), ("B", 2, "Complete", "k9", 10, 20, "+"), ("B", 3, "Complete", "k1", 900, 950, "+")], "sample string, gene int, status string, contig string, g_start int, g_end int, strand string")
    assert [(r["sample"], r["gene"]) for r in C.gene_regions(genes, contigs).collect()] == [("A", 1)]
    assert {r["sample"]: (r["kept"], r["skipped"]) for r in C.region_counts(genes, contigs).collect()} == {"A": (1, 0), "B": (0, 2)}
    reads = spark.createDataFrame([("A", "k1", 0, 400, 60, 0), ("B", "k1", 700, 900, 60, 0)], "sample string, contig string, a_start long, a_end long, mapq int, flag int")
    depth = {(r["sample"], r["contig"]): r["meandepth"] for r in C.contig_depth(reads, contigs.withColumn("length", contigs["length"])).collect()}
    assert depth["A", "k1"] == 0.5 and depth["B", "k1"] == 0.125 and depth["A", "k2"] == 0
    assert {r["sample"]: r["status"] for r in C.region_status(C.gene_regions(genes, contigs), contigs, 1).collect()} == {"A": "ok", "B": "too_few_busco_regions"}


def test_floor_comes_before_adaptors(spark):
    contigs = spark.createDataFrame([("s", "c1", "ACGTA" * 104), ("s", "c2", "ACGTA" * 99)], "sample string, contig string, seq string")
    none = spark.createDataFrame([], "sample string, contig string, action string, a_start long, a_end long")
    cut = C.adaptor_actions(spark.createDataFrame([("s", "c1", 520, "ACTION_TRIM", "1..40")], "sample string, contig string, length int, action string, ranges string"))
    assert [(r["contig"], len(r["seq"])) for r in C.decontaminate(contigs, none, adaptors=cut).collect()] == [("c1", 480)]


def test_removed_pieces_complete_the_clean_ones(spark):
    contigs = spark.createDataFrame([("s", "a", "ACGTACGTAC"), ("s", "b", "TTTT"), ("s", "e", ""), ("t", "a", "GGGG"), ("s", "n", None)], "sample string, contig string, seq string")
    rows = [("s", "a", "TRIM", 1, 2), ("s", "a", "TRIM", 3, 4), ("s", "a", "TRIM", 4, 5), ("s", "a", "TRIM", 8, 99), ("s", "a", "TRIM", 50, 60), ("s", "b", "EXCLUDE", 1, 4), ("s", "b", "TRIM", 1, 1), ("s", "e", "EXCLUDE", 1, 1), ("s", "n", "EXCLUDE", 1, 1)]
    actions = spark.createDataFrame(rows, "sample string, contig string, action string, a_start long, a_end long")
    gone = sorted(tuple(r) for r in C.removed_pieces(contigs, actions).collect())
    assert gone == [("s", "a", 1, 5, "ACGTA"), ("s", "a", 8, 10, "TAC"), ("s", "b", 1, 4, "TTTT")]
    kept = sum(len(r["seq"]) for r in C.apply_actions(contigs, actions).filter("seq is not null").collect())
    assert kept + sum(len(r[4]) for r in gone) == 18
    assert C.removed_pieces(contigs.limit(0), actions).collect() == []


def test_depth_mode_of_contigs_named_by_text(spark):
    from lanefold.operators.depth import depth_mode

    df = spark.createDataFrame([("s", "b", 1000, 8.1), ("s", "a", 1000, 40.0), ("s", "c", 400, 90.0)], "sample string, contig string, length long, meandepth double")
    got = depth_mode(df).collect()
    assert len(got) == 1 and 35 < got[0]["depth_mode"] < 45 and got[0]["mode_fraction"] == 0.5


def test_statistics_read_sequences_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [("s", 1, "ACGNNGGTA"), ("s", 2, "NNN"), ("s", 3, "GGC"), ("s", 4, "ACT"), ("t", 1, ""), (None, 1, "GNA"), ("u", 1, None)]
    contigs = spark.createDataFrame(rows, "sample string, contig int, seq string")
    got = {(r["sample"], r["kind"]): r for r in C.scaffold_and_contig_stats(contigs.mapInArrow(told, contigs.schema)).collect()}
    assert seen.value == len(rows)
    assert got.keys() == {("s", "scaffold"), ("s", "contig"), ("t", "scaffold"), (None, "scaffold"), (None, "contig")}
    values = lambda r: (r.num_seqs, r.sum_len, r.min_len, r.avg_len, r.max_len, r.n_bases, r.q1, r.q2, r.q3, r.n50)
    assert values(got["s", "scaffold"]) == (4, 18, 3, 4.5, 9, 5, 3.0, 3.0, 4.5, 9) and values(got["s", "contig"]) == (4, 13, 3, 3.25, 4, 0, 3.0, 3.0, 3.25, 3)
    assert got["s", "scaffold"].gc_pct == 800 / 18 and got["t", "scaffold"].gc_pct is None and values(got["t", "scaffold"])[:5] == (1, 0, 0, 0.0, 0)
    assert values(got[None, "contig"])[:6] == (2, 2, 1, 1.0, 1, 0)
    assert {r["sample"]: values(r) for r in C.seq_stats(contigs).collect()} == {s: values(got[s, "scaffold"]) for s in ("s", "t", None)}
