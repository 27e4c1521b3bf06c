"""FASTQ files, the depth record, costs, sheets, uploads and the partial flows on small cases."""

import gzip

import pytest

from lanefold.operators import accounting as A
from lanefold.operators import flows, kmers, samples, store, taxonomy
from lanefold.operators.depth import depth_record
from lanefold.sources import sinks
from lanefold.sources.fastq import merge_lanes, read_fastq
from lanefold.sources.tables import job_accounting, read_curated

from pyspark.sql import functions as F


def test_fastq_across_parts(spark, tmp_path):
    records = [(f"r{k}", "ACGTN"[: 1 + k % 5] * (1 + k % 7), k) for k in range(300)]
    text = "".join(f"@{i}/1 x\n{s}\n+\n{'@' * len(s)}\n" for i, s, _ in records)
    (tmp_path / "OG1_L001_R1_001.fastq").write_text(text)
    with gzip.open(tmp_path / "OG1_L002_R1_001.fastq.gz", "wt") as f:
        f.write(text)
    (tmp_path / "OG2.R2.fq").write_text("")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("97", "1000", was):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = read_fastq(spark, str(tmp_path)).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", was)
        want = sorted(("OG1", lane, 1, i, s, "@" * len(s)) for i, s, _ in records for lane in ("001", "002"))
        assert sorted(tuple(r) for r in got) == want
    assert merge_lanes(read_fastq(spark, str(tmp_path))).columns == ["sample", "mate", "read_id", "seq", "qual"]
    (tmp_path / "bad_R1.fastq").write_text("@a\nAC\n+\n")
    with pytest.raises(Exception, match="whole records"):
        read_fastq(spark, str(tmp_path)).collect()
    (tmp_path / "bad_R1.fastq").write_text("@a\nAC\n+\nI\n")
    with pytest.raises(Exception, match="not a FASTQ record"):
        read_fastq(spark, str(tmp_path)).collect()


def test_depth_record_cases(spark):
    def record(contigs, regions, host, **more):
        s = spark.createDataFrame([("s", "ok", regions, host, 146.0, 1e9, 10_000_000, 29.7)], "sample string, status string, busco_regions int, busco_mean_depth double, read_length double, total_bases double, assembly_size long, kmercov double")
        d = spark.createDataFrame([("s", f"c{k}", n, x) for k, (n, x) in enumerate(contigs)], "sample string, contig string, length long, meandepth double")
        (r,) = depth_record(s, d, **more).collect()
        return r

    low = record([(10**6, 6.0)] * 80 + [(10**6, 27.0)] * 10, 60, 27.4)
    assert (low["host_assembly_size"], low["host_assembly_size_mode_anchored"], low["partition_confidence"], low["partition_note"]) == (10_000_000, 80_000_000, "low", "anchor_off_mode")
    split = record([(10**6, 130.0)] * 36 + [(10**6, 70.0)] * 14, 1800, 133.6)
    assert (split["host_assembly_size"], split["host_haploid_size"], split["partition_confidence"], split["host_assembly_size_mode_anchored"]) == (50_000_000, 43_000_000, "high", None)
    none = record([(10**6, 5.0)], 3, None)
    assert (none["status"], none["partition_status"], none["lambda_depth"], none["host_assembly_size"]) == ("no_measurement", "no_host_depth", None, None)
    gone = record([], 60, 70.0)
    assert gone["partition_status"] == "no_contig_depth" and round(gone["lambda_depth"], 1) == 30.2 and gone["busco_depth_over_assembly_depth"] == 0.7
    assert len(gone) == 25


def test_cost_per_sample(spark):
    jobs = spark.createDataFrame([("OG1.a", 2.0, "COMPLETED"), ("OG1.b", 1.0, "FAILED"), ("OG2", 5.0, "COMPLETED"), ("x OG3", 3.0, "COMPLETED"), (None, 1.0, None)], "tag string, su double, state string")
    got = [tuple(r) for r in A.cost_per_sample(jobs).collect()]
    assert got == [("OG2", 1, 5.0, 2.0, 7.0, 0), ("OG1", 2, 3.0, 2.0, 5.0, 1)]
    assert [tuple(r) for r in A.cost_per_sample(jobs.filter("tag like 'x%'")).collect()] == [("_UNATTRIBUTED", 1, 3.0, 0.0, 3.0, 0)]
    assert A.cost_per_sample(jobs.limit(0)).collect() == []


def test_durations_memory_and_files(spark):
    df = spark.createDataFrame([("1-02:40:50", "4000Mc", 8, 2), ("00:00:01", "16GBn", 8, 2), ("5:30", "512B", 8, 2), (None, None, 1, 1), ("x", "lots", 0, 0), ("01:00:00", "2", 0, 1)], "t string, m string, c int, n int")
    got = [tuple(r) for r in df.select(A.duration_hours(F.col("t")), A.memory_gb(F.col("m"), "M", F.col("c"), F.col("n"))).collect()]
    assert got == [(26.6804, 31.25), (0.0002, 32.0), (None, 512 / 1024**3), (None, None), (None, None), (1.0, 2 / 1024)]
    files = spark.createDataFrame([("a", "x/1.bam"), ("a", "x/0.bam"), ("b", None), ("c", "y/1.txt")], "sample string, path string")
    states = A.expected_files(files, files, {"bam": "x/?.bam", "text": "*.txt"})
    assert {r["sample"]: (r["bam"], r["text"], r["gaps"]) for r in A.file_matrix(states, ["bam", "text"]).collect()} == {"a": ("Found x/0.bam", "Missing", 1), "b": ("Missing", "Missing", 2), "c": ("Missing", "Found y/1.txt", 1)}


def test_sheets_round_trip(spark, tmp_path):
    pairs = spark.createDataFrame([("OG1", "/a.R1.fq", "/a.R2.fq"), ("OG2", "/b.R1.fq", "/b.R2.fq")], "og_id string, r1 string, r2 string")
    resolved = spark.createDataFrame([("OG1", "Aus bus", 7, "Cls", "db", "species_exact", "")], "og_id string, nominal_species_id string, taxid long, class string, source string, match_level string, rank_used string")
    sinks.write_sheet(samples.build_sheet(pairs, resolved, "NOVA_250131_AD"), f"{tmp_path}/sheet")
    back = spark.read.csv(f"{tmp_path}/sheet", header=True)
    assert tuple(back.columns) == ("sample", "run", "date", "prefix", "nom_species_id", "taxon_id", "class", "fastq_1", "fastq_2") and back.count() == 2
    sinks.write_sheet(sinks.resolution_rows(resolved), f"{tmp_path}/resolution", sinks.RESOLUTION, "\t")
    assert spark.read.csv(f"{tmp_path}/resolution", header=True, sep="\t").first()["taxon_id"] == "7"
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    sinks.write_audit(one, one, f"{tmp_path}/audit", one, one, one)
    assert all(spark.read.csv(f"{tmp_path}/audit/{n}", sep="\t", header=True).count() == 1 for n in ("verification", "inventory", "upload")) and spark.read.json(f"{tmp_path}/audit/summary").count() == 1


def test_class_falls_back_to_phylum(spark):
    nodes = spark.createDataFrame([(1, None, "no rank", "root"), (2, 1, "phylum", "Placozoa"), (3, 2, "species", "Trichoplax x"), (4, 2, "class", "Cls"), (5, 4, "species", "y z")], "taxid long, parent long, rank string, name string")
    got = {r["taxid"]: r["class_name"] for r in taxonomy.lineage(taxonomy.closure(nodes), nodes).collect()}
    assert got[3] == "Placozoa" and got[5] == "Cls" and got[1] is None


def test_packed_kmers_and_trough(spark):
    from lanefold.functions.sequences import kmer_text, kmers as as_text

    df = spark.createDataFrame([("ACGTNACGGTTA",), ("AC",), ("",), (None,), ("NNN",), ("TTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTT",)], "seq string")
    for k in (1, 3, 4, 31):
        text = {r["seq"]: sorted(r["a"] or []) for r in df.select("seq", as_text(F.col("seq"), k).alias("a")).collect()}
        packed = kmers.packed_kmers(df.withColumn("sample", F.col("seq")), k).groupBy("sample").agg(F.sort_array(F.collect_list(kmer_text(F.col("kmer"), k))).alias("a"))
        packed = {r["sample"]: r["a"] for r in packed.collect()}
        assert all(packed.get(seq, []) == a for seq, a in text.items())
    hist = [40, 20, 10, 5, 3, 4, 8, 15, 20, 15, 8, 4, 3, 2, 2, 2, 2, 2, 2, 2, 2, 2]
    reads = spark.createDataFrame([("s", 1000 * c + j, c) for c, n in enumerate(hist, 1) for j in range(n)], "sample string, kmer long, cnt long")
    (r,) = kmers.kmer_completeness(reads, reads.filter("cnt <> 9")).collect()
    assert r["solid_kmers"] == sum(hist[2:]) and r["found_kmers"] == sum(hist[2:]) - 20


def test_uploads_and_sources(spark, tmp_path):
    record = spark.createDataFrame([(1, None, None, 3), (2, 5, None, None)], "k int, a int, b int, num_contigs int")
    families = {"x": {"a": "t1", "b": "t1"}, "y": {"num_contigs": ("t2", "num_contigs_lt_500bp")}}
    got = store.upsert_families({"t1": spark.createDataFrame([(2, 1, 9, "keep")], "k int, a int, b int, c string")}, record, families, ["k"])
    assert [tuple(r) for r in got["t1"].collect()] == [(2, 5, None, "keep")] and [tuple(r) for r in got["t2"].collect()] == [(1, 3)]
    with pytest.raises(ValueError, match="none of its columns"):
        store.family_tables(record, {"z": {"absent": "t"}}, ["k"])
    with pytest.raises(ValueError, match="not unique"):
        store.family_tables(record.union(record), families, ["k"])
    lines = spark.createDataFrame([("1|acc|COMPLETED",), ("1.batch||",), ("  ",)], "value string")
    rows = job_accounting(lines).orderBy("JobID").collect()
    assert [(r["job_id"], r["is_parent"], r["State"], r["Submit"]) for r in rows] == [("1", True, "COMPLETED", "N/A"), ("1", False, None, "N/A")]
    record.write.parquet(f"{tmp_path}/rec.parquet")
    assert read_curated(spark, str(tmp_path), "rec").count() == 2


def test_genome_size_only_flow(spark):
    from lanefold.sources.adapters import domain

    t = domain(spark, "/root/testdata/sf0.001", "fits")
    s = F.col("sample")
    depth = t.select("sample", "lam", "host_size", "partition_status", "partition_confidence", (s % 10 * 0.1).alias("host_ratio"), F.col("host_size").alias("host_haploid_size"), (s % 4 != 0).alias("depth_measured"))
    fits = t.drop("lam", "host_size", "partition_status", "partition_confidence")
    refits = t.select("sample", (F.col("fit_full") + 10).alias("new_fit_full"), F.col("fit_all").alias("new_fit_all"), F.col("lam").alias("new_kmercov"), F.lit(1.0).alias("new_het_max"), (F.col("size_max") + 5).alias("new_size_max"))
    final, plan, refused = flows.genome_size_only(fits, refits, depth)
    n = t.count()
    assert final.count() == n and 0 < plan.count() <= n and refused.count() == 0
    stored = t.filter("sample % 2 = 0").select("sample", F.lit(0).cast("long").alias("estimated_genome_size"), F.lit("old").alias("coverage_status"))
    kept, _, gone = flows.genome_size_only(fits, refits, depth, stored)
    assert kept.count() == stored.count() and gone.count() == n - stored.count() and kept.filter("coverage_status = 'old'").count() == 0
