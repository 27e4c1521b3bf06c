"""Keys of assemblies, digests of files and rules of copies."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from lanefold.operators import accounting as A


def test_arguments_without_resources():
    same = {A.without_resources(x) for x in ("--k-list 21", "  --k-list   21 ", "-t 16 --k-list 21", "--k-list 21 -t 32 -m 8", "-t=4 --memory=0.9 --k-list 21", "--memory 0.5 --k-list 21 --num-cpu-threads 8", "--k-list 21 -t")}
    assert same == {"--k-list 21"}
    assert A.without_resources("--threads 4 -tx -mm=3") == "--threads 4 -tx -mm=3" and A.without_resources("") == ""


def test_checkpoint_key(spark):
    kind = "sample string, prefix string, path string, bytes long"
    rows = [("s", "p", "/a/r1.fq", 10), ("s", "p", "/b/r2.fq", 20), ("t", "p", "/a/r1.fq", 10), ("u", "q", "/x/r2.fq", 20), ("u", "q", "/y/r1.fq", 10)]
    got = {r[0]: r[1] for r in A.checkpoint_key(spark.createDataFrame(rows, kind), "1.2.9", "--x 1 -t 4").collect()}
    assert got["s"] == sha256(b"megahit_version=1.2.9\nargs=--x 1\nout_prefix=p\nread=r1.fq\t10\nread=r2.fq\t20\n").hexdigest()
    assert len(set(got.values())) == 3
    again = {r[0]: r[1] for r in A.checkpoint_key(spark.createDataFrame(rows[::-1], kind).repartition(4), "1.2.9", "-t 64 --x 1").collect()}
    assert again == got
    assert A.checkpoint_key(spark.createDataFrame([], kind), "1").collect() == []


def test_fingerprint_of_many_files(spark):
    t = spark.range(5000).select((F.col("id") % 3).alias("sample"), F.lit("c").alias("component"), F.col("id").alias("event_id"), (F.col("id") * 7).alias("bytes"))
    one = sorted(A.fingerprint(t).collect())
    assert one == sorted(A.fingerprint(t.orderBy(F.desc("bytes")).repartition(7)).collect()) and len({r[1] for r in one}) == 3
    for other in (t.filter("event_id <> 4998"), t.unionByName(t.filter("event_id = 4998")), t.withColumn("bytes", F.col("bytes") + (F.col("event_id") == 4998).cast("int"))):
        assert [a[1] == b[1] for a, b in zip(one, sorted(A.fingerprint(other).collect()), strict=True)] == [False, True, True]


def test_copy_rules(spark):
    t = spark.createDataFrame([("fastp/a.fastq.gz",), ("fastp/a.json",), ("x/fastp/b",), ("assemblies/genome/a.fna",), ("assemblies/genome/d/a.fna",), ("notes.txt",)], "path string")
    kept = lambda rules: [r["path"] for r in t.filter(A.copy_rules(F.col("path"), rules)).collect()]
    assert kept(["- fastp/**"]) == ["assemblies/genome/a.fna", "assemblies/genome/d/a.fna", "notes.txt"]
    assert kept(["- /fastp/**"]) == ["x/fastp/b", "assemblies/genome/a.fna", "assemblies/genome/d/a.fna", "notes.txt"]
    assert kept(["+ fastp/*.fastq.gz", "+ assemblies/genome/*.fna", "- **"]) == ["fastp/a.fastq.gz", "assemblies/genome/a.fna"]
    assert len(kept([])) == 6
    with pytest.raises(ValueError):
        A.copy_rules(F.col("path"), ["fastp"])


def test_process_order_and_cpu_time(spark):
    jobs = spark.createDataFrame([("a:X", 1.0, 10.0), ("b:Y", 5.0, 30.0), ("c:Y", 5.0, 50.0), (None, 0.5, None)], "process string, su double, cpu_eff double").withColumns({"mem_eff": F.col("cpu_eff"), "wall_eff": F.lit(1.0)})
    got = [(r["process"], r["jobs"], r["su"], r["cpu_eff_median"], r["rank"]) for r in A.by_process(jobs).collect()]
    assert got == [("Y", 2, 10.0, 40.0, 1), ("X", 1, 1.0, 10.0, 2), (None, 1, 0.5, None, 3)]
    t = spark.createDataFrame([(4, 8, 100, None), (4, 8, 100, 400), (4, None, 100, 0)], "cores int, alloc_cpus int, elapsed_s int, cpu_time_raw long").withColumns({"cpu_s": F.lit(200), "rss_gb": F.lit(1), "mem_gb": F.lit(2), "limit_s": F.lit(200)})
    assert sorted(r["cpu_eff"] for r in A.efficiencies(t).collect()) == [25.0, 50.0, 50.0]
