"""Queries on reads and k-mers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanefold.functions.sequences import kmer_text
from lanefold.operators import kmers as K
from lanefold.operators import reads as R
from lanefold.plans.registry import query
from lanefold.plans.scratch import scratch
from lanefold.sources.adapters import domain, with_domain
from lanefold.sources.fastq import merge_lanes, read_fastq
from lanefold.sources.sheets import read_assignments

_PAIRS = """pairs AS (SELECT coalesce(a.sample, b.sample) AS sample, coalesce(a.read_id, b.read_id) AS read_id, a.seq AS seq1, b.seq AS seq2, a.qual AS qual1, b.qual AS qual2
  FROM (SELECT * FROM reads WHERE mate = 1) a FULL JOIN (SELECT * FROM reads WHERE mate = 2) b ON a.sample = b.sample AND a.read_id = b.read_id)"""


def _pairs(spark, sf_dir):
    return R.repair_pairs(domain(spark, sf_dir, "reads"))


@query(with_domain("reads", f"WITH {_PAIRS} SELECT sample, read_id, seq1, seq2, (seq1 IS NULL OR seq2 IS NULL) AS single FROM pairs"))
def c3_repair_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select("sample", "read_id", "seq1", "seq2", "single")


@query(with_domain("reads", f"WITH {_PAIRS} SELECT sample, read_id, substr(seq1, 1, 150) AS seq1, substr(seq2, 1, 150) AS seq2 FROM pairs WHERE length(substr(seq1, 1, 150)) >= 100 AND length(substr(seq2, 1, 150)) >= 100"))
def c4_filter_length(spark, sf_dir):
    return R.filter_length(_pairs(spark, sf_dir), 100, 150).select("sample", "read_id", "seq1", "seq2")


@query(with_domain("reads", f"WITH {_PAIRS} SELECT sample, seq1, seq2, min(read_id) AS read_id, arg_min(qual1, read_id) AS qual1, arg_min(qual2, read_id) AS qual2, count(*) AS copies FROM pairs GROUP BY sample, seq1, seq2"))
def c5_dedup_pairs(spark, sf_dir):
    return R.dedup_pairs(_pairs(spark, sf_dir))


@query(with_domain("reads", """
WITH ends AS (SELECT r.*, e FROM reads r, LATERAL (SELECT unnest(range(4, length(qual) + 1)) AS e) x),
good AS (SELECT sample, read_id, mate, max(e) AS n FROM ends
  WHERE ascii(substr(qual, e, 1)) + ascii(substr(qual, e - 1, 1)) + ascii(substr(qual, e - 2, 1)) + ascii(substr(qual, e - 3, 1)) - 132 >= 80 GROUP BY sample, read_id, mate)
SELECT r.sample, r.read_id, r.mate, substr(r.seq, 1, CASE WHEN length(r.qual) < 4 THEN length(r.qual) ELSE coalesce(n, 0) END) AS seq
FROM reads r LEFT JOIN good g ON r.sample = g.sample AND r.read_id = g.read_id AND r.mate = g.mate"""))
def c6_cut_tail(spark, sf_dir):
    return R.cut_tail(domain(spark, sf_dir, "reads")).select("sample", "read_id", "mate", "seq")


_SUMMARY = """summary AS (SELECT sample, mate, count(*) AS n_reads, sum(length(seq))::BIGINT AS bases, sum(length(regexp_replace(qual, '[!-4]', '', 'g')))::BIGINT AS q20_bases,
  sum(length(regexp_replace(qual, '[!->]', '', 'g')))::BIGINT AS q30_bases, sum(length(regexp_replace(seq, '[^GC]', '', 'g')))::BIGINT AS gc_bases FROM reads GROUP BY sample, mate)"""


@query(with_domain("reads", f"WITH {_SUMMARY} SELECT *, q20_bases / bases AS q20_rate, q30_bases / bases AS q30_rate, gc_bases / bases AS gc_content, bases / n_reads AS mean_length FROM summary"))
def c7_read_summary(spark, sf_dir):
    return R.read_summary(domain(spark, sf_dir, "reads"))


_JUDGED = f"""{_PAIRS}, lows AS (SELECT *, length(regexp_replace(qual1, '[0-~]', '', 'g')) AS low1, length(regexp_replace(qual2, '[0-~]', '', 'g')) AS low2 FROM pairs),
codes AS (SELECT *, CASE WHEN coalesce(low1, 0) * 100 > length(seq1) * 26 THEN 20 WHEN coalesce(length(seq1), 0) < 60 THEN 16 ELSE 0 END AS c1,
  CASE WHEN coalesce(low2, 0) * 100 > length(seq2) * 26 THEN 20 WHEN coalesce(length(seq2), 0) < 60 THEN 16 ELSE 0 END AS c2 FROM lows),
judged AS (SELECT sample, CASE greatest(c1, c2) WHEN 20 THEN 'low_quality' WHEN 16 THEN 'too_short' ELSE 'passed' END AS reason, unnest([1, 2]) AS mate, unnest([seq1, seq2]) AS seq, unnest([qual1, qual2]) AS qual FROM codes),
whole AS (SELECT *, length(seq) AS len, length(regexp_replace(qual, '[!-4]', '', 'g')) AS q20, length(regexp_replace(qual, '[!->]', '', 'g')) AS q30, length(regexp_replace(seq, '[^GC]', '', 'g')) AS gc, reason = 'passed' AS ok FROM judged WHERE seq IS NOT NULL)"""
_PART = """count(*) {f} AS {p}total_reads, coalesce(sum(len) {f}, 0)::BIGINT AS {p}total_bases, coalesce(sum(q20) {f}, 0)::BIGINT AS {p}q20_bases, coalesce(sum(q30) {f}, 0)::BIGINT AS {p}q30_bases,
  coalesce(floor(avg(len) FILTER (mate = 1{a})), 0)::BIGINT AS {p}read1_mean_length, coalesce(floor(avg(len) FILTER (mate = 2{a})), 0)::BIGINT AS {p}read2_mean_length,
  coalesce(sum(q20) {f} / sum(len) {f}, 0) AS {p}q20_rate, coalesce(sum(q30) {f} / sum(len) {f}, 0) AS {p}q30_rate, coalesce(sum(gc) {f} / sum(len) {f}, 0) AS {p}gc_content"""


@query(with_domain("reads", f"""WITH {_JUDGED} SELECT sample, count(*) FILTER (ok) AS passed_filter_reads, 0::BIGINT AS too_many_n_reads, count(*) FILTER (reason = 'too_short') AS too_short_reads, 0::BIGINT AS too_long_reads,
  count(*) FILTER (reason = 'low_quality') AS low_quality_reads, {_PART.format(f='', p='raw_', a='')}, {_PART.format(f='FILTER (ok)', p='', a=' AND ok')} FROM whole GROUP BY sample"""))
def c7_filter_summary(spark, sf_dir):
    return R.filter_summary(R.filter_reasons(R.measured_pairs(domain(spark, sf_dir, "reads")), shortest=60, low_pct=26))


@query(with_domain("tax_nodes reads", """
, assigned AS (SELECT sample, read_id, 1000000 + read_id % 150 AS taxid FROM reads WHERE mate = 1 AND read_id % 7 <> 0),
below AS (WITH RECURSIVE b AS (SELECT taxid FROM tax_nodes WHERE taxid IN (11, 12) UNION ALL SELECT t.taxid FROM tax_nodes t JOIN b ON t.parent = b.taxid) SELECT taxid FROM b)
SELECT sample, read_id, mate FROM reads r WHERE NOT EXISTS (SELECT 1 FROM assigned a WHERE a.sample = r.sample AND a.read_id = r.read_id AND a.taxid IN (SELECT taxid FROM below))""".replace("\n, assigned", "\nWITH assigned")))
def c8_exclude_clades(spark, sf_dir):
    from lanefold.operators import taxonomy as X

    reads = domain(spark, sf_dir, "reads")
    assigned = reads.filter("mate = 1 and read_id % 7 <> 0").select("sample", "read_id", (F.lit(1000000) + F.col("read_id") % 150).alias("taxid"))
    labels = X.tree_labels(domain(spark, sf_dir, "tax_nodes"))
    return R.exclude_clade_ranges(reads, assigned, labels, [11, 12]).select("sample", "read_id", "mate")


@query(with_domain("reads", f"""WITH {_PAIRS} SELECT sample, read_id % 7 <> 0 AS classified, read_id::VARCHAR AS read_id, CASE WHEN read_id % 7 = 0 THEN 0 ELSE 1000000 + read_id % 150 END AS taxid,
  length(seq1) AS length1, length(seq2) AS length2 FROM pairs WHERE seq1 IS NOT NULL"""))
def a23_read_assignments(spark, sf_dir):
    t, found = _pairs(spark, sf_dir).filter("seq1 IS NOT NULL"), F.col("read_id") % 7 != 0
    number = (F.lit(1000000) + F.col("read_id") % 150).cast("string")
    taxon = F.when(~found, "0").when(F.col("read_id") % 2 == 0, F.concat(F.lit("some name (taxid "), number, F.lit(")"))).otherwise(number)
    line = F.concat_ws("\t", F.when(found, "C").otherwise("U"), F.col("read_id").cast("string"), taxon, F.concat_ws("|", F.length("seq1").cast("string"), F.length("seq2").cast("string")), F.lit("0:12 9:3"))
    return read_assignments(t.select("sample", line.alias("value")))


_REPORT = """WITH report AS (SELECT s_suppkey % 7 AS sample, n_nationkey AS taxid, CASE WHEN n_nationkey = 0 THEN 'U' ELSE 'S' END AS rank, count(*) * 100 + n_nationkey AS clade_reads
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY s_suppkey % 7, n_nationkey),
t AS (SELECT sample, sum(CASE WHEN rank = 'U' OR taxid = 1 THEN clade_reads ELSE 0 END)::BIGINT AS total_reads, sum(CASE WHEN taxid IN (0, 5) THEN clade_reads ELSE 0 END)::BIGINT AS removed_reads FROM report GROUP BY sample)"""


def _report(spark, sf_dir):
    s, n = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "nation"))
    report = s.join(n, s["s_nationkey"] == n["n_nationkey"]).groupBy((F.col("s_suppkey") % 7).alias("sample"), F.col("n_nationkey").alias("taxid")).agg(F.count("*").alias("n"))
    report = report.select("sample", "taxid", F.when(F.col("taxid") == 0, "U").otherwise("S").alias("rank"), (F.col("n") * 100 + F.col("taxid")).alias("clade_reads"))
    return report


@query(f"{_REPORT} SELECT *, total_reads - removed_reads AS kept_reads, CASE WHEN total_reads = 0 THEN 0 ELSE round((total_reads - removed_reads) * 100.0::DOUBLE / total_reads, 2) END AS retention_pct FROM t")
def c9_retention(spark, sf_dir):
    return R.retention(_report(spark, sf_dir), [0, 5])


@query(f"""{_REPORT} SELECT r.sample, taxid, clade_reads::BIGINT AS removed_reads, CASE WHEN total_reads = 0 THEN 0 ELSE round(clade_reads * 100.0::DOUBLE / total_reads, 2) END AS share_pct
FROM report r JOIN t ON r.sample = t.sample WHERE taxid IN (0, 5)""")
def c9_taxon_shares(spark, sf_dir):
    return R.retention_shares(_report(spark, sf_dir), [0, 5])


@query(with_domain("reads", """SELECT * EXCLUDE (p), p[1] AS q10, p[2] AS q25, p[3] AS q50, p[4] AS q75, p[5] AS q90 FROM (SELECT sample, i AS pos, count(*) AS n, count(*) FILTER (substr(seq, i::INT, 1) = 'A') AS n_a,
  count(*) FILTER (substr(seq, i::INT, 1) = 'C') AS n_c, count(*) FILTER (substr(seq, i::INT, 1) = 'G') AS n_g, count(*) FILTER (substr(seq, i::INT, 1) = 'T') AS n_t, count(*) FILTER (substr(seq, i::INT, 1) NOT IN ('A', 'C', 'G', 'T')) AS n_other,
  quantile_cont((ascii(substr(qual, i::INT, 1)) - 33)::DOUBLE, [0.1, 0.25, 0.5, 0.75, 0.9]) AS p, count(*) FILTER (substr(seq, i::INT, 1) IN ('G', 'C')) AS gc, sum(ascii(substr(qual, i::INT, 1)) - 33)::BIGINT AS quality_sum
FROM reads, LATERAL (SELECT unnest(range(1, length(seq) + 1)) AS i) x GROUP BY sample, i) y"""))
def c10_position_profile(spark, sf_dir):
    return R.position_profile(domain(spark, sf_dir, "reads"))


@query(with_domain("reads", f"WITH {_SUMMARY} SELECT sample, avg(CASE WHEN bases > 0 THEN bases / n_reads END) AS mean_read_length FROM summary GROUP BY sample"))
def c11_mean_read_length(spark, sf_dir):
    return R.mean_read_length(R.read_summary(domain(spark, sf_dir, "reads")))


_COUNTS = """{name} AS (SELECT sample, least(w, reverse(translate(w, 'ACGT', 'TGCA'))) AS kmer, count(*) AS cnt FROM (
    SELECT sample, substr(seq, i::INT, {k}) AS w FROM {table}, LATERAL (SELECT unnest(range(1, length(seq) - {k} + 2)) AS i) x) y
  WHERE NOT regexp_matches(w, '[^ACGT]') GROUP BY ALL)"""
_READS = _COUNTS.format(name="rk", table="reads", k=21)
_ASM = _COUNTS.format(name="ak", table="contigs", k=21)


def _counts(spark, sf_dir, table):
    return K.count_kmers(domain(spark, sf_dir, table).select("sample", "seq"), 21)


def _spectrum(spark, sf_dir):
    reads, contigs = (domain(spark, sf_dir, t).select("sample", "seq") for t in ("reads", "contigs"))
    return K.joint_spectrum(reads, contigs, 21)


def _text(counts):
    return counts.withColumn("kmer", kmer_text(F.col("kmer"), 21))


@query(with_domain("reads", f"WITH {_READS} SELECT * FROM rk"))
def d1_count_kmers(spark, sf_dir):
    return _text(_counts(spark, sf_dir, "reads"))


@query(with_domain("reads contigs", f"WITH {_READS}, {_ASM} SELECT sample, kmer, sum(cnt)::BIGINT AS cnt FROM (SELECT * FROM rk UNION ALL SELECT * FROM ak) u GROUP BY sample, kmer"))
def d2_union_sum(spark, sf_dir):
    return _text(K.count_together(*(domain(spark, sf_dir, t).select("sample", "seq") for t in ("reads", "contigs"))))


@query(with_domain("contigs", f"WITH {_ASM} SELECT sample, cnt AS cov, count(*) AS cnt FROM ak GROUP BY sample, cnt"))
def d3_kmer_histogram(spark, sf_dir):
    return K.kmer_histogram(_counts(spark, sf_dir, "contigs"))


PEAK_SQL = """k AS (SELECT h.*, count(*) OVER (PARTITION BY sample) AS rows0, first_value(cnt) OVER (PARTITION BY sample ORDER BY cov) AS f FROM hist h),
k1 AS (SELECT *, count(*) OVER (PARTITION BY sample) AS rows1, max(cnt) OVER (PARTITION BY sample ORDER BY cov ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS nx FROM k WHERE cnt >= 0.001 * f),
k2 AS (SELECT *, min(CASE WHEN nx > 1.05 * cnt THEN cov END) OVER (PARTITION BY sample) AS trough FROM k1),
k3 AS (SELECT sample, any_value(rows0) AS rows0, any_value(rows1) AS rows1, any_value(trough) AS trough, max(CASE WHEN cov = trough THEN cnt END) AS tc,
  max(CASE WHEN cov >= trough THEN cnt END) AS best, arg_max(cov, cnt * 100000 - cov) FILTER (cov >= trough) AS top FROM k2 GROUP BY sample),
peaks AS (SELECT sample, trough, top, CASE WHEN rows0 < 20 OR rows1 < 20 THEN 'histogram_too_short' WHEN trough IS NULL THEN 'no_trough_histogram_monotone'
  WHEN tc <= 0 OR best < 1.3 * tc THEN 'no_mode_above_trough' ELSE 'ok' END AS reason FROM k3)"""


@query(with_domain("hist", f"WITH {PEAK_SQL} SELECT sample, CASE WHEN reason = 'ok' THEN top END AS peak_cov, CASE WHEN reason IN ('ok', 'no_mode_above_trough') THEN trough END AS trough_cov, reason FROM peaks"))
def d4_kmer_peak(spark, sf_dir):
    return K.find_kmer_peak(domain(spark, sf_dir, "hist"))


@query(with_domain("reads contigs", f"""WITH {_READS}, {_ASM}, t AS (SELECT ak.sample, sum(CASE WHEN rk.kmer IS NULL THEN ak.cnt ELSE 0 END)::BIGINT AS only_kmers, sum(ak.cnt)::BIGINT AS total_kmers
  FROM ak LEFT JOIN rk ON ak.sample = rk.sample AND ak.kmer = rk.kmer GROUP BY ak.sample), e AS (SELECT *, 1 - pow(1 - only_kmers / total_kmers, 1.0::DOUBLE / 21) AS err FROM t)
SELECT sample, only_kmers, total_kmers, round(err, 9) AS error, round(CASE WHEN err > 0 THEN -10 * log10(err) END, 6) AS qv FROM e"""))
def d5_assembly_qv(spark, sf_dir):
    t = K.qv_of(_spectrum(spark, sf_dir))
    return t.withColumns({"error": F.round("error", 9), "qv": F.round("qv", 6)})


@query(with_domain("reads contigs", f"""WITH {_READS}, {_ASM} SELECT rk.sample, count(*) AS solid_kmers, count(ak.kmer) AS found_kmers, count(ak.kmer) * 100.0::DOUBLE / count(*) AS completeness
FROM rk LEFT JOIN ak ON ak.sample = rk.sample AND ak.kmer = rk.kmer WHERE rk.cnt >= 2 GROUP BY rk.sample"""))
def d6_kmer_completeness(spark, sf_dir):
    return K.completeness_of(_spectrum(spark, sf_dir), 2)


@query(with_domain("reads contigs", f"""WITH {_READS}, {_ASM} SELECT rk.sample, rk.cnt AS multiplicity, least(coalesce(ak.cnt, 0), 5) AS copies, count(*) AS n
FROM rk LEFT JOIN ak ON ak.sample = rk.sample AND ak.kmer = rk.kmer GROUP BY ALL"""))
def d7_spectra_cn(spark, sf_dir):
    return K.copies_of(_spectrum(spark, sf_dir))


def _fastq(spark, sf_dir):
    """The reads as FASTQ files (gzip, and plain for every fourth sample name), read back."""
    record = F.concat(F.lit("@"), F.col("read_id").cast("string"), F.lit("/"), F.col("mate").cast("string"), F.lit(" run 1\n"), "seq", F.lit("\n+\n"), "qual")
    path = scratch(spark, "fastq")
    for kind, keep in (("gzip", "<> 0"), ("none", "= 0")):
        t = domain(spark, sf_dir, "reads", f"length(coalesce(source, 'none')) % 4 {keep}")
        rows = t.select(F.coalesce("sample", F.lit("none")).alias("sample"), (F.col("read_id") % 2).alias("lane"), "mate", record.alias("value"))
        rows.write.partitionBy("sample", "lane", "mate").text(f"{path}/kind={kind}", compression=kind)
    return read_fastq(spark, path, r"sample=([^/]*)/lane=([^/]*)/mate=([12])/")


@query(with_domain("reads", "SELECT coalesce(sample, 'none') AS sample, (read_id % 2)::VARCHAR AS lane, mate, read_id::VARCHAR AS read_id, seq, qual FROM reads"))
def c1_read_fastq(spark, sf_dir):
    return _fastq(spark, sf_dir)


@query(with_domain("reads", "SELECT coalesce(sample, 'none') AS sample, mate, count(*) AS reads, sum(length(seq))::BIGINT AS bases FROM reads GROUP BY ALL"))
def c2_merge_lanes(spark, sf_dir):
    return merge_lanes(_fastq(spark, sf_dir)).groupBy("sample", "mate").agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"))
