"""Reports are written out from the domain tables as their tools would, and parsed again."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanefold.plans.registry import query
from lanefold.sources import reports as R
from lanefold.sources.adapters import domain, with_domain


@query(with_domain("fits", "SELECT sample, size_min, size_max, het_min, het_max, fit_all, fit_full FROM fits"))
def a6_fit_summary(spark, sf_dir):
    bp = lambda c: F.coalesce(F.concat(F.format_number(c, 0), F.lit(" bp")), F.lit("Inf bp"))
    pct = lambda c: F.coalesce(F.concat(F.col(c).cast("string"), F.lit("%")), F.lit("NA"))
    row = lambda label, f, a, b: F.concat(F.rpad(F.lit(label), 30, " "), F.rpad(f(a), 20, " "), F.lit("  "), f(b))
    text = F.concat_ws("\n", F.lit("property                      min               max"), row("Heterozygous (ab)", pct, "het_min", "het_max"), row("Genome Haploid Length", bp, "size_min", "size_max"), row("Model Fit", pct, "fit_all", "fit_full"))
    return R.fit_summary(domain(spark, sf_dir, "fits").select("sample", text.alias("text")))


@query(with_domain("fits", "SELECT sample, kmercov, bias FROM fits"))
def a8_fit_model(spark, sf_dir):
    text = F.concat_ws("\n", F.lit("Formula: y ~ x\nkmercov 1.0 x"), F.concat(F.lit("kmercov  "), F.col("kmercov").cast("string"), F.lit("  0.1 ***")), F.concat(F.lit("bias "), F.col("bias").cast("string")))
    return R.fit_model(domain(spark, sf_dir, "fits").select("sample", text.alias("text")), ("kmercov", "bias"))


@query(with_domain("hist", "SELECT sample, cov, cnt FROM hist WHERE cov <= 200"))
def a9_histogram(spark, sf_dir):
    lines = F.array_join(F.array_sort(F.collect_list(F.concat_ws("\t", F.col("cov").cast("string"), F.col("cnt").cast("string")))), "\n")
    return R.histogram(domain(spark, sf_dir, "hist").groupBy("sample").agg(lines.alias("text")), 200)


@query(with_domain("actions", """SELECT contig % 10 AS sample, count(*) FILTER (action = 'EXCLUDE') AS exclude_contigs, coalesce(sum(a_end) FILTER (action = 'EXCLUDE'), 0)::BIGINT AS exclude_bp, count(*) FILTER (action = 'TRIM') AS trim_contigs,
coalesce(sum(a_end) FILTER (action = 'TRIM'), 0)::BIGINT AS trim_bp, count(*) FILTER (action = 'REVIEW') AS review_contigs, coalesce(sum(a_end) FILTER (action = 'REVIEW'), 0)::BIGINT AS review_bp FROM actions GROUP BY contig % 10"""))
def a15_filter_report(spark, sf_dir):
    t = domain(spark, sf_dir, "actions").groupBy((F.col("contig") % 10).alias("sample"), "action").agg(F.count("*").alias("n"), F.sum("a_end").alias("bp"))
    line = F.concat_ws(" ", F.lower("action"), F.col("n").cast("string"), F.col("bp").cast("string"), F.lit("bp"))
    return R.filter_report(t.groupBy("sample").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("text")))


@query(with_domain("contig_depth", "SELECT sample, contig::VARCHAR AS contig, length, meandepth FROM contig_depth WHERE length > 0"))
def a21_contig_depth(spark, sf_dir):
    t = domain(spark, sf_dir, "contig_depth")
    line = F.concat_ws("\t", F.col("contig").cast("string"), F.lit("1"), F.col("length").cast("string"), F.lit("9"), F.lit("9"), F.lit("99.0"), F.col("meandepth").cast("string"), F.lit("30"), F.lit("60"))
    head = F.lit("#rname\tstartpos\tendpos\tnumreads\tcovbases\tcoverage\tmeandepth\tmeanbaseq\tmeanmapq\n")
    return R.contig_depth(t.groupBy("sample").agg(F.concat(head, F.array_join(F.collect_list(line), "\n")).alias("text")))


_STR = lambda c: F.col(c).cast("string")


@query(with_domain("fits", "SELECT sample, busco_complete::DOUBLE AS complete FROM fits"))
def a13_completeness(spark, sf_dir):
    pct = _STR("busco_complete")
    direct = F.concat(F.lit('{"results": {"Complete percentage": '), pct, F.lit(', "one_line_summary": "C:1.0%[S:1.0%]"}}'))
    line = F.concat(F.lit('{"results": {"one_line_summary": "C:'), pct, F.lit('.0%[S:1.0%,D:0.0%]"}}'))
    return R.completeness(domain(spark, sf_dir, "fits").select("sample", F.when(F.col("sample") % 2 == 0, direct).otherwise(line).alias("text")))


@query(with_domain("hits", """WITH r AS (SELECT query % 20 AS sample, subject % 7 AS c, q_start AS n, q_end AS bp FROM hits)
SELECT sample, coalesce(sum(n) FILTER (c IN (0, 1)), 0)::BIGINT AS num_contigs_mitochondrion, coalesce(sum(bp) FILTER (c IN (0, 1)), 0)::BIGINT AS bp_mitochondrion, coalesce(sum(n) FILTER (c = 2), 0)::BIGINT AS num_contigs_plastid,
coalesce(sum(bp) FILTER (c = 2), 0)::BIGINT AS bp_plastid, coalesce(sum(n) FILTER (c IN (3, 4)), 0)::BIGINT AS num_contigs_prokarya, coalesce(sum(bp) FILTER (c IN (3, 4)), 0)::BIGINT AS bp_prokarya FROM r GROUP BY sample"""))
def a14_domain_report(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in ("Mitochondrion", " mito ", "chloroplast", "Bacteria", "prokarya", "archaea", "organelle")])
    t = domain(spark, sf_dir, "hits").select((F.col("query") % 20).alias("sample"), F.get(names, (F.col("subject") % 7).cast("int")).alias("category"), F.format_number("q_start", 0).alias("num_contigs"), F.col("q_end").alias("bp"))
    return R.domain_report(t)


@query(with_domain("fits", "SELECT sample, CASE WHEN sample % 5 = 0 THEN NULL ELSE sample * 3 END AS num_contigs FROM fits"))
def a16_short_contigs(spark, sf_dir):
    some = F.concat(F.lit("contigs below 500 bp\nin all: "), (F.col("sample") * 3).cast("string"), F.lit("  \nlater 7\n"))
    return R.short_contigs(domain(spark, sf_dir, "fits").select("sample", F.when(F.col("sample") % 5 == 0, "none here\n").otherwise(some).alias("text")))


@query(with_domain("fits", """SELECT sample, CASE WHEN sample % 7 <> 0 THEN 'OG' || sample END AS og_id, CASE WHEN sample % 7 <> 0 THEN '240131' END AS seq_date, CASE WHEN sample % 7 <> 0 THEN '12' END AS unique_k_mers_assembly,
CASE WHEN sample % 7 <> 0 THEN assembly_size::VARCHAR END AS k_mers_total, CASE WHEN sample % 7 <> 0 THEN '41.5' END AS qv, CASE WHEN sample % 7 <> 0 THEN '7e-05' END AS error FROM fits"""))
def a17_quality_values(spark, sf_dir):
    s, tail = _STR("sample"), F.concat(F.lit("\t12\t"), _STR("assembly_size"), F.lit("\t41.5\t7e-05\n"))
    five = F.concat(F.lit("sample\tunique\ttotal\tqv\terror\nOG"), s, F.lit(".ilmn.240131"), tail)
    six = F.concat(F.lit("OG"), s, F.lit("\t240131"), tail)
    text = F.when(F.col("sample") % 7 == 0, F.concat(six, six)).when(F.col("sample") % 2 == 0, five).otherwise(six)
    return R.quality_values(domain(spark, sf_dir, "fits").select("sample", text.alias("text")))


@query(with_domain("fits", """SELECT sample, 10 + sample AS num_scaffolds, assembly_size AS total_scaffold_length, 5000 AS scaffold_n50, 90000 AS largest_scaffold, CASE WHEN sample % 3 = 0 THEN NULL ELSE 12 + sample END AS num_contigs, 4000 AS contig_n50,
fit_all + 0.25::DOUBLE AS gc_pct FROM fits"""))
def a18_contiguity(spark, sf_dir):
    n = lambda d: (F.col("sample") + d).cast("string")
    contigs = F.when(F.col("sample") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("# contigs: "), n(12), F.lit("\n")))
    text = F.concat(F.lit("+++Assembly summary+++:\n# scaffolds: "), n(10), F.lit("\nTotal scaffold length: "), _STR("assembly_size"), F.lit("\nScaffold N50: 5000\nLargest scaffold: 90000\n"), contigs, F.lit("Contig N50: 4000\nGC content %: "), (F.col("fit_all") + 0.25).cast("string"))
    return R.contiguity(domain(spark, sf_dir, "fits").select("sample", text.alias("text"))).withColumns({c: F.col(c).cast("bigint") for c in R.CONTIGUITY})


@query(with_domain("fits", "SELECT sample, assembly_size AS sum_len FROM fits"))
def a19_sequence_total(spark, sf_dir):
    named = F.concat(F.lit("file\tsum_len\tnum_seqs\nx\t"), F.format_number("assembly_size", 0), F.lit("\t5\n"))
    fifth = F.concat(F.lit("a\tb\tc\td\te\nx\tFASTA\tDNA\t5\t"), _STR("assembly_size"), F.lit("\t1\n"))
    return R.sequence_total(domain(spark, sf_dir, "fits").select("sample", F.when(F.col("sample") % 2 == 0, named).otherwise(fifth).alias("text")))
