"""Queries on sheets, manifests, dumps and records for the store; reports are written out from the domain tables and parsed again."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanefold.operators import accounting as A
from lanefold.operators import samples as P
from lanefold.operators import store as S
from lanefold.plans.registry import query
from lanefold.sources import records as R
from lanefold.sources import sheets as H
from lanefold.sources.adapters import domain, with_domain

_S = lambda c: F.col(c).cast("string")


@query(with_domain("sheet", r"""SELECT prefix, concat_ws(',', CASE WHEN sample LIKE 'X%' THEN 'sample' END, CASE WHEN run LIKE '% %' THEN 'run' END, CASE WHEN date = 'Jan' THEN 'date' END,
CASE WHEN taxon_id IS NULL OR taxon_id = 'x' THEN 'taxon_id' END, CASE WHEN fastq_2 NOT LIKE '%.R2.%' THEN 'fastq_2' END) AS errors FROM sheet"""))
def a2_validate_sheet(spark, sf_dir):
    return H.validate_samplesheet(domain(spark, sf_dir, "sheet")).select("prefix", F.array_join("errors", ",").alias("errors"))


@query(with_domain("sheet", "SELECT sample, string_agg(fastq_1 || ';' || fastq_2, ';' ORDER BY fastq_1, fastq_2) AS reads FROM sheet GROUP BY sample"))
def a2_merge_rows(spark, sf_dir):
    return H.merge_rows(domain(spark, sf_dir, "sheet")).withColumn("reads", F.array_join("reads", ";"))


_HALF = "half AS (SELECT 'OG' || c_custkey AS og_id, CASE WHEN c_custkey % 6 > 0 THEN '250131' END AS seq_date, CASE WHEN c_custkey % 5 > 0 THEN '/a/x' || c_custkey || '.fa.gz' ELSE ' ' END AS assembly FROM customer)"


def _half(spark, sf_dir):
    k = F.col("c_custkey")
    t = spark.read.parquet(f"{sf_dir}/customer.parquet")
    t = t.select(F.concat(F.lit("OG"), k.cast("string")).alias("og_id"), F.when(k % 6 > 0, "250131").alias("seq_date"), F.when(k % 5 > 0, F.concat(F.lit("/a/x"), k.cast("string"), F.lit(".fa.gz"))).otherwise(" ").alias("assembly"))
    return H.presence_checked(t.withColumns({c: F.lit("f") for c in H.DEPTH_COLUMNS if c not in t.columns}), H.DEPTH_COLUMNS)


@query(f"WITH {_HALF} SELECT og_id, og_id || '.ilmn.' || seq_date AS prefix, 'x' || substr(og_id, 3) AS assembly_prefix FROM half WHERE seq_date IS NOT NULL AND assembly <> ' '")
def a3_depth_sheet(spark, sf_dir):
    return _half(spark, sf_dir)[0].select("og_id", "prefix", "assembly_prefix")


@query(f"""WITH {_HALF} SELECT og_id || '/? has no seq_date' AS error FROM half WHERE seq_date IS NULL
UNION ALL SELECT og_id || '/' || coalesce(seq_date, '?') || ' has no assembly' FROM half WHERE assembly = ' '""")
def a3_sheet_errors(spark, sf_dir):
    return _half(spark, sf_dir)[1]


@query(with_domain("draft_files", """SELECT og_id || '.ilmn.' || CASE WHEN contains(path, 'NOVA') THEN '250131' ELSE '250214' END AS sample_id, unnest(CASE WHEN path LIKE '%fastp.json' THEN ['fastp', 'json'] WHEN path LIKE '%full_table.tsv' THEN ['busco']
WHEN path LIKE '%meryl.hist' THEN ['hist'] ELSE [] END) AS component, path FROM draft_files"""))
def a5_artifacts(spark, sf_dir):
    return H.artifact_inventory(domain(spark, sf_dir, "draft_files"), {"fastp": r"fastp\.json$", "json": r"\.json$", "busco": r"full_table\.tsv$", "hist": r"meryl\.hist$"})


@query(with_domain("fits", """SELECT 'OG' || sample AS og_id, '250131' AS seq_date, size_min AS genomesize_min, size_max AS genomesize, het_min AS heterozygosity_min, het_max AS heterozygosity, fit_all AS modelfit_allkmers, fit_full AS modelfit,
CASE WHEN size_min IS NULL AND size_max IS NULL THEN 'no finite genome size' END AS error FROM fits"""))
def a7_fit_stats(spark, sf_dir):
    bp = lambda c: F.coalesce(F.concat(F.format_number(c, 0), F.lit(" bp")), F.lit("Inf bp"))
    pct = lambda c: F.coalesce(F.concat(_S(c), F.lit("%")), F.lit("NA"))
    row = lambda label, f, a, b: F.concat_ws("   ", F.lit(label), f(a), f(b))
    og = F.concat(F.lit("OG"), _S("sample"))
    head = F.when(F.col("sample") % 2 == 0, F.concat(F.lit("input file = /k/"), og, F.lit(".ilmn.250131_x.meryl.hist\nname prefix = reseed"))).otherwise(F.concat(F.lit("name prefix = "), og, F.lit(".ilmn.250131")))
    text = F.concat_ws("\n", head, row("Heterozygous (ab)", pct, "het_min", "het_max"), row("Genome Haploid Length", bp, "size_min", "size_max"), row("Model Fit", pct, "fit_all", "fit_full"))
    t = R.fit_stats(domain(spark, sf_dir, "fits").select(text.alias("text")))
    return t.select("og_id", "seq_date", "genomesize_min", "genomesize", "heterozygosity_min", "heterozygosity", "modelfit_allkmers", "modelfit", "error")


def _fastp_files(spark, sf_dir):
    part = lambda c: F.struct(*[F.when(F.col("sample") % 10 > 0, F.col(c)).alias("total_reads"), F.col(c).alias("total_bases"), *[F.lit(7).alias(x) for x in ("q20_bases", "q30_bases", "read1_mean_length", "read2_mean_length")], *[F.lit(0.5).alias(x) for x in ("q20_rate", "q30_rate", "gc_content")]])
    js = F.to_json(F.struct(F.struct(part("bases_before").alias("before_filtering"), part("bases_after").alias("after_filtering")).alias("summary"), F.struct(F.col("peak_cov").alias("passed_filter_reads"), F.lit(3).alias("too_many_N_reads")).alias("filtering_result")))
    return domain(spark, sf_dir, "fits").select(F.concat(F.lit("/f/OG"), _S("sample"), F.lit(".ilmn.NOVA_250131_AD.fastp.json")).alias("name"), js.alias("text"))


@query(with_domain("fits", """SELECT 'OG' || sample AS og_id, '250131' AS seq_date, 'NOVA' AS mach, 'AD' AS initial, coalesce(peak_cov, 0) AS passed_filter_reads, 3::BIGINT AS too_many_n_reads, 0::BIGINT AS too_long_reads, CASE WHEN sample % 10 > 0 THEN bases_before END AS raw_total_reads,
bases_after AS total_bases, 0.5::DOUBLE AS gc_content, CASE WHEN sample % 10 = 0 OR peak_cov IS NULL THEN 'missing ' || concat_ws(', ', CASE WHEN sample % 10 = 0 THEN 'before_filtering.total_reads, after_filtering.total_reads' END, CASE WHEN peak_cov IS NULL THEN 'passed_filter_reads' END) END AS error FROM fits"""))
def a10_fastp(spark, sf_dir):
    return R.fastp(_fastp_files(spark, sf_dir)).select("og_id", "seq_date", "mach", "initial", "passed_filter_reads", "too_many_n_reads", "too_long_reads", "raw_total_reads", "total_bases", "gc_content", "error")


@query(with_domain("fits", "SELECT 'OG' || sample AS sample, 'NOVA_250131_AD' AS run, peak_cov::DOUBLE AS passed_filter_reads, bases_before::DOUBLE AS raw_total_bases, bases_after::DOUBLE AS total_bases FROM fits"))
def a11_fastp_wide(spark, sf_dir):
    return R.fastp_wide(_fastp_files(spark, sf_dir), "raw_").select("sample", "run", "passed_filter_reads", "raw_total_bases", "total_bases")


@query(with_domain("fits", """SELECT 'OG' || sample AS og_id, '250131' AS seq_date, CASE WHEN sample % 4 > 0 THEN busco_complete::DOUBLE END AS complete, CASE WHEN sample % 3 = 0 THEN 5 ELSE assembly_size END AS n_markers, 'meta' AS domain,
CASE WHEN sample % 4 = 0 THEN 'complete and n_markers are required' END AS error FROM fits"""))
def a12_busco(spark, sf_dir):
    s = F.col("sample")
    results = F.struct(F.when(s % 4 > 0, F.concat(_S("busco_complete"), F.lit("%"))).alias("Complete percentage"), F.when(s % 3 == 0, F.lit("5")).alias("n_markers"), F.lit(" meta ").alias("lineage"))
    metrics = F.struct(F.lit("1").alias("fragmented"), F.when(s % 3 > 0, F.format_number("assembly_size", 0)).alias("n_markers"))
    where = F.struct(F.when(s % 2 == 0, F.concat(F.lit("/a/OG"), _S("sample"), F.lit(".ilmn.250131_2.fna"))).alias("in"), F.concat(F.lit("OG"), _S("sample"), F.lit(".ilmn.250131")).alias("out"))
    t = domain(spark, sf_dir, "fits").select(F.lit("x").alias("name"), F.to_json(F.struct(results.alias("results"), metrics.alias("metrics"), where.alias("parameters"))).alias("text"))
    return R.busco(t).select("og_id", "seq_date", "complete", "n_markers", "domain", "error")


def _json_named(spark, sf_dir, *cols):
    return domain(spark, sf_dir, "fits").select(F.concat(F.lit("OG"), _S("sample"), F.lit(".ilmn.250131_kmer.json")).alias("name"), F.to_json(F.struct(*cols)).alias("text"))


@query(with_domain("fits", "SELECT 'OG' || sample AS og_id, '250131' AS seq_date, lam AS lambda_depth, peak_cov AS busco_regions, host_size AS host_assembly_size, partition_confidence FROM fits"))
def a20_kmer_depth(spark, sf_dir):
    t = _json_named(spark, sf_dir, F.col("lam").alias("lambda_depth"), F.col("peak_cov").alias("busco_regions"), F.col("host_size").alias("host_assembly_size"), "partition_confidence", F.lit("").alias("partition_note"))
    return R.kmer_depth(t).select("og_id", "seq_date", "lambda_depth", "busco_regions", "host_assembly_size", "partition_confidence")


@query(with_domain("fits", "SELECT 'OG' || sample AS og_id, sample % 2 = 0 AS genome_size_reliable, CASE WHEN sample % 3 = 0 THEN 9.5 ELSE kmercov END AS kmercov, peak_cov IS NOT NULL AS has_regions FROM fits"))
def a20_verdict(spark, sf_dir):
    s = F.col("sample")
    t = _json_named(spark, sf_dir, (s % 2 == 0).alias("genome_size_reliable"), F.when(s % 3 == 0, F.lit(0.0)).when(s % 3 == 1, F.col("kmercov")).alias("kmercov"), F.when(s % 3 == 0, F.lit(9.5)).otherwise(F.col("kmercov")).alias("fitted_kmer_coverage"), F.col("peak_cov").alias("busco_regions"))
    return R.verdict(t).select("og_id", "genome_size_reliable", "kmercov", "has_regions")


@query(with_domain("tax_nodes", "SELECT taxid, coalesce(parent, 1) AS parent, rank FROM tax_nodes"))
def a22_tax_nodes(spark, sf_dir):
    t = domain(spark, sf_dir, "tax_nodes").select(F.concat(F.concat_ws("\t|\t", _S("taxid"), F.coalesce(_S("parent"), F.lit("1")), F.col("rank"), F.lit("")), F.lit("\t|")).alias("value"))
    return H.tax_nodes(t)


@query(with_domain("tax_nodes", "SELECT taxid, name FROM tax_nodes WHERE taxid % 3 > 0"))
def a22_tax_names(spark, sf_dir):
    kind = F.when(F.col("taxid") % 3 > 0, "scientific name").otherwise("synonym")
    return H.tax_names(domain(spark, sf_dir, "tax_nodes").select(F.concat(F.concat_ws("\t|\t", _S("taxid"), F.col("name"), F.lit(""), kind), F.lit("\t|")).alias("value")))


@query(with_domain("tax_nodes", "SELECT taxid, name, CASE rank WHEN 'clade' THEN 0 WHEN 'class' THEN 1 WHEN 'order' THEN 2 WHEN 'family' THEN 3 ELSE 4 END::BIGINT AS depth, taxid * 2 AS clade_reads, substr(rank, 1, 1) AS rank_code FROM tax_nodes"))
def a23_clade_report(spark, sf_dir):
    level = F.when(F.col("rank") == "clade", 0).when(F.col("rank") == "class", 1).when(F.col("rank") == "order", 2).when(F.col("rank") == "family", 3).otherwise(4)
    line = F.concat_ws("\t", F.lit(" 1.50"), (F.col("taxid") * 2).cast("string"), F.lit("1"), F.substring("rank", 1, 1), _S("taxid"), F.concat(F.repeat(F.lit("  "), level), F.col("name")))
    return H.clade_report(domain(spark, sf_dir, "tax_nodes").select(line.alias("value"))).select("taxid", "name", "depth", "clade_reads", "rank_code")


_MANIFEST = "m AS (SELECT o_orderkey AS line, CASE WHEN o_orderkey % 9 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN 'no' ELSE 'OG' || o_custkey END AS og_id, CASE WHEN o_orderkey % 8 = 0 THEN '2501' ELSE '250131' END AS seq_date, CASE WHEN o_orderkey % 2 = 0 THEN '/db/metazoa_odb12/' END AS busco_lineage FROM orders)"


@query(f"""WITH {_MANIFEST} SELECT line, og_id, seq_date, CASE WHEN busco_lineage IS NOT NULL THEN 'meta' END AS tag, CASE WHEN og_id = '' THEN 'og_id and seq_date are required' WHEN og_id = 'no' THEN 'invalid OG ID' WHEN seq_date = '2501' THEN 'seq_date must be six digits'
WHEN row_number() OVER (PARTITION BY og_id, seq_date ORDER BY line) > 1 THEN 'duplicate target' END AS error FROM m""")
def a24_manifest(spark, sf_dir):
    k = F.col("o_orderkey")
    t = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        k.alias("line"), F.when(k % 9 == 0, "").when(k % 7 == 0, "no").otherwise(F.concat(F.lit("OG"), _S("o_custkey"))).alias("og_id"), F.when(k % 8 == 0, "2501").otherwise("250131").alias("seq_date"), F.when(k % 2 == 0, "/db/metazoa_odb12/").alias("busco_lineage"),
    )
    return H.manifest(t)


def _parts(spark, sf_dir):
    t = domain(spark, sf_dir, "fits")
    one = lambda n, c: t.select("sample", F.when(F.col("sample") % n == n - 1, "other").otherwise("OG").alias("og_id"), F.col(c))
    return S.merge_records([one(1, "kmercov").withColumn("og_id", F.lit("OG")), one(4, "bias"), one(6, "fit_all")], "sample", ["og_id"])


@query(with_domain("fits", "SELECT sample, 'OG' AS og_id, kmercov, bias, fit_all FROM fits WHERE sample % 4 < 3 AND sample % 6 < 5"))
def e9_merge_records(spark, sf_dir):
    return _parts(spark, sf_dir)[0]


@query(with_domain("fits", "SELECT sample, 2 AS identities FROM fits WHERE sample % 4 = 3 OR sample % 6 = 5"))
def e9_mixed_identities(spark, sf_dir):
    return _parts(spark, sf_dir)[1]


_RESOLVED = """a AS (SELECT *, coalesce(match_level, '') AS lv, match_level IN ('species_exact', 'synonym_exact') AS ex, tax_rank IS NOT NULL AS has FROM matches),
b AS (SELECT *, lv <> '' AND NOT (lv IN ('family_fuzzy', 'order_fuzzy') AND has) AS tr FROM a),
c AS (SELECT *, CASE WHEN tr AND ex AND db_taxid IS NOT NULL THEN db_taxid WHEN tr THEN coalesce(tax_taxid, db_taxid) ELSE tax_taxid END AS taxid, CASE WHEN tr THEN coalesce(db_class, tax_class) ELSE tax_class END AS class,
  CASE WHEN tr THEN (db_class IS NULL AND tax_class IS NOT NULL) OR (NOT (ex AND db_taxid IS NOT NULL) AND tax_taxid IS NOT NULL) ELSE has END AS used FROM b),
resolved AS (SELECT og_id, nominal_species_id, match_level, taxid, class, CASE WHEN taxid IS NULL OR class IS NULL THEN 'unresolved' WHEN tr AND used THEN 'db+taxdump' WHEN tr THEN 'db' ELSE 'taxdump' END AS source, CASE WHEN used THEN tax_rank ELSE '' END AS rank_used FROM c)"""


@query(with_domain("matches", f"WITH {_RESOLVED} SELECT * FROM resolved"))
def i11_resolve(spark, sf_dir):
    return P.resolve(domain(spark, sf_dir, "matches"))


_PAIRS = "pairs AS (SELECT 'OG' || s_suppkey AS og_id, '/in/' || s_suppkey || '.R1.fq' AS r1, '/in/' || s_suppkey || '.R2.fq' AS r2 FROM supplier)"


@query(with_domain("matches", f"""WITH {_RESOLVED}, {_PAIRS} SELECT p.og_id AS sample, 'NOVA_250131_AD' AS run, '250131' AS date, p.og_id || '.ilmn.250131' AS prefix, coalesce(nominal_species_id, 'unknown') AS nom_species_id, coalesce(taxid::VARCHAR, 'unknown') AS taxon_id,
coalesce(class, 'unknown') AS class, r1 AS fastq_1, r2 AS fastq_2 FROM pairs p LEFT JOIN resolved r ON r.og_id = p.og_id"""))
def i12_build_sheet(spark, sf_dir):
    path = lambda m: F.concat(F.lit("/in/"), _S("s_suppkey"), F.lit(f".R{m}.fq")).alias(f"r{m}")
    pairs = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("OG"), _S("s_suppkey")).alias("og_id"), path(1), path(2))
    return P.build_sheet(pairs, P.resolve(domain(spark, sf_dir, "matches")), "NOVA_250131_AD")


@query(with_domain("files", """SELECT coalesce(l.sample, r.sample) AS sample, l.n AS local_files, l.b AS local_bytes, r.n AS remote_files, r.b AS remote_bytes, coalesce(l.n = r.n AND l.b = r.b, false) AS agrees
FROM (SELECT sample, count(*) AS n, sum(bytes)::BIGINT AS b FROM files WHERE side = 'local' AND sample <> 3 GROUP BY 1) l FULL JOIN (SELECT sample, count(*) AS n, sum(bytes)::BIGINT AS b FROM files WHERE side = 'remote' OR sample = 5 GROUP BY 1) r ON l.sample = r.sample"""))
def k14_raw_audit(spark, sf_dir):
    t = domain(spark, sf_dir, "files").withColumn("files", F.lit(1))
    return A.raw_audit(t.filter("side = 'local' and sample <> 3"), t.filter("side = 'remote' or sample = 5"), "sample")


@query(with_domain("jobs", """SELECT CASE split_part(process, ':', 2) WHEN 'TRIM' THEN 10 WHEN 'ASSEMBLE' THEN 80 ELSE 999 END AS position, split_part(process, ':', 2) AS tool, 'run <run> -t ' || cores % 4 || CASE WHEN tag LIKE 'OG%' THEN ' <sample>.fq' ELSE ' shared.fq' END AS params, '' AS notes, count(*) AS samples
FROM jobs GROUP BY ALL"""))
def k18_parameters(spark, sf_dir):
    params = F.concat(F.lit("run NOVA_1 -t "), (F.col("cores") % 4).cast("string"), F.lit(" "), F.col("tag"), F.lit(".fq"))
    rows = domain(spark, sf_dir, "jobs").select(F.substring_index("process", ":", -1).alias("tool"), params.alias("params"), F.lit(None).cast("string").alias("notes"))
    return P.collapse_parameters(rows, {"TRIM": 10, "ASSEMBLE": 80}, "NOVA_1")


_BATCH = """g AS (SELECT og_id, seq_date, CASE WHEN count(DISTINCT path) FILTER (component = 'fastp') = 1 THEN min(path) FILTER (component = 'fastp') END AS fastp, CASE WHEN count(DISTINCT path) FILTER (component = 'hist') = 1 THEN min(path) FILTER (component = 'hist') END AS hist,
min(path) FILTER (component = 'busco') AS busco FROM draft_files WHERE component <> 'fastp' OR og_id NOT LIKE '%7' GROUP BY ALL),
w AS (SELECT DISTINCT og_id, seq_date FROM draft_files), t AS (SELECT w.og_id, w.seq_date, fastp, hist, busco FROM w LEFT JOIN g ON g.og_id = w.og_id AND g.seq_date = w.seq_date)"""
_LACKING = "concat_ws(' ', CASE WHEN hist IS NULL THEN 'hist' END, CASE WHEN busco IS NULL THEN 'busco' END)"


def _batch(spark, sf_dir):
    t = domain(spark, sf_dir, "draft_files")
    wanted = t.select("og_id", "seq_date").distinct()
    status = wanted.withColumn("status", F.when(F.endswith("og_id", F.lit("4")), "few_regions").otherwise("ok"))
    return P.split_batch(wanted, t, ("busco",), ("hist",), status)


@query(with_domain("draft_files", f"WITH {_BATCH} SELECT og_id, seq_date, hist, busco FROM t WHERE {_LACKING} = '' AND og_id NOT LIKE '%4'"))
def k19_batch(spark, sf_dir):
    return _batch(spark, sf_dir)[0]


@query(with_domain("draft_files", f"WITH {_BATCH} SELECT og_id, seq_date, CASE WHEN {_LACKING} <> '' THEN 'missing or ambiguous: ' || {_LACKING} ELSE 'depth status is not ok' END AS reason FROM t WHERE {_LACKING} <> '' OR og_id LIKE '%4'"))
def k19_skipped(spark, sf_dir):
    return _batch(spark, sf_dir)[1]


@query(with_domain("draft_files", "SELECT og_id AS sample, string_agg(path, ';' ORDER BY path) || ';versions.yml;methods.yml' AS files FROM draft_files WHERE og_id NOT LIKE '%9' GROUP BY og_id"))
def k20_bundle(spark, sf_dir):
    t = domain(spark, sf_dir, "draft_files").withColumnRenamed("og_id", "sample")
    return P.bundle(t, t.filter("sample not like '%9'"), ["versions.yml", "methods.yml"]).withColumn("files", F.array_join("files", ";"))
