"""Queries on genome-size verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanefold.operators import verdict as V
from lanefold.plans.registry import query
from lanefold.sources.adapters import domain, with_domain


def flags_sql(assembly: str = "assembly_size") -> str:
    """The gate's ordered flags in DuckDB."""
    return f"""list_filter([
  CASE WHEN size_max IS NULL THEN CASE WHEN size_min IS NOT NULL THEN 'non_finite_genome_size' ELSE 'no_genome_size_estimate' END WHEN size_max <= 0 THEN 'no_genome_size_estimate' END,
  CASE WHEN fit_all > fit_full THEN 'inverted_model_fit_bounds' END, CASE WHEN fit_full < 50 THEN 'model_fit_below_50pc' END,
  CASE WHEN het_max IS NULL OR het_max <= 0 OR het_max > 100 THEN 'implausible_heterozygosity' WHEN het_min = 0 AND het_max > 0 THEN 'degenerate_model_fit' END,
  CASE WHEN bias > 5 THEN 'implausible_model_bias' END,
  CASE WHEN peak_cov IS NULL THEN 'no_kmer_peak' WHEN kmercov > 0 AND (peak_cov / kmercov > 3 OR peak_cov / kmercov < 0.5) THEN 'kmer_peak_disagrees_with_fitted_coverage' END,
  CASE WHEN size_max <> 0 AND {assembly} > 0 AND (size_max / {assembly} < 0.3 OR size_max / {assembly} > 2.0) THEN 'genome_size_disagrees_with_assembly' END], lambda x: x IS NOT NULL)"""


_GRADE = "CASE WHEN len(flags) > 0 THEN 'UNRELIABLE_GENOME_SIZE_ESTIMATE' WHEN coverage >= 50 THEN 'EXCELLENT' WHEN coverage >= 30 THEN 'GOOD' WHEN coverage >= 20 THEN 'ADEQUATE' WHEN coverage >= 10 THEN 'LOW' ELSE 'INSUFFICIENT' END"
_PROV = f"""gate0 AS (SELECT *, {flags_sql("NULL")} AS flags, greatest(coalesce(size_max, 0), 0)::BIGINT AS estimated_genome_size FROM fits),
cov AS (SELECT *, CASE WHEN estimated_genome_size = 0 THEN 0 ELSE bases_before / estimated_genome_size END AS coverage_before, CASE WHEN estimated_genome_size = 0 THEN 0 ELSE bases_after / estimated_genome_size END AS coverage,
  bases_after * 100.0::DOUBLE / bases_before AS retention_pct FROM gate0),
prov AS (SELECT *, {_GRADE} AS coverage_status, len(flags) = 0 AS reliable FROM cov)"""


_TOLD = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.RECOMMENDATIONS.items())


def _joined(t):
    return t.withColumn("flags", F.array_join("flags", "; "))


@query(with_domain("fits", f"SELECT sample, array_to_string({flags_sql()}, '; ') AS flags FROM fits"))
def h1_gate_flags(spark, sf_dir):
    return domain(spark, sf_dir, "fits").select("sample", F.array_join(V.gate_flags(), "; ").alias("flags"))


@query(with_domain("fits", f"""WITH {_PROV} SELECT sample, estimated_genome_size, coverage_before, coverage, retention_pct, (bases_before - bases_after) * 100.0::DOUBLE / bases_before AS removed_pct,
  CASE WHEN reliable THEN CASE coverage_status {_TOLD} END END AS recommendation FROM prov"""))
def h2_provisional(spark, sf_dir):
    return V.provisional(domain(spark, sf_dir, "fits")).select("sample", "estimated_genome_size", "coverage_before", "coverage", "retention_pct", "removed_pct", F.when(F.col("reliable"), F.col("recommendation")).alias("recommendation"))


@query(with_domain("fits", f"WITH {_PROV} SELECT sample, coverage_status, reliable FROM prov"))
def h3_grade(spark, sf_dir):
    return V.provisional(domain(spark, sf_dir, "fits")).select("sample", "coverage_status", "reliable")


@query(with_domain("fits", f"""WITH {_PROV} SELECT sample, CASE WHEN (NOT reliable OR coalesce(greatest(kmercov / lam, lam / kmercov) > 1.5, false)) AND lam >= 5 THEN greatest(round_even(lam, 0), 1)::BIGINT END AS seed FROM prov"""))
def h4_reseed_plan(spark, sf_dir):
    return V.reseed_plan(V.provisional(domain(spark, sf_dir, "fits"))).select("sample", "seed")


_REFIT = """refit AS (SELECT *, CASE WHEN sample % 23 = 0 THEN NULL ELSE fit_full + sample % 5 - 1 END AS new_fit_full, fit_all - sample % 12 AS new_fit_all, lam * 1.1 + sample % 3 AS new_kmercov,
  sample % 18 * 0.5::DOUBLE AS new_het_max, size_max AS new_size_max FROM fits),
chosen AS (SELECT *, CASE WHEN new_fit_full IS NULL OR fit_full IS NULL THEN 'no_usable_refit' WHEN coalesce(lam, 0) = 0 THEN 'no_lambda' WHEN new_kmercov IS NULL OR kmercov IS NULL THEN 'no_kmercov'
  WHEN new_fit_full - fit_full >= 2 AND abs(new_kmercov - lam) < abs(kmercov - lam) THEN 'better_and_closer' WHEN NOT abs(new_kmercov - lam) < abs(kmercov - lam) THEN 'no_closer'
  WHEN het_max IS NOT NULL AND coalesce(new_size_max, 0) <> 0 AND abs(new_kmercov - lam) / lam <= 0.15 AND het_max > 5 AND new_het_max <= 8 AND fit_all - new_fit_all <= 10 AND new_fit_full >= 50 THEN 'plausible_refit'
  ELSE 'gain_below_minimum' END AS reason FROM refit)"""


def _choice(spark, sf_dir):
    t = domain(spark, sf_dir, "fits")
    s = F.col("sample")
    t = t.withColumns({
        "new_fit_full": F.when(s % 23 != 0, F.col("fit_full") + s % 5 - 1), "new_fit_all": F.col("fit_all") - s % 12, "new_kmercov": F.col("lam") * 1.1 + s % 3,
        "new_het_max": s % 18 * 0.5, "new_size_max": F.col("size_max"),
    })
    return V.reseed_choice(t)


@query(with_domain("fits", f"WITH {_REFIT} SELECT sample, reason, CASE WHEN reason IN ('better_and_closer', 'plausible_refit') THEN 'reseeded' ELSE 'original' END AS winner FROM chosen"))
def h5_reseed_choice(spark, sf_dir):
    return _choice(spark, sf_dir).select("sample", "reason", "winner")


_PICK = ", ".join(f"CASE WHEN reason IN ('better_and_closer', 'plausible_refit') THEN new_{c} ELSE {c} END AS {c}" for c in ("size_max", "fit_all", "fit_full", "het_max", "kmercov"))


@query(with_domain("fits", f"WITH {_REFIT} SELECT sample, CASE WHEN reason IN ('better_and_closer', 'plausible_refit') THEN 'reseeded' ELSE 'original' END AS winner, {_PICK}, size_min, het_min, bias, peak_cov FROM chosen"))
def h6_chosen_fit(spark, sf_dir):
    return V.chosen_fit(_choice(spark, sf_dir))


_RECHECK = """ready AS (SELECT *, sample % 10 * 0.1::DOUBLE AS host_ratio, sample % 4 <> 0 AS depth_measured, CASE WHEN sample % 6 = 0 THEN 0 ELSE host_size - 1000 END AS host_haploid_size, CASE WHEN sample % 31 = 0 THEN NULL ELSE assembly_size END AS asm FROM prov),
based AS (SELECT *, coalesce(nullif(host_haploid_size, 0), nullif(host_size, 0)) AS host FROM ready),
denom AS (SELECT *, coalesce(partition_status = 'ok' AND host IS NOT NULL AND partition_confidence = 'high', false) AS use_host FROM based),
rated AS (SELECT *, CASE WHEN use_host THEN host ELSE asm END AS below FROM denom),
more AS (SELECT *, list_filter([
  CASE WHEN estimated_genome_size <= 1 AND NOT list_contains(flags, 'non_finite_genome_size') THEN 'no_genome_size_estimate' END,
  CASE WHEN estimated_genome_size > 1 AND (estimated_genome_size / below < 0.3 OR estimated_genome_size / below > 2.0) THEN 'genome_size_disagrees_with_assembly' END,
  CASE WHEN depth_measured AND greatest(kmercov / lam, lam / kmercov) > 1.5 THEN 'fitted_coverage_disagrees_with_read_depth' END,
  CASE WHEN depth_measured AND host_ratio < 0.4 THEN 'assembly_not_dominated_by_host' END,
  CASE WHEN depth_measured AND lam < 5 THEN 'host_coverage_too_low' END,
  CASE WHEN busco_complete < 10 THEN 'assembly_lacks_host_gene_space' END], lambda x: x IS NOT NULL) AS added FROM rated),
final AS (SELECT *, list_concat(flags, list_filter(added, lambda x: NOT list_contains(flags, x))) AS all_flags FROM more)"""


def _recheck(spark, sf_dir):
    s = F.col("sample")
    t = V.provisional(domain(spark, sf_dir, "fits")).drop("assembly_size").join(domain(spark, sf_dir, "fits").select("sample", "assembly_size"), "sample")
    return V.recheck(t.withColumns({
        "host_ratio": s % 10 * 0.1, "depth_measured": s % 4 != 0, "host_haploid_size": F.when(s % 6 == 0, F.lit(0)).otherwise(F.col("host_size") - 1000),
        "assembly_size": F.when(s % 31 != 0, F.col("assembly_size")),
    }))


@query(with_domain("fits", """WITH k AS (SELECT sample, lam, sample % 4 <> 0 AS measured, CASE sample % 3 WHEN 1 THEN 0 WHEN 2 THEN kmercov END AS own, CASE WHEN sample % 5 > 0 THEN kmercov + 1 END AS file FROM fits),
c AS (SELECT *, coalesce(nullif(own, 0), CASE WHEN measured THEN nullif(file, 0) END, own) AS kmercov FROM k)
SELECT sample, kmercov, coalesce(measured AND kmercov <> 0 AND greatest(kmercov / lam, lam / kmercov) > 1.5, false) AS fit_off FROM c"""))
def h8_measured_kmercov(spark, sf_dir):
    s, k = F.col("sample"), F.col("kmercov")
    t = V.provisional(domain(spark, sf_dir, "fits")).drop("assembly_size").join(domain(spark, sf_dir, "fits").select("sample", "assembly_size"), "sample")
    t = t.withColumns({"host_ratio": F.lit(1.0), "host_haploid_size": F.col("host_size"), "depth_measured": s % 4 != 0, "genomescope_kmercov": F.when(s % 5 > 0, k + 1), "kmercov": F.when(s % 3 == 1, 0.0).when(s % 3 == 2, k)})
    return V.recheck(t).select("sample", "kmercov", F.array_contains("flags", "fitted_coverage_disagrees_with_read_depth").alias("fit_off"))


@query(with_domain("fits", f"""WITH {_PROV}, {_RECHECK} SELECT sample, CASE WHEN estimated_genome_size <= 1 THEN 0 ELSE estimated_genome_size END AS estimated_genome_size, CASE WHEN estimated_genome_size <= 1 THEN 0 ELSE coverage END AS coverage,
  CASE WHEN len(all_flags) > 0 THEN 'UNRELIABLE_GENOME_SIZE_ESTIMATE' ELSE coverage_status END AS coverage_status, array_to_string(all_flags, '; ') AS flags, len(all_flags) = 0 AS reliable,
  CASE WHEN use_host THEN 'host' ELSE 'total' END AS assembly_ratio_basis, below AS assembly_ratio_denominator, CASE WHEN coalesce(asm, 0) <> 0 THEN 'done' ELSE 'no_assembly_size' END AS assembly_cross_check FROM final"""))
def h8_recheck(spark, sf_dir):
    return _joined(_recheck(spark, sf_dir)).select("sample", "estimated_genome_size", "coverage", "coverage_status", "flags", "reliable", "assembly_ratio_basis", "assembly_ratio_denominator", "assembly_cross_check")


def _one(value, close=""):
    """SQL of a number with one decimal and what follows it."""
    return f"coalesce(printf('%.1f', ({value})::DOUBLE) || '{close}', 'NA')"


def _four(value):
    return f"coalesce(printf('%.4f', ({value})::DOUBLE) || '%', 'NA')"


_LINES = f"""said AS (SELECT *, estimated_genome_size <= 1 AS none, CASE WHEN estimated_genome_size <= 1 THEN 0 ELSE coverage END AS cover FROM final),
lines AS (SELECT sample, list_filter(['SEQUENCING COVERAGE ANALYSIS', repeat('=', 50), '', 'Sample ID: ' || sample, 'Verdict: final (assembly cross-check done)', '', 'GENOME SIZE ESTIMATION (GenomeScope):',
  '  Estimated genome size: ' || CASE WHEN none THEN 'none' ELSE format('{{:,}}', estimated_genome_size) || ' bp' END,
  '  Genome size range: ' || format('{{:,}}', nullif(size_min, 0)) || ' - ' || format('{{:,}}', nullif(size_max, 0)) || ' bp',
  '  Estimated heterozygosity: ' || {_four("het_min")} || ' - ' || {_four("het_max")}, '  Model fit (full model): ' || {_four("fit_full")}, '  K-mers modelled (all k-mers): ' || {_four("fit_all")}, '',
  'SEQUENCING STATISTICS (FastP):', '  Reads after filtering: NA', '  Bases after filtering: ' || format('{{:,}}', bases_after) || ' bp', '  Data retention: ' || {_one("retention_pct")} || '%',
  '  Theoretical coverage before filtering: ' || {_one("CASE WHEN none THEN 0 ELSE coverage_before END")} || 'x', '  Theoretical coverage after filtering: ' || {_one("cover")} || 'x', '',
  'K-MER COVERAGE:', '  K-mer peak coverage: ' || coalesce(nullif(peak_cov, 0) || 'x', 'none detected'), '  Fitted k-mer coverage (GenomeScope kmercov): ' || {_one("nullif(kmercov, 0)", "x")},
  '  Measured k-mer coverage (BUSCO read depth): ' || {_one("nullif(lam, 0)", "x")}, '',
  'ASSEMBLY CROSS-CHECK:', '  Decontaminated assembly size: ' || coalesce(format('{{:,}}', asm), 'NA') || ' bp',
  '  Compared against: ' || CASE WHEN use_host THEN 'host' ELSE 'total' END || ' assembly (' || coalesce(format('{{:,}}', below), 'NA') || ' bp)', '  Host fraction of assembly (lower bound): NA', '  BUSCO complete: ' || {_one("busco_complete")} || '%', '',
  'COVERAGE ASSESSMENT:', '  Genome size estimate reliable: ' || CASE WHEN len(all_flags) = 0 THEN 'yes' ELSE 'no' END, CASE WHEN len(all_flags) > 0 THEN '  Genome size warnings: ' || array_to_string(all_flags, ', ') END,
  CASE WHEN len(all_flags) > 0 THEN '  Status: {V.UNRELIABLE} (theoretical coverage ' || {_one("cover")} || 'x, not trustworthy)' ELSE '  Status: ' || coverage_status || ' coverage (' || {_one("cover")} || 'x)' END,
  '  Recommendation: ' || CASE WHEN len(all_flags) > 0 THEN 'GenomeScope could not fit this sample (' || array_to_string(all_flags, ', ') || '), so the genome size estimate and every coverage figure derived from it are unreliable. Assess coverage against the decontaminated assembly size instead.' ELSE CASE coverage_status {_TOLD} END END], lambda x: x IS NOT NULL) AS l FROM said)"""


@query(with_domain("fits", f"WITH {_PROV}, {_RECHECK}, {_LINES} SELECT sample, generate_subscripts(l, 1) AS line_no, unnest(l) AS line FROM lines"))
def h10_report_lines(spark, sf_dir):
    return V.report_lines(_recheck(spark, sf_dir))


@query(with_domain("fits", f"WITH {_PROV}, {_RECHECK} SELECT f AS flag, count(*) AS samples FROM (SELECT unnest(all_flags) AS f FROM final) x GROUP BY f"))
def h9_flag_counts(spark, sf_dir):
    return _recheck(spark, sf_dir).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("samples"))


_APPLY = f"""swap AS (SELECT p.* REPLACE (CASE WHEN sample % 3 = 0 THEN CASE WHEN sample % 2 = 0 THEN NULL ELSE size_max + 1000000 END ELSE size_max END AS size_max, CASE WHEN sample % 3 = 0 THEN fit_full + 5 ELSE fit_full END AS fit_full,
  CASE WHEN sample % 3 = 0 THEN 1.0::DOUBLE ELSE bias END AS bias) FROM prov p),
swapped AS (SELECT *, {flags_sql("NULL")} AS f2, greatest(coalesce(size_max, 0), 0)::BIGINT AS s2 FROM swap),
refitted AS (SELECT sample, CASE WHEN sample % 3 = 0 THEN 'reseeded' ELSE 'original' END AS fit, s2 AS estimated_genome_size, round(CASE WHEN s2 = 0 THEN 0 ELSE bases_after / s2 END, 6) AS coverage,
  round(CASE WHEN s2 = 0 THEN 0 ELSE bases_before / s2 END, 6) AS coverage_before, array_to_string(f2, '; ') AS flags, len(f2) = 0 AS reliable FROM swapped)"""


@query(with_domain("fits", f"WITH {_PROV}, {_APPLY} SELECT * FROM refitted"))
def h7_apply_refit(spark, sf_dir):
    v, s = V.provisional(domain(spark, sf_dir, "fits")), F.col("sample")
    refits = v.filter(s % 3 == 0).withColumns({"size_max": F.when(s % 2 != 0, F.col("size_max") + 1000000), "fit_full": F.col("fit_full") + 5, "bias": F.lit(1.0)})
    t = _joined(V.apply_refit(v, refits)).withColumns({c: F.round(c, 6) for c in ("coverage", "coverage_before")})
    return t.select("sample", "fit", "estimated_genome_size", "coverage", "coverage_before", "flags", "reliable")


@query(with_domain("fits", f"""WITH {_PROV}, {_RECHECK}, shown AS (SELECT *, estimated_genome_size <= 1 AS none FROM final)
SELECT sample::VARCHAR AS sample, format('{{:,}}', CASE WHEN none THEN 0 ELSE estimated_genome_size END) AS estimated_genome_size, printf('%.2f', CASE WHEN none THEN 0 ELSE coverage_before END::DOUBLE) AS coverage_before,
  printf('%.2f', CASE WHEN none THEN 0 ELSE coverage END::DOUBLE) AS coverage, printf('%.2f', retention_pct) AS retention_pct, printf('%.2f', 100 - retention_pct) AS removed_pct, coalesce(printf('%.2f', het_max), 'NA') AS het_max,
  printf('%.2f', fit_full) AS fit_full, printf('%.2f', fit_all) AS fit_all, coalesce(printf('%.2f', peak_cov::DOUBLE), 'NA') AS peak_cov, CASE WHEN len(all_flags) = 0 THEN 'True' ELSE 'False' END AS reliable,
  CASE WHEN len(all_flags) > 0 THEN 'UNRELIABLE_GENOME_SIZE_ESTIMATE' ELSE coverage_status END AS coverage_status, CASE WHEN coalesce(asm, 0) <> 0 THEN 'done' ELSE 'no_assembly_size' END AS assembly_cross_check FROM shown"""))
def h9_coverage_table(spark, sf_dir):
    return V.coverage_table(_recheck(spark, sf_dir).withColumn("removed_pct", 100 - F.col("retention_pct")))


@query(with_domain("fits", f"""WITH {_PROV}, {_RECHECK} SELECT sample, CASE WHEN sample % 4 <> 0 AND len(all_flags) > 0 THEN 'UNRELIABLE_GENOME_SIZE_ESTIMATE' ELSE coverage_status END AS coverage_status FROM final"""))
def h13_final_or_provisional(spark, sf_dir):
    first, last = V.provisional(domain(spark, sf_dir, "fits")), _recheck(spark, sf_dir).filter("sample % 4 <> 0")
    return V.final_or_provisional(last, first.select("sample", "coverage_status"))
