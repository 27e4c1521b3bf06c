"""Whether a genome-size estimate can be trusted: flags, grades, refits and rechecks, as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    """Defaults of every rule; fixed values that results depend on."""

    min_model_fit: float = 50.0
    max_bias: float = 5.0
    min_peak_ratio: float = 0.5
    max_peak_ratio: float = 3.0
    min_assembly_ratio: float = 0.3
    max_assembly_ratio: float = 2.0
    max_lambda_ratio: float = 1.5
    min_host_depth_ratio: float = 0.4
    min_seedable_lambda: float = 5.0
    min_fit_gain: float = 2.0
    max_lambda_offset: float = 0.15
    max_allkmers_loss: float = 10.0
    min_original_het: float = 5.0
    max_refit_het: float = 8.0
    min_busco: float = 10.0


#: What each grade of coverage recommends.
RECOMMENDATIONS = {
    "EXCELLENT": "Suitable for high-quality genome assembly and variant calling.",
    "GOOD": "Suitable for genome assembly and most downstream analyses.",
    "ADEQUATE": "Suitable for basic genome assembly.",
    "LOW": "Draft assembly may be possible, but additional sequencing may help.",
    "INSUFFICIENT": "Additional sequencing is strongly recommended.",
}
#: Fixed text: the recommendation where an estimate isn't reliable, before and after the names of the reasons.
UNFITTED = (
    "GenomeScope could not fit this sample (",
    "), so the genome size estimate and every coverage figure derived from it are unreliable. Assess coverage against the decontaminated assembly size instead.",
)
#: Status of such a sample; least coverage of each grade.
UNRELIABLE = "UNRELIABLE_GENOME_SIZE_ESTIMATE"
GRADES = ((50, "EXCELLENT"), (30, "GOOD"), (20, "ADEQUATE"), (10, "LOW"))


def _flag(cond: Column, name: str) -> Column:
    return F.when(cond, F.lit(name))


def gate_flags(th: Thresholds = Thresholds(), with_hist: bool = True) -> Column:
    """Ordered flags from size_min, size_max, fit_all, fit_full, het_min, het_max, bias, kmercov, peak_cov and assembly_size."""
    c = F.col
    peak = F.try_divide(c("peak_cov"), c("kmercov"))
    size_ratio = F.try_divide(c("size_max").cast("double"), c("assembly_size"))
    flags = [
        F.when(c("size_max").isNull(), F.when(c("size_min").isNotNull(), "non_finite_genome_size").otherwise("no_genome_size_estimate")).when(c("size_max") <= 0, "no_genome_size_estimate"),
        _flag(c("fit_all") > c("fit_full"), "inverted_model_fit_bounds"),
        _flag(c("fit_full") < th.min_model_fit, f"model_fit_below_{th.min_model_fit:g}pc"),
        F.when(c("het_max").isNull() | (c("het_max") <= 0) | (c("het_max") > 100), "implausible_heterozygosity").when((c("het_min") == 0) & (c("het_max") > 0), "degenerate_model_fit"),
        _flag(c("bias") > th.max_bias, "implausible_model_bias"),
        F.when(c("peak_cov").isNull(), "no_kmer_peak").when((c("kmercov") > 0) & ((peak > th.max_peak_ratio) | (peak < th.min_peak_ratio)), "kmer_peak_disagrees_with_fitted_coverage") if with_hist else F.lit(None),
        _flag((c("size_max") != 0) & (c("assembly_size") > 0) & ((size_ratio < th.min_assembly_ratio) | (size_ratio > th.max_assembly_ratio)), "genome_size_disagrees_with_assembly"),
    ]
    return F.array_compact(F.array(*[f.cast("string") for f in flags]))


def grade(coverage: Column, flags: Column) -> Column:
    out = F.when(F.size(flags) > 0, UNRELIABLE)
    for least, name in GRADES:
        out = out.when(coverage >= least, name)
    return out.otherwise("INSUFFICIENT")


def provisional(fits: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """The verdict before an assembly is known: size, coverage before and after filtering, retention, flags, grade."""
    t = fits.withColumn("assembly_size", F.lit(None).cast("long")).withColumn("flags", gate_flags(th))
    size = F.greatest(F.coalesce("size_max", F.lit(0)), F.lit(0)).cast("double")
    cover = lambda bases: F.coalesce(F.try_divide(F.col(bases), size), F.lit(0.0))
    t = t.withColumns({"estimated_genome_size": size.cast("long"), "coverage_before": cover("bases_before"), "coverage": cover("bases_after")})
    kept = F.coalesce(F.try_divide(F.col("bases_after") * 100.0, F.col("bases_before")), F.lit(0.0))
    removed = F.coalesce(F.try_divide((F.col("bases_before") - F.col("bases_after")) * 100.0, F.col("bases_before")), F.lit(0.0))
    t = t.withColumns({"retention_pct": kept, "removed_pct": removed, "reliable": F.size("flags") == 0, "coverage_status": grade(F.col("coverage"), F.col("flags"))})
    told = F.create_map(*[F.lit(x) for pair in RECOMMENDATIONS.items() for x in pair])[F.col("coverage_status")]
    return t.withColumn("recommendation", F.when(F.size("flags") > 0, _doubtful("flags")).otherwise(told))


def _doubtful(flags: str) -> Column:
    before, after = UNFITTED
    return F.concat(F.lit(before), F.array_join(flags, ", "), F.lit(after))


def chosen_fit(choices: DataFrame) -> DataFrame:
    """sample, winner and every field of the fit that won (``new_`` of a refit): always one row; fields no refit has stay the original's."""
    won = F.col("winner") == "reseeded"
    fields = [F.when(won, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if f"new_{c}" in choices.columns else F.col(c) for c in FIT_FIELDS if c in choices.columns]
    return choices.select("sample", "winner", *fields)


def reseed_plan(verdicts: DataFrame, th: Thresholds = Thresholds(), enabled: bool = True) -> DataFrame:
    """``seed`` for the refit from reliable, lam (the measured coverage) and kmercov; null: skip. The seed rounds half to even and is 1 at least."""
    r = F.try_divide(F.col("kmercov"), F.nullif("lam", F.lit(0.0)))
    off = F.coalesce(F.greatest(r, F.try_divide(F.lit(1.0), r)) > th.max_lambda_ratio, F.lit(False))
    wanted = F.lit(enabled) & (~F.col("reliable") | off) & (F.col("lam") >= th.min_seedable_lambda)
    return verdicts.withColumn("seed", F.when(wanted, F.greatest(F.rint("lam"), F.lit(1.0)).cast("long")))


def reseed_choice(fits: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """``winner`` and ``reason`` from the original fit (fit_full, fit_all, kmercov, het_max), the refit (new_*) and lam."""
    c = F.col
    gain, lam = c("new_fit_full") - c("fit_full"), c("lam")
    closer = F.abs(c("new_kmercov") - lam) < F.abs(c("kmercov") - lam)
    all_there = c("het_max").isNotNull() & c("new_het_max").isNotNull() & c("fit_all").isNotNull() & c("new_fit_all").isNotNull() & (F.coalesce("new_size_max", F.lit(0)) != 0)
    second = (
        all_there & (F.abs(c("new_kmercov") - lam) / lam <= th.max_lambda_offset) & (c("het_max") > th.min_original_het) & (c("new_het_max") <= th.max_refit_het)
        & (c("fit_all") - c("new_fit_all") <= th.max_allkmers_loss) & (c("new_fit_full") >= th.min_model_fit)
    )
    reason = (
        F.when(c("new_fit_full").isNull() | c("fit_full").isNull(), "no_usable_refit")
        .when(F.coalesce(lam, F.lit(0.0)) == 0, "no_lambda")
        .when(c("new_kmercov").isNull() | c("kmercov").isNull(), "no_kmercov")
        .when((gain >= th.min_fit_gain) & closer, "better_and_closer")
        .when(~closer, "no_closer")
        .when(second, "plausible_refit")
        .otherwise("gain_below_minimum")
    )
    return fits.withColumn("reason", reason).withColumn("winner", F.when(F.col("reason").isin("better_and_closer", "plausible_refit"), "reseeded").otherwise("original"))


def recheck(verdicts: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """The verdict against assembly and read depth; doing it twice changes nothing.

    Needs flags, estimated_genome_size, coverage, coverage_before, coverage_status, kmercov, lam, host_ratio, host_haploid_size,
    host_size, partition_status, partition_confidence, assembly_size, busco_complete and depth_measured. Where kmercov is null or 0
    and the depth was measured, ``genomescope_kmercov`` of the measurement (if the column is there) stands in for it.
    """
    c = F.col
    size = F.coalesce("estimated_genome_size", F.lit(0)).cast("long")
    none = size <= 1
    host = F.coalesce(F.nullif("host_haploid_size", F.lit(0)), F.nullif("host_size", F.lit(0)))
    use_host = F.coalesce((c("partition_status") == "ok") & host.isNotNull() & (F.coalesce("partition_confidence", F.lit("high")) == "high"), F.lit(False))
    below = F.when(use_host, host).otherwise(c("assembly_size"))
    ratio = F.try_divide(size.cast("double"), F.nullif(below, F.lit(0)))
    k, lam = F.nullif("kmercov", F.lit(0.0)), F.nullif("lam", F.lit(0.0))
    if "genomescope_kmercov" in verdicts.columns:
        k = F.coalesce(k, F.when(c("depth_measured"), F.nullif("genomescope_kmercov", F.lit(0.0))))
    fit_off = F.greatest(F.try_divide(k, lam), F.try_divide(lam, k))
    more = [
        _flag(none & ~F.array_contains("flags", "non_finite_genome_size"), "no_genome_size_estimate"),
        _flag(~none & ((ratio < th.min_assembly_ratio) | (ratio > th.max_assembly_ratio)), "genome_size_disagrees_with_assembly"),
        _flag(c("depth_measured") & (fit_off > th.max_lambda_ratio), "fitted_coverage_disagrees_with_read_depth"),
        _flag(c("depth_measured") & (c("host_ratio") < th.min_host_depth_ratio), "assembly_not_dominated_by_host"),
        _flag(c("depth_measured") & (c("lam") < th.min_seedable_lambda), "host_coverage_too_low"),
        _flag(c("busco_complete") < th.min_busco, "assembly_lacks_host_gene_space"),
    ]
    flags = F.array_distinct(F.concat(F.coalesce("flags", F.array().cast("array<string>")), F.array_compact(F.array(*more))))
    t = verdicts.withColumns({"_flags": flags, "assembly_ratio_basis": F.when(use_host, "host").otherwise("total"), "assembly_ratio_denominator": below, "_none": none, "kmercov": F.coalesce(k, c("kmercov"))})
    told = {"recommendation": F.when(F.size("_flags") > 0, _doubtful("_flags")).otherwise(c("recommendation"))} if "recommendation" in verdicts.columns else {}
    return t.withColumns(told | {
        "flags": c("_flags"), "reliable": F.size("_flags") == 0, "estimated_genome_size": F.when(c("_none"), F.lit(0)).otherwise(size),
        "coverage": F.when(c("_none"), F.lit(0.0)).otherwise(c("coverage")), "coverage_before": F.when(c("_none"), F.lit(0.0)).otherwise(c("coverage_before")),
        "coverage_status": F.when(F.size("_flags") > 0, UNRELIABLE).otherwise(c("coverage_status")),
        "assembly_cross_check": F.when(F.coalesce("assembly_size", F.lit(0)) != 0, "done").otherwise("no_assembly_size"),
    }).drop("_flags", "_none")


def report_lines(summary: DataFrame) -> DataFrame:
    """sample, line_no (from 1) and line: the verdict of each sample as text, provisional or rechecked.

    A column that ``summary`` lacks counts as null. Null numbers are ``NA``; sizes, peaks and coverages of 0 count as
    not measured. A verdict is final once assembly_cross_check is there and isn't ``pending``; only then do the lines
    on the assembly follow. One decimal is rounded half to even.
    """
    col = lambda n, kind: (F.col(n) if n in summary.columns else F.lit(None)).cast(kind)
    shown = lambda v, fmt, no="NA": F.coalesce(F.when(v.isNotNull(), F.format_string(fmt, v)), F.lit(no))
    whole = lambda n: shown(col(n, "long"), "%,d")
    one = lambda v, fmt="%.1f", no="NA": shown(F.bround(v, 1), fmt, no)
    real = lambda n: col(n, "double")
    some = lambda n, kind="double": F.nullif(col(n, kind), F.lit(0).cast(kind))
    flags = F.coalesce(F.col("flags"), F.array().cast("array<string>"))
    cross = col("assembly_cross_check", "string")
    final = F.coalesce(cross != "pending", F.lit(False))
    size, low, high, cover = some("estimated_genome_size", "long"), some("size_min", "long"), some("size_max", "long"), one(F.coalesce(real("coverage"), F.lit(0.0)))
    status = F.coalesce(col("coverage_status", "string"), F.lit("NA"))
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    fit = col("fit", "string")
    # Titles and wording of the lines, in their order.
    lines = [
        "SEQUENCING COVERAGE ANALYSIS", "=" * 50, "",
        say("Sample ID: ", F.coalesce(F.col("sample").cast("string"), F.lit("NA"))),
        say("Verdict: ", F.when(final, "final (assembly cross-check done)").otherwise("PROVISIONAL (assembly cross-check not run yet)")), "",
        "GENOME SIZE ESTIMATION (GenomeScope):",
        F.when(fit == "reseeded", "  Fit: reseeded (refit seeded with the measured k-mer coverage, kept over the original)").when(fit == "original", "  Fit: original"),
        say("  Estimated genome size: ", shown(size, "%,d bp", "none")),
        F.when(low.isNotNull() & high.isNotNull(), F.format_string("  Genome size range: %,d - %,d bp", low, high)),
        say("  Estimated heterozygosity: ", shown(real("het_min"), "%.4f%%"), " - ", shown(real("het_max"), "%.4f%%")),
        say("  Model fit (full model): ", shown(real("fit_full"), "%.4f%%")),
        say("  K-mers modelled (all k-mers): ", shown(real("fit_all"), "%.4f%%")), "",
        "SEQUENCING STATISTICS (FastP):",
        say("  Reads after filtering: ", whole("reads_after")),
        say("  Bases after filtering: ", whole("bases_after"), " bp"),
        say("  Data retention: ", one(real("retention_pct")), "%"),
        say("  Theoretical coverage before filtering: ", one(real("coverage_before")), "x"),
        say("  Theoretical coverage after filtering: ", cover, "x"), "",
        "K-MER COVERAGE:",
        say("  K-mer peak coverage: ", shown(some("peak_cov", "long"), "%dx", "none detected")),
        say("  Fitted k-mer coverage (GenomeScope kmercov): ", one(some("kmercov"), "%.1fx")),
        F.when(final, say("  Measured k-mer coverage (BUSCO read depth): ", one(some("lam"), "%.1fx"))), "",
        *[F.when(final, F.lit(x) if isinstance(x, str) else x) for x in (
            "ASSEMBLY CROSS-CHECK:",
            say("  Decontaminated assembly size: ", whole("assembly_size"), " bp"),
            say("  Compared against: ", F.coalesce(col("assembly_ratio_basis", "string"), F.lit("NA")), " assembly (", whole("assembly_ratio_denominator"), " bp)"),
            say("  Host fraction of assembly (lower bound): ", one(real("host_fraction") * 100, "%.1f%%")),
            say("  BUSCO complete: ", one(real("busco_complete")), "%"), "",
        )],
        "COVERAGE ASSESSMENT:",
        say("  Genome size estimate reliable: ", F.when(F.coalesce(col("reliable", "boolean"), F.lit(False)), "yes").otherwise("no")),
        F.when(F.size(flags) > 0, say("  Genome size warnings: ", F.array_join(flags, ", "))),
        F.when(status == UNRELIABLE, say("  Status: ", status, " (theoretical coverage ", cover, "x, not trustworthy)")).otherwise(say("  Status: ", status, " coverage (", cover, "x)")),
        say("  Recommendation: ", F.coalesce(F.nullif(col("recommendation", "string"), F.lit("")), F.lit("NA"))),
    ]
    every = F.array_compact(F.array(*[F.lit(x) if isinstance(x, str) else x for x in lines]))
    return summary.select("sample", F.posexplode(every).alias("_n", "line")).select("sample", (F.col("_n") + 1).alias("line_no"), "line")


FIT_FIELDS = ("size_min", "size_max", "fit_all", "fit_full", "het_min", "het_max", "bias", "kmercov", "peak_cov")


def apply_refit(verdicts: DataFrame, refits: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """Verdicts with the fit, size, coverage, flags and grade of the refit that won; samples without one stay as they are.

    ``refits`` has sample and the fields of a fit. Coverage before filtering is worked out from the bases after it and
    the retention; a winning refit passes the same gate as any fit, so it isn't reliable by itself.
    """
    c = F.col
    old = verdicts.withColumn("fit", F.lit("original"))
    new = verdicts.drop(*FIT_FIELDS).join(refits.select("sample", *FIT_FIELDS), "sample").withColumn("assembly_size", F.lit(None).cast("long"))
    size = F.greatest(F.coalesce("size_max", F.lit(0)), F.lit(0)).cast("double")
    after = F.coalesce(F.try_divide(c("bases_after"), size), F.lit(0.0))
    before = F.coalesce(F.try_divide(F.try_divide(c("bases_after"), c("retention_pct") / 100), size), F.lit(0.0))
    new = new.withColumns({"flags": gate_flags(th), "estimated_genome_size": size.cast("long"), "coverage": after, "coverage_before": before, "fit": F.lit("reseeded")})
    new = new.withColumns({"reliable": F.size("flags") == 0, "coverage_status": grade(c("coverage"), c("flags"))})
    return old.join(refits.select("sample"), "sample", "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


#: Columns of the run's coverage table and what they show.
TABLE = {
    "sample": "Sample", "estimated_genome_size": "Genome Size (bp)", "coverage_before": "Coverage Before (x)", "coverage": "Coverage After (x)",
    "retention_pct": "Data Retention (%)", "removed_pct": "Bases Removed (%)", "het_max": "Het. Max (%)", "fit_full": "Model Fit, Full Model (%)",
    "fit_all": "K-mers Modelled, All (%)", "peak_cov": "K-mer Peak (x)", "reliable": "Size Est. OK", "coverage_status": "Status", "assembly_cross_check": "Assembly Cross-check",
}


def coverage_table(verdicts: DataFrame) -> DataFrame:
    """The 13 display columns as text: sizes with thousands separators, measures with two decimals, ``NA`` for nothing."""
    plain = ("sample", "reliable", "coverage_status", "assembly_cross_check")

    def shown(c: str):
        if c in plain:
            return F.initcap(F.col(c).cast("string")) if c == "reliable" else F.col(c).cast("string")
        return F.format_number(c, 0) if c == "estimated_genome_size" else F.regexp_replace(F.format_number(F.col(c).cast("double"), 2), ",", "")

    na = lambda c: F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), "NA").otherwise(shown(c))
    return verdicts.select(*[na(c).alias(c) for c in TABLE])


def final_or_provisional(final: DataFrame, provisional_: DataFrame) -> DataFrame:
    """The final verdict of each sample, else its provisional one."""
    cols = provisional_.columns
    rest = provisional_.join(final.select("sample"), "sample", "left_anti")
    return final.select(*cols).unionByName(rest.select(*cols))
