"""Records for the store from fit reports and JSON results: (name, text) in, one row a file with its identity and an error or null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanefold.sources.reports import percentage
from lanefold.sources.sheets import base_name, draft_identity

#: Labels of a fit summary by the columns of their first and second value.
FIT_ROWS = {
    "homozygous": ("homozygosity_min", "homozygosity"),
    "heterozygous": ("heterozygosity_min", "heterozygosity"),
    "genome haploid length": ("genomesize_min", "genomesize"),
    "genome repeat length": ("repeatsize_min", "repeatsize"),
    "genome unique length": ("uniquesize_min", "uniquesize"),
    "model fit": ("modelfit_allkmers", "modelfit"),
    "read error rate": (None, "errorrate"),
}
#: Names under which completeness results carry each column, in order of preference.
BUSCO_NAMES = {
    "complete": ("complete_percentage", "complete", "c"),
    "single_copy": ("single_copy_percentage", "single_percentage", "single_copy", "single"),
    "multi_copy": ("multi_copy_percentage", "duplicated_percentage", "multi_copy", "duplicated"),
    "fragmented": ("fragmented_percentage", "fragmented", "f"),
    "missing": ("missing_percentage", "missing", "m"),
    "n_markers": ("n_markers", "number_of_buscos", "total_buscos", "lineage_dataset_size"),
    "domain": ("domain", "lineage", "lineage_dataset", "lineage_name"),
    "number_of_scaffolds": ("number_of_scaffolds", "scaffolds"),
    "number_of_contigs": ("number_of_contigs", "contigs"),
    "total_length": ("total_length", "assembly_size", "genome_size_bp"),
    "percent_gaps": ("percent_gaps", "gap_percent", "n_percent"),
    "scaffold_n50": ("scaffold_n50", "n50_scaffold", "scaffold_n50_bp"),
    "contigs_n50": ("contigs_n50", "n50_contig", "contig_n50", "contig_n50_bp"),
    "internal_stop_codon_count": ("internal_stop_codon_count",),
    "internal_stop_codon_percent": ("internal_stop_codon_percent",),
}
# Names of fields in the tools' JSON.
_WHOLE_BUSCO = ("n_markers", "number_of_scaffolds", "number_of_contigs", "total_length", "contigs_n50", "internal_stop_codon_count")
_COUNTS = ("total_reads", "total_bases", "q20_bases", "q30_bases", "read1_mean_length", "read2_mean_length")
_RATES = ("q20_rate", "q30_rate", "gc_content")
_FILTERED = ("passed_filter_reads", "low_quality_reads", "too_many_N_reads", "too_short_reads", "too_long_reads")
_SECTION = "struct<" + ", ".join(f"{c}: double" for c in (*_COUNTS, *_RATES)) + ">"
_FASTP = f"struct<summary: struct<before_filtering: {_SECTION}, after_filtering: {_SECTION}>, filtering_result: struct<" + ", ".join(f"{c}: double" for c in _FILTERED) + ">>"


def _number(c: Column) -> Column:
    return percentage(F.regexp_replace(c, ",|bp", ""))


def _whole(c: Column) -> Column:
    """An integer, decimals cut off."""
    return _number(c).cast("bigint")


def fit_stats(reports: DataFrame) -> DataFrame:
    """og_id, seq_date, error and both values of every row of a fit summary (``text``).

    Rows are split at two blanks or more, the last two columns count, the last row of a label wins. Identity comes from
    the ``name prefix`` line if that names one, else from ``input file``. A size that isn't finite is null; both: error.
    """
    given = lambda label: F.trim(F.regexp_extract("text", rf"(?im)^{label}[^\n=]*=[ \t]*([^\r\n]+)$", 1))
    prefix, file = draft_identity(given("name prefix")), draft_identity(given("input file"))
    named = F.coalesce((prefix[0] != "") & (prefix[1] != ""), F.lit(False))
    rows = F.transform(F.split("text", r"\r?\n"), lambda line: F.split(F.trim(line), r"\s{2,}"))
    last = lambda label: F.try_element_at(F.filter(rows, lambda w: (F.size(w) >= 3) & F.startswith(F.lower(w[0]), F.lit(label))), F.lit(-1))
    out = []
    for label, (first, second) in FIT_ROWS.items():
        of = last(label)
        for k, name in ((-2, first), (-1, second)):
            if name:
                v = _number(F.try_element_at(of, F.lit(k)))
                out.append((F.bround(v).cast("bigint") if "size" in name else v).alias(name))
    t = reports.select(F.when(named, prefix[0]).otherwise(file[0]).alias("og_id"), F.when(named, prefix[1]).otherwise(file[1]).alias("seq_date"), *out)
    return t.withColumn("error", F.when(F.col("genomesize").isNull() & F.col("genomesize_min").isNull(), "no finite genome size"))


def fastp(reports: DataFrame) -> DataFrame:
    """og_id, seq_date, error and the 25 columns of a read-filter report; the third part of ``name`` is machine, date and initial.

    A key without a value counts as missing; optional counts are 0 then.
    """
    parts = F.split(base_name(F.col("name")), r"\.")
    run = F.split(F.get(parts, F.lit(2)), "_", 3)
    t = reports.select(F.get(parts, F.lit(0)).alias("og_id"), run.alias("_run"), F.from_json(F.replace("text", F.lit('"too_many_n_reads"'), F.lit('"too_many_N_reads"')), _FASTP).alias("j"))
    t = t.select("og_id", "_run", F.col("j.summary.before_filtering").alias("b"), F.col("j.summary.after_filtering").alias("a"), F.col("j.filtering_result").alias("f"))
    gaps = F.array_compact(F.array(*[F.when(F.col(f"{s}.{c}").isNull(), f"{label}.{c}") for s, label in (("b", "before_filtering"), ("a", "after_filtering")) for c in (*_COUNTS, *_RATES)], F.when(F.col("f.passed_filter_reads").isNull(), "passed_filter_reads")))
    good_run = F.coalesce((F.size("_run") == 3) & ~F.exists("_run", lambda x: x == ""), F.lit(False))
    error = F.when(~good_run, "third part of the name must be MACHINE_DATE_INITIAL").when(F.size(gaps) > 0, F.concat(F.lit("missing "), F.array_join(gaps, ", ")))
    counts = [F.coalesce(F.col(f"f.{c}").cast("bigint"), F.lit(0)).alias(c.lower()) for c in _FILTERED]
    both = [x for s, p in (("b", "raw_"), ("a", "")) for x in (*[F.col(f"{s}.{c}").cast("bigint").alias(p + c) for c in _COUNTS], *[F.col(f"{s}.{c}").alias(p + c) for c in _RATES])]
    return t.select("og_id", F.get("_run", F.lit(1)).alias("seq_date"), F.get("_run", F.lit(0)).alias("mach"), F.get("_run", F.lit(2)).alias("initial"), *counts, *both, error.alias("error"))


def fastp_wide(reports: DataFrame, raw: str = "raw.") -> DataFrame:
    """sample, run, what was filtered, the values before (prefixed) and after filtering; null where the report has none."""
    parts = F.split(base_name(F.col("name")), r"\.")
    t = reports.select(F.get(parts, F.lit(0)).alias("sample"), F.coalesce(F.get(parts, F.lit(2)), F.lit("")).alias("run"), F.from_json(F.replace("text", F.lit('"too_many_n_reads"'), F.lit('"too_many_N_reads"')), _FASTP).alias("j"))
    before = [F.col(f"j.summary.before_filtering.{c}").alias(raw + c) for c in (*_COUNTS, *_RATES)]
    return t.select("sample", "run", "j.filtering_result.*", *before, "j.summary.after_filtering.*")


def busco(reports: DataFrame) -> DataFrame:
    """og_id, seq_date, error and the completeness columns; ``results`` go before ``metrics``, keys are compared in lower case with ``_`` for other signs."""
    t = reports.select("name", F.from_json("text", "struct<metrics: map<string, string>, results: map<string, string>, parameters: map<string, string>>").alias("j"))
    none = F.array().cast("array<struct<key: string, value: string>>")
    entries = F.concat(F.coalesce(F.map_entries("j.metrics"), none), F.coalesce(F.map_entries("j.results"), none))
    t = t.withColumn("e", F.transform(entries, lambda x: F.struct(F.regexp_replace(F.lower(F.trim(x["key"])), "[^a-z0-9_]", "_").alias("k"), x["value"].alias("v"))))
    last = lambda k: F.try_element_at(F.filter("e", lambda x: x["k"] == k), F.lit(-1))["v"]
    out = []
    for c, names in BUSCO_NAMES.items():
        v = F.coalesce(*[last(k) for k in names])
        out.append((F.nullif(F.trim(v), F.lit("")) if c == "domain" else _whole(v) if c in _WHOLE_BUSCO else _number(v)).alias(c))
    p = lambda k: F.nullif(F.col("j.parameters")[k], F.lit(""))
    og, date = draft_identity(F.coalesce(p("in"), p("out"), F.col("name")))
    t = t.select(og.alias("og_id"), date.alias("seq_date"), *out)
    return t.withColumn("error", F.when(F.col("complete").isNull() | F.col("n_markers").isNull(), "complete and n_markers are required"))


_DEPTH = ("lambda_depth", "busco_mean_depth", "busco_regions", "host_assembly_size", "host_assembly_fraction", "host_haploid_size", "partition_confidence", "partition_note")


def _depth_columns(j: str) -> list[Column]:
    text = lambda c: F.nullif(F.col(f"{j}.{c}"), F.lit("")).alias(c)
    return [
        _number(F.col(f"{j}.lambda_depth")).alias("lambda_depth"), _number(F.col(f"{j}.busco_mean_depth")).alias("busco_read_depth"), _whole(F.col(f"{j}.busco_regions")).alias("busco_regions"),
        _whole(F.col(f"{j}.host_assembly_size")).alias("host_assembly_size"), _number(F.col(f"{j}.host_assembly_fraction")).alias("host_assembly_fraction"),
        _whole(F.col(f"{j}.host_haploid_size")).alias("host_haploid_size"), text("partition_confidence"), text("partition_note"),
    ]


def kmer_depth(reports: DataFrame) -> DataFrame:
    """og_id, seq_date and the depth columns of a depth result; a sample without a depth keeps its row of nulls."""
    og, date = draft_identity(F.col("name"))
    t = reports.select(og.alias("og_id"), date.alias("seq_date"), F.from_json("text", "struct<" + ", ".join(f"{c}: string" for c in _DEPTH) + ">").alias("j"))
    return t.select("og_id", "seq_date", *_depth_columns("j"))


def verdict(reports: DataFrame) -> DataFrame:
    """og_id, seq_date and the columns of a verdict. ``has_regions`` tells whether busco_regions is to be stored at all.

    The fitted coverage is taken from ``fitted_kmer_coverage`` where ``kmercov`` is absent or 0.
    """
    og, date = draft_identity(F.col("name"))
    fields = ("genome_size_reliable", "genome_size_flags", "kmercov", "fitted_kmer_coverage", "genomescope_fit", *_DEPTH)
    t = reports.select(og.alias("og_id"), date.alias("seq_date"), F.from_json("text", "struct<" + ", ".join(f"{c}: string" for c in fields) + ">").alias("j"), F.json_object_keys("text").alias("k"))
    return t.select(
        "og_id", "seq_date", F.col("j.genome_size_reliable").try_cast("boolean").alias("genome_size_reliable"), F.nullif(F.col("j.genome_size_flags"), F.lit("")).alias("genome_size_flags"),
        F.coalesce(F.nullif(_number(F.col("j.kmercov")), F.lit(0.0)), _number(F.col("j.fitted_kmer_coverage"))).alias("kmercov"), F.nullif(F.col("j.genomescope_fit"), F.lit("")).alias("genomescope_fit"),
        *_depth_columns("j"), F.coalesce(F.array_contains("k", "busco_regions"), F.lit(False)).alias("has_regions"),
    )
