"""Tool reports: one row a file (sample, text) in, typed columns out. What doesn't parse is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_number(c: Column) -> Column:
    """An integer with thousands separators, possibly with a unit behind; anything else, such as ``Inf``, is null."""
    digits = F.regexp_replace(F.regexp_extract(c, r"^\s*(-?[0-9,]+)(?:\s*bp)?\s*$", 1), ",", "")
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def percentage(c: Column) -> Column:
    """A finite number, possibly with a percent sign."""
    v = F.rtrim(F.regexp_replace(c, "%", "")).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def fit_summary(reports: DataFrame) -> DataFrame:
    """sample and the bounds of the rows of a fit summary; a bound that isn't finite is null and never takes the other's value."""
    row = lambda label, k: F.regexp_extract("text", rf"(?m)^{label}\s+(\S+(?: bp)?)\s{{2,}}(\S+(?: bp)?)\s*$", k)
    return reports.select(
        "sample", whole_number(row("Genome Haploid Length", 1)).alias("size_min"), whole_number(row("Genome Haploid Length", 2)).alias("size_max"),
        percentage(row(r"Heterozygous \(ab\)", 1)).alias("het_min"), percentage(row(r"Heterozygous \(ab\)", 2)).alias("het_max"),
        percentage(row("Model Fit", 1)).alias("fit_all"), percentage(row("Model Fit", 2)).alias("fit_full"),
    )


def _lines(reports: DataFrame) -> DataFrame:
    return reports.select("sample", F.posexplode(F.split("text", r"\r?\n")).alias("n", "line"))


def fit_model(reports: DataFrame, names: tuple[str, ...] = ("kmercov", "bias", "d", "r1")) -> DataFrame:
    """sample and the second token of the lines that start with each name, the last one if there are several."""
    t = _lines(reports).withColumn("w", F.split(F.trim("line"), r"\s+")).withColumn("v", F.get("w", F.lit(1)).try_cast("double"))
    last = [F.max(F.when((F.get("w", F.lit(0)) == x) & F.col("v").isNotNull(), F.struct("n", "v")))["v"].alias(x) for x in names]
    return t.groupBy("sample").agg(*last)


def histogram(reports: DataFrame, most: int = 1000) -> DataFrame:
    """sample, cov, cnt of the lines that start with two integers, coverage from 1 to ``most``."""
    t = _lines(reports).select("sample", F.split(F.trim("line"), r"\s+").alias("w"))
    t = t.select("sample", F.get("w", F.lit(0)).try_cast("bigint").alias("cov"), F.get("w", F.lit(1)).try_cast("bigint").alias("cnt"))
    return t.filter((F.col("cov") >= 1) & (F.col("cov") <= most) & F.col("cnt").isNotNull())


def filter_report(reports: DataFrame) -> DataFrame:
    """sample with count and bases of the EXCLUDE, TRIM and REVIEW lines, 0 where absent, null if there is no such line."""
    out, any_ = [], F.col("text").rlike(r"(?im)^\s*(EXCLUDE|TRIM|REVIEW)\s+\d+\s+\d+")
    for tag in ("EXCLUDE", "TRIM", "REVIEW"):
        for k, name in ((1, "contigs"), (2, "bp")):
            v = F.nullif(F.regexp_extract("text", rf"(?im)^\s*{tag}\s+(\d+)\s+(\d+)", k), F.lit("")).try_cast("bigint")
            out.append(F.when(any_, F.coalesce(v, F.lit(0))).alias(f"{tag.lower()}_{name}"))
    return reports.select("sample", *out)


def contig_depth(reports: DataFrame) -> DataFrame:
    """sample, contig, length, meandepth of a depth table; comment lines, short rows and empty contigs are left out."""
    t = _lines(reports).filter(~F.col("line").startswith("#")).select("sample", F.split("line", "\t").alias("w")).filter(F.size("w") >= 7)
    length = F.get("w", F.lit(2)).try_cast("bigint") - F.get("w", F.lit(1)).try_cast("bigint") + 1
    return t.select("sample", F.get("w", F.lit(0)).alias("contig"), length.alias("length"), F.get("w", F.lit(6)).try_cast("double").alias("meandepth")).filter("length > 0 and meandepth is not null")


def _named(label: str, pattern: str) -> Column:
    return F.nullif(F.regexp_extract("text", pattern, 1), F.lit("")).alias(label)


def completeness(reports: DataFrame) -> DataFrame:
    """sample and complete: the JSON's ``Complete percentage``, else the C figure of its one-line summary, else null."""
    direct = F.coalesce(*[F.get_json_object("text", f"$.{p}['Complete percentage']") for p in ("results", "metrics")])
    line = F.coalesce(*[F.get_json_object("text", f"$.{p}one_line_summary") for p in ("results.", "metrics.", "")])
    return reports.select("sample", F.coalesce(percentage(direct), percentage(F.nullif(F.regexp_extract(line, r"C:([0-9.]+)%", 1), F.lit("")))).alias("complete"))


#: Other names of the categories of a domain summary.
CATEGORY_ALIASES = {"mitochondria": "mitochondrion", "mito": "mitochondrion", "chloroplast": "plastid", "prokaryote": "prokarya", "bacteria": "prokarya", "bacterial": "prokarya"}
CATEGORIES = ("mitochondrion", "plastid", "prokarya")


def domain_report(rows: DataFrame) -> DataFrame:
    """sample with contigs and bases of three categories from (sample, category, num_contigs, bp), aliases added up, 0 where absent."""
    name = F.lower(F.trim("category"))
    known = F.coalesce(F.create_map(*[F.lit(x) for p in CATEGORY_ALIASES.items() for x in p])[name], name)
    t = rows.select("sample", known.alias("c"), whole_number(F.col("num_contigs").cast("string")).alias("n"), whole_number(F.col("bp").cast("string")).alias("bp"))
    total = lambda c, v: F.coalesce(F.sum(F.when(F.col("c") == c, F.col(v))), F.lit(0))
    return t.groupBy("sample").agg(*[total(c, v).alias(f"{p}_{c}") for c in CATEGORIES for v, p in (("n", "num_contigs"), ("bp", "bp"))])


def short_contigs(reports: DataFrame) -> DataFrame:
    """sample and num_contigs: the integer at the end of the first line that ends in one; null if none does."""
    return reports.select("sample", F.nullif(F.regexp_extract("text", r"(?m)(\d+)[ \t\r]*$", 1), F.lit("")).cast("long").alias("num_contigs"))


def quality_values(reports: DataFrame, metrics: tuple[str, ...] = ("unique_k_mers_assembly", "k_mers_total", "qv", "error")) -> DataFrame:
    """The one data row of a k-mer report: og_id, seq_date and the metrics as text; null throughout if there isn't exactly one.

    Rows have five columns (a dotted sample name first) or six (identifier and date first); a header is skipped.
    """
    lines = F.filter(F.split("text", r"\r?\n"), lambda x: (F.trim(x) != "") & ~F.lower(x).rlike(r"^(sample|og_id)\t"))
    w = F.when(F.size(lines) == 1, F.split(F.get(lines, F.lit(0)), "\t"))
    six, parts = F.size(w) == 6, F.split(F.get(w, F.lit(0)), r"\.")
    ok, at = F.size(w).isin(5, 6), lambda i: F.get(w, F.when(six, F.lit(i + 2)).otherwise(F.lit(i + 1)))
    head = [F.when(ok, F.get(parts, F.lit(0))).alias("og_id"), F.when(six, F.get(w, F.lit(1))).when(ok, F.get(parts, F.lit(2))).alias("seq_date")]
    return reports.select("sample", *head, *[F.when(ok, at(i)).alias(m) for i, m in enumerate(metrics)])


#: Fields of a contiguity report.
CONTIGUITY = {
    "num_scaffolds": r"#\s*scaffolds", "total_scaffold_length": r"total\s+scaffold\s+length", "scaffold_n50": r"scaffold\s+N50", "largest_scaffold": r"largest\s+scaffold",
    "num_contigs": r"#\s*contigs", "contig_n50": r"contig\s+N50",
}


def contiguity(reports: DataFrame) -> DataFrame:
    """sample and the seven fields of a contiguity report; a field without a line is null."""
    num = [_named(c, rf"(?im)^\s*{p}\s*:\s*(-?\d+(?:\.\d+)?)\s*$").try_cast("double").cast("long").alias(c) for c, p in CONTIGUITY.items()]
    return reports.select("sample", *num, _named("gc_pct", r"(?im)^\s*GC\s*content.*?:\s*([0-9]+(?:\.[0-9]+)?)").try_cast("double").alias("gc_pct"))


def sequence_total(reports: DataFrame) -> DataFrame:
    """sample and sum_len of a table of sequence statistics: the column of that name, else the fifth, of the first data row."""
    lines = F.split("text", r"\r?\n")
    head, row = F.split(F.get(lines, F.lit(0)), "\t"), F.split(F.get(lines, F.lit(1)), "\t")
    at = F.array_position(head, "sum_len").cast("int")
    value = F.when(at > 0, F.get(row, at - 1)).otherwise(F.get(row, F.lit(4)))
    return reports.select("sample", whole_number(value).alias("sum_len"))
