"""Sheets, manifests, inventories and dumps: rows of strings in, checked and typed rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What each column of a sample sheet must match.
SHEET_RULES = {
    "sample": r"^OG\d+[A-Za-z]?(-\d+)?(?:_HIC[A-Za-z]*\d*)?$",
    "run": r"^[A-Za-z0-9_\-\.]+$",
    "date": r"^\d+$",
    "prefix": r"^\S+$",
    "nom_species_id": r"(?s).*",
    "taxon_id": r"^(\d+|unknown|None)$",
    "class": r"(?s).*",
    "fastq_1": r"\.R1\.(fastq|fq)\.gz?$",
    "fastq_2": r"\.R2\.(fastq|fq)\.gz?$",
}
#: Columns that the sheets of the two partial flows must have.
DEPTH_COLUMNS = ("og_id", "seq_date", "assembly", "bam", "busco_full_table", "genomescope_model", "fastp_json")
SIZE_COLUMNS = ("og_id", "seq_date", "fastp_json", "genomescope_summary", "genomescope_model", "meryl_hist", "kmer_depth_json", "seqkit_stats", "busco_short_summary")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def draft_identity(name: Column) -> tuple[Column, Column]:
    """(og_id, seq_date) of a dotted name: its first part, and its third up to the first underscore; null where absent."""
    parts = F.split(base_name(name), r"\.")
    return F.get(parts, F.lit(0)), F.substring_index(F.get(parts, F.lit(2)), "_", 1)


def validate_samplesheet(sheet: DataFrame) -> DataFrame:
    """``sheet`` with ``errors``: the columns whose value is null or doesn't match, in sheet order.

    A sheet with other columns, or without one of them, is an error of the whole sheet.
    """
    if set(sheet.columns) != set(SHEET_RULES):
        raise ValueError(f"columns {sorted(set(sheet.columns) ^ set(SHEET_RULES))} are missing or unknown")
    bad = [F.when(~F.coalesce(F.col(c).cast("string").rlike(rule), F.lit(False)), c) for c, rule in SHEET_RULES.items()]
    return sheet.withColumn("errors", F.array_compact(F.array(*bad)))


def merge_rows(sheet: DataFrame) -> DataFrame:
    """sample and the reads of all its rows as one list, mates beside each other, rows by their first file."""
    pairs = F.array_sort(F.collect_list(F.struct("fastq_1", "fastq_2")))
    return sheet.groupBy("sample").agg(F.flatten(F.transform(pairs, lambda p: F.array(p["fastq_1"], p["fastq_2"]))).alias("reads"))


def presence_checked(sheet: DataFrame, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows that have all ``columns``, with prefix and assembly_prefix, and one error row for each value that is null or blank."""
    t = sheet.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) if c in columns else F.col(c) for c in sheet.columns])
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in columns]))
    who = F.concat(F.coalesce("og_id", F.lit("?")), F.lit("/"), F.coalesce("seq_date", F.lit("?")))
    errors = t.select(who.alias("_who"), F.explode(absent).alias("_c")).select(F.concat("_who", F.lit(" has no "), "_c").alias("error"))
    whole = t.filter(F.size(absent) == 0).withColumn("prefix", F.concat("og_id", F.lit(".ilmn."), "seq_date"))
    if "assembly" in columns:
        whole = whole.withColumn("assembly_prefix", F.regexp_replace(base_name(F.col("assembly")), r"\.(fna|fa|fasta)(\.gz)?$", ""))
    return whole, errors


def artifact_inventory(files: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """sample_id, component and path of every file whose path matches the pattern of a component.

    The identifier is the first three dotted parts of the name; a ``NOVA_`` token with a six-digit date replaces the
    third. A file of several components gives a row for each, one of none none.
    """
    name = base_name(F.col("path"))
    parts = F.split(name, r"\.")
    nova = F.regexp_extract(name, r"NOVA_(\d{6})_", 1)
    first = F.array_join(F.slice(parts, 1, 3), ".")
    sample = F.when(nova != "", F.concat_ws(".", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), nova)).otherwise(first)
    hit = F.array_compact(F.array(*[F.when(F.col("path").rlike(p), c) for c, p in patterns.items()]))
    return files.filter("path is not null").select(sample.alias("sample_id"), F.explode(hit).alias("component"), "path")


def manifest(rows: DataFrame) -> DataFrame:
    """line, og_id, seq_date, tag (four letters of the lineage, or null) and error (null where the row is good).

    Of rows with one identity all but the first by ``line`` are duplicates.
    """
    t = rows.select("line", *[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in ("og_id", "seq_date", "busco_lineage")])
    nth = F.row_number().over(Window.partitionBy("og_id", "seq_date").orderBy("line"))
    error = (
        F.when((F.col("og_id") == "") | (F.col("seq_date") == ""), "og_id and seq_date are required").when(~F.col("og_id").rlike(SHEET_RULES["sample"]), "invalid OG ID")
        .when(~F.col("seq_date").rlike(r"^\d{6}$"), "seq_date must be six digits").when(nth > 1, "duplicate target")
    )
    last = F.element_at(F.split(F.regexp_replace("busco_lineage", "/+$", ""), "/"), -1)
    return t.select("line", "og_id", "seq_date", F.nullif(F.substring(last, 1, 4), F.lit("")).alias("tag"), error.alias("error"))


def _dump(lines: DataFrame) -> Column:
    return F.split(F.regexp_replace("value", r"\t\|\s*$", ""), r"\t\|\t")


def tax_nodes(lines: DataFrame) -> DataFrame:
    """taxid, parent and rank of the lines (``value``) of a node dump; lines without two numbers are left out."""
    t = lines.select(_dump(lines).alias("p"))
    num = lambda k: F.trim(F.get("p", F.lit(k))).try_cast("bigint")
    return t.select(num(0).alias("taxid"), num(1).alias("parent"), F.trim(F.get("p", F.lit(2))).alias("rank")).filter("taxid is not null and parent is not null")


def tax_names(lines: DataFrame) -> DataFrame:
    """taxid and scientific name of the lines of a name dump; names of other classes are left out."""
    t = lines.select(_dump(lines).alias("p")).filter(F.trim(F.get("p", F.lit(3))) == "scientific name")
    return t.select(F.trim(F.get("p", F.lit(0))).try_cast("bigint").alias("taxid"), F.get("p", F.lit(1)).alias("name")).filter("taxid is not null")


def clade_report(lines: DataFrame) -> DataFrame:
    """Of the lines of a six-column tree report: percent, clade_reads, direct_reads, rank_code, taxid, name and depth (two blanks a level)."""
    p = F.split("value", "\t")
    g = lambda k: F.get(p, F.lit(k))
    blanks = F.length(g(5)) - F.length(F.ltrim(g(5)))
    return lines.filter(F.size(p) >= 6).select(
        F.trim(g(0)).try_cast("double").alias("percent"), F.trim(g(1)).try_cast("bigint").alias("clade_reads"), F.trim(g(2)).try_cast("bigint").alias("direct_reads"),
        F.trim(g(3)).alias("rank_code"), F.trim(g(4)).try_cast("bigint").alias("taxid"), F.trim(g(5)).alias("name"), F.floor(blanks / 2).cast("bigint").alias("depth"),
    ).filter("taxid is not null")


def read_assignments(lines: DataFrame) -> DataFrame:
    """Of the lines of a classifier's five-column output: classified, read_id, taxid and the lengths of both mates.

    The taxon is a number or ``name (taxid number)``; a length without ``|`` is that of a single read, so length2 is
    null. Lines without five columns or without a taxid are left out; columns of ``lines`` but ``value`` stay.
    """
    p = F.split("value", "\t")
    g = lambda k: F.trim(F.get(p, F.lit(k)))
    number = F.coalesce(F.nullif(F.regexp_extract(g(2), r"\(taxid (\d+)\)$", 1), F.lit("")), g(2)).try_cast("bigint")
    sizes = F.split(g(3), r"\|")
    size = lambda k: F.get(sizes, F.lit(k)).try_cast("bigint").alias(f"length{k + 1}")
    rest = [c for c in lines.columns if c != "value"]
    t = lines.filter(F.size(p) >= 5).select(*rest, (g(0) == "C").alias("classified"), g(1).alias("read_id"), number.alias("taxid"), size(0), size(1))
    return t.filter("taxid IS NOT NULL")
