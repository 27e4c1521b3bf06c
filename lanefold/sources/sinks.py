"""Where results go: sheets in a fixed column order, run tables, partitioned and sorted output."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The columns of the sheets, in their order.
SHEET = ("sample", "run", "date", "prefix", "nom_species_id", "taxon_id", "class", "fastq_1", "fastq_2")
RESOLUTION = ("sample", "nominal_species_id", "taxon_id", "class", "source", "match_level", "taxdump_rank")


def write_sheet(df: DataFrame, path: str, columns: tuple[str, ...] = SHEET, sep: str = ",") -> None:
    """A header and the given columns only, in their order; null is empty."""
    df.select(*columns).write.mode("overwrite").csv(path, header=True, sep=sep, emptyValue="")


def resolution_rows(resolved: DataFrame) -> DataFrame:
    """What ``samples.resolve`` gives, under the names of the resolution sheet."""
    named = {"og_id": "sample", "taxid": "taxon_id", "rank_used": "taxdump_rank"}
    return resolved.withColumnsRenamed(named).select(*RESOLUTION)


def run_table(tables: list[DataFrame], key: str = "sample_id") -> DataFrame:
    """Records of different shapes as one table: ``key`` first, the other columns by name.

    Rows are sorted by number if every key is an integer, else as text; columns that a record lacks are null.
    """
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    number = F.trim(F.col(key).cast("string")).try_cast("bigint")
    whole = every.agg(F.coalesce(F.every(number.isNotNull()), F.lit(True)).alias("x")).first()["x"]
    return every.select(key, *sorted(c for c in every.columns if c != key)).orderBy(number if whole else F.col(key).cast("string"))


def write_partitioned(df: DataFrame, path: str, by: str = "og_id", files: int | None = None) -> None:
    """Parquet by sample. ``files`` deals rows by sample and a hash of the row over that many tasks, so a large sample isn't one task."""
    if files:
        df = df.repartition(files, F.col(by), F.pmod(F.xxhash64(*df.columns), F.lit(8)))
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_sorted(df: DataFrame, path: str, *order: str) -> None:
    """Text files whose names follow the order of their rows: together they are one sorted file."""
    df.orderBy(*order).write.mode("overwrite").csv(path, sep="\t", header=False)


def write_audit(expected: DataFrame, mismatches: DataFrame, path: str, inventory: DataFrame | None = None, upload: DataFrame | None = None, summary: DataFrame | None = None) -> None:
    """The files of a backfill beside each other: expected as JSON lines; the mismatches of a verification, the inventory,
    the uploaded rows and the summary (one row) as tables with a header. What isn't given isn't written."""
    for name, df in (("inventory", inventory), ("upload", upload)):
        if df is not None:
            df.write.mode("overwrite").csv(f"{path}/{name}", sep="\t", header=True)
    if summary is not None:
        summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    expected.write.mode("overwrite").json(f"{path}/expected")
    mismatches.write.mode("overwrite").csv(f"{path}/verification", sep="\t", header=True)
