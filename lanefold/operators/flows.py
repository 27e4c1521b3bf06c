"""The partial flows: from archived results to records, each a chain of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanefold.operators import contigs as C
from lanefold.operators import depth as D
from lanefold.operators import verdict as V
from lanefold.operators.store import partial_upsert


#: Columns that a depth-only upload writes, and the record's columns that they come from.
DEPTH_COLUMNS = {
    "lambda_depth": "lambda_depth", "busco_read_depth": "busco_mean_depth", "busco_regions": "busco_regions", "host_assembly_size": "host_assembly_size",
    "host_assembly_fraction": "host_assembly_fraction", "host_haploid_size": "host_haploid_size", "partition_confidence": "partition_confidence", "partition_note": "partition_note",
}


def with_sizes(sheet: DataFrame, contigs: DataFrame) -> DataFrame:
    """``sheet`` with null assembly sizes computed from the contigs of those samples only; samples without contigs keep null."""
    wanted = sheet.filter("assembly_size is null").select("sample").distinct()
    sums = contigs.join(wanted, "sample", "left_semi").groupBy("sample").agg(F.sum("length").alias("_size"))
    return sheet.join(sums, "sample", "left").withColumn("assembly_size", F.coalesce("assembly_size", "_size")).drop("_size")


def upload_depth(stored: DataFrame, record: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The store after a depth-only upload, and the rows refused because nothing is stored for their keys.

    Of known rows the eight columns of the depth are replaced, also by null; fits and verdicts stay. Keys are columns of both.
    """
    new = record.select(*keys, *[F.col(c).alias(n) for n, c in DEPTH_COLUMNS.items()])
    return partial_upsert(stored, new, keys, list(DEPTH_COLUMNS))


def depth_only(sheet: DataFrame, genes: DataFrame, contigs: DataFrame, alignments: DataFrame, least_regions: int = 20, **params) -> DataFrame:
    """The depth record of every sample of ``sheet`` (sample, read_length, total_bases, assembly_size, kmercov).

    Gene regions, their depth and lambda, contig depths and the partition; a sample with fewer than ``least_regions``
    regions keeps its row, with the reason as status and no measurement. A null assembly_size is filled with the sum of the
    sample's contigs.
    """
    sheet = with_sizes(sheet, contigs)
    regions = C.gene_regions(genes, contigs)
    state = C.region_status(regions, sheet, least_regions)
    enough = regions.join(state.filter("status = 'ok'").select("sample"), "sample", "left_semi")
    measured = D.weighted_depth(C.region_depth(alignments, enough)).select("sample", F.col("mean_depth").alias("busco_mean_depth"), F.col("regions").alias("busco_regions"))
    samples = sheet.join(state.select("sample", "status"), "sample", "left").join(measured, "sample", "left")
    return D.depth_record(samples, C.contig_depth(alignments, contigs), **params)


def genome_size_only(fits: DataFrame, refits: DataFrame, depth: DataFrame, stored: DataFrame | None = None, th: V.Thresholds = V.Thresholds()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verdicts from archived fits: (verdicts, refits to run, rows refused by the store).

    ``fits`` has a row a sample with its fit, bases, assembly_size and busco_complete; ``refits`` the new_ fields of refits that
    have been run; ``depth`` lam, host_ratio, host_haploid_size, host_size, partition_status, partition_confidence and
    depth_measured. The gate decides which samples to refit from the measured coverage, a refit counts where it wins, and
    the verdict is held against assembly and depth. With ``stored`` (keyed by sample) the verdicts go into known rows only.
    """
    first = V.provisional(fits.join(depth.select("sample", "lam"), "sample", "left"), th)
    plan = V.reseed_plan(first, th).filter("seed IS NOT NULL").select("sample", "seed")
    new = [c for c in refits.columns if c.startswith("new_")]
    choice = V.chosen_fit(V.reseed_choice(first.join(refits.select("sample", *new), "sample"), th)).filter("winner = 'reseeded'")
    sizes = fits.select("sample", "assembly_size")
    final = V.apply_refit(first, choice, th).drop("assembly_size", "lam").join(sizes, "sample").join(depth, "sample", "left")
    final = V.recheck(final.withColumn("depth_measured", F.coalesce("depth_measured", F.lit(False))), th)
    if stored is None:
        return final, plan, final.limit(0)
    supplied = [c for c in stored.columns if c != "sample" and c in final.columns]
    kept, refused = partial_upsert(stored, final, ["sample"], supplied)
    return kept, plan, refused
