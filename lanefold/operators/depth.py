"""Genome size from read depth: lambda, the depth partition, its mode and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weighted_depth(regions: DataFrame) -> DataFrame:
    """Mean depth over all regions of a sample by length, and how many there are; empty regions are left out."""
    t = regions.filter("end > start").groupBy("sample").agg(F.sum("depth_sum").alias("bases"), F.sum(F.col("end") - F.col("start")).alias("length"), F.count("*").alias("regions"))
    return t.select("sample", F.try_divide(F.col("bases").cast("double"), F.col("length")).alias("mean_depth"), "regions")


def lambda_of(depth: Column, read_length: Column, k: int = 21) -> Column:
    """k-mer coverage per haplotype of a read depth; null if either is missing, 0, or reads are no longer than k."""
    ok = (depth != 0) & (read_length > k)
    return F.when(ok, depth * (read_length - k + 1) / read_length / 2)


def partition(depths: DataFrame, window: float = 2.0, least: int = 500, collapsed: float = 0.75) -> DataFrame:
    """Length and number of contigs per sample in each class of depth, against the sample's ``host_depth``."""
    d, h = F.col("meandepth"), F.col("host_depth")
    kind = (
        F.when(F.col("length") < least, "excluded").when(d < h / window, "below").when(d > h * window, "above")
        .when(d < F.greatest(h / window, h * collapsed), "host_haplotig").otherwise("host_collapsed")
    )
    t = depths.filter("host_depth > 0").withColumn("kind", kind)
    size = lambda *k: F.coalesce(F.sum(F.when(F.col("kind").isin(*k), F.col("length"))), F.lit(0))
    n = lambda *k: F.count_if(F.col("kind").isin(*k))
    kinds = {"host": ("host_collapsed", "host_haplotig"), "host_collapsed": ("host_collapsed",), "host_haplotig": ("host_haplotig",), "below": ("below",), "above": ("above",), "excluded": ("excluded",)}
    aggs = [x for name, k in kinds.items() for x in (size(*k).alias(f"{name}_size"), n(*k).alias(f"{name}_contigs"))]
    return t.groupBy("sample").agg(*aggs)


def depth_mode(depths: DataFrame, least: int = 500, width: float = 0.25) -> DataFrame:
    """The depth at the middle of the heaviest bin of log2 depth; of equal bins that with the first contig."""
    bins = depths.filter((F.col("length") >= least) & (F.col("meandepth") > 0)).withColumn("bin", F.floor(F.log2("meandepth") / width))
    bins = bins.groupBy("sample", "bin").agg(F.sum("length").alias("size"), F.min("contig").alias("first"))
    # min_by on (-size, first) needs no negated name, so contigs may be named by text or number
    best = bins.groupBy("sample").agg(F.min_by("bin", F.struct(-F.col("size"), F.col("first"))).alias("bin"), F.max("size").alias("top"), F.sum("size").alias("total"))
    return best.select("sample", F.pow(F.lit(2.0), (F.col("bin") + 0.5) * width).alias("depth_mode"), F.try_divide(F.col("top"), F.col("total")).alias("mode_fraction"))


def confidence(regions: Column, anchor: Column, mode: Column, fraction: Column, window: float = 2.0, least_regions: int = 50, least_fraction: float = 0.4) -> Column:
    """Why the partition can't be trusted, or ``high``."""
    return (
        F.when(F.coalesce(regions, F.lit(0)) < least_regions, "few_busco_regions")
        .when(mode.isNull() | fraction.isNull() | (fraction < least_fraction), "no_dominant_mode")
        .when((anchor / mode > window) | (mode / anchor > window), "anchor_off_mode")
        .otherwise("high")
    )


def depth_record(samples: DataFrame, depths: DataFrame, window: float = 2.0, least: int = 500, least_regions: int = 50, least_fraction: float = 0.4, k: int = 21) -> DataFrame:
    """One row for every row of ``samples``: the measured coverage, and what of the assembly lies at the host's depth.

    ``samples`` has sample, status, busco_regions, busco_mean_depth, read_length, total_bases, assembly_size and kmercov (all
    but the first may be null), ``depths`` sample, contig, length and meandepth. Without contigs or without a host depth
    the sizes are null and partition_status says why. The size at the mode of the depth is given only where the mode is
    dominant (its band holds ``least_fraction`` of what is partitioned) and the host depth is off it by more than ``window``.
    """
    c = F.col
    s = samples.select(
        "sample", F.coalesce("status", F.lit("ok")).alias("_status"), F.coalesce("busco_regions", F.lit(0)).alias("busco_regions"), c("busco_mean_depth").cast("double").alias("busco_mean_depth"),
        c("read_length").cast("double").alias("read_length"), c("total_bases").cast("double").alias("_bases"), c("assembly_size").cast("long").alias("assembly_size"), c("kmercov").cast("double").alias("genomescope_kmercov"),
    )
    there = depths.groupBy("sample").agg(F.lit(True).alias("_there"))
    host = F.nullif("busco_mean_depth", F.lit(0.0))
    at = partition(depths.join(s.select("sample", host.alias("host_depth")), "sample"), window, least)
    at = at.select("sample", *[c(f"{n}_size").alias(f"_{n}") for n in ("host", "host_collapsed", "host_haplotig", "below", "above")], c("host_contigs").alias("_contigs"))
    mode = depth_mode(depths, least).select("sample", "depth_mode")
    there_mode = partition(depths.join(mode.withColumnRenamed("depth_mode", "host_depth"), "sample"), window, least).select("sample", c("host_size").alias("_at_mode"))
    t = s.join(there, "sample", "left").join(at, "sample", "left").join(mode, "sample", "left").join(there_mode, "sample", "left")
    lam = lambda_of(c("busco_mean_depth"), c("read_length"), k)
    mean = F.try_divide(F.nullif("_bases", F.lit(0.0)), F.nullif("assembly_size", F.lit(0)))
    state = F.when(c("_there").isNull(), "no_contig_depth").when(host.isNull(), "no_host_depth").otherwise("ok")
    t = t.withColumns({"lambda_depth": lam, "assembly_mean_depth": mean, "partition_status": state, "_ok": state == "ok"})
    ok = lambda x: F.when(c("_ok"), x)
    partitioned = c("_host") + c("_above") + c("_below")
    fraction = ok(F.try_divide(c("_at_mode").cast("double"), partitioned))
    off = ok(F.try_divide(c("busco_mean_depth"), c("depth_mode")))
    note = confidence(c("busco_regions"), c("busco_mean_depth"), c("depth_mode"), fraction, window, least_regions, least_fraction)
    anchored = (fraction >= least_fraction) & ((off > window) | (off < 1 / window))
    return t.select(
        c("sample").alias("sample_id"), F.when(c("lambda_depth").isNull() & (c("_status") == "ok"), "no_measurement").otherwise(c("_status")).alias("status"), "busco_regions", "busco_mean_depth", "read_length",
        "lambda_depth", "assembly_mean_depth", F.try_divide(host, c("assembly_mean_depth")).alias("busco_depth_over_assembly_depth"), "assembly_size", "genomescope_kmercov",
        F.try_divide(F.nullif("genomescope_kmercov", F.lit(0.0)), c("lambda_depth")).alias("kmercov_over_lambda_depth"), ok(c("_host")).alias("host_assembly_size"),
        ok(F.try_divide(c("_host").cast("double"), partitioned)).alias("host_assembly_fraction"), ok(c("_above")).alias("symbiont_assembly_size"), ok(c("_below")).alias("low_depth_assembly_size"),
        ok(c("_contigs")).alias("host_contig_count"), "partition_status", ok(c("_host_collapsed")).alias("host_collapsed_size"), ok(c("_host_haplotig")).alias("host_haplotig_size"),
        ok(F.expr("_host_collapsed + _host_haplotig div 2")).alias("host_haploid_size"), ok(c("depth_mode")).alias("depth_mode"), off.alias("anchor_over_mode"),
        ok(F.when(note == "high", "high").otherwise("low")).alias("partition_confidence"), ok(F.nullif(note, F.lit("high"))).alias("partition_note"),
        F.when(anchored, c("_at_mode")).alias("host_assembly_size_mode_anchored"),
    )
