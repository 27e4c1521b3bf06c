"""Depth of alignments: reference blocks of their CIGAR, and depth along contigs by a sweep.

The sweep adds +1 where a block starts and -1 where it ends. Positions are summed first, so any number of reads at one
place is a row; contigs are cut into bins, whose sums carry the depth from bin to bin, so a contig
is swept by as many tasks as it has bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["sample", "contig"]
#: Fixed value: unmapped, secondary, failed and duplicate alignments.
BAD_FLAGS = 4 + 256 + 512 + 1024
BIN = 1 << 16


def good_alignments(alignments: DataFrame, min_mapq: int = 0) -> DataFrame:
    """Mapped primary alignments that didn't fail, aren't duplicates and have the quality; null flags or qualities drop out."""
    return alignments.filter((F.col("mapq") >= min_mapq) & (F.col("flag").bitwiseAND(BAD_FLAGS) == 0))


def alignment_blocks(alignments: DataFrame, counted: str = "M=XD") -> DataFrame:
    """A row for each stretch of the reference that an alignment covers: its columns without ``cigar``, a_start and the new a_end (0-based, half-open).

    ``a_start`` is where the alignment starts. Of the operations that move along the reference (M, =, X, D and N) those in
    ``counted`` cover it and the others part the blocks; clips, insertions and padding do neither. A null, ``*`` or
    empty cigar gives no row. ``M=X`` leaves deletions out, ``M=XDN`` counts skips too.
    """
    if not set(counted) <= set("M=XDN"):
        raise ValueError(f"{counted!r} has operations that don't cover the reference")
    kinds, sizes = (F.regexp_extract_all("cigar", F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(k)) for k in (2, 1))
    span = "array<struct<s:bigint,e:bigint>>"
    state = lambda at, since, out: F.struct(at.alias("at"), since.alias("since"), out.alias("out"))
    closed = lambda acc: F.when(acc["at"] > acc["since"], F.array_append(acc["out"], F.struct(acc["since"].alias("s"), acc["at"].alias("e")))).otherwise(acc["out"])
    apart = [c for c in "M=XDN" if c not in counted]
    start = F.col("a_start").cast("long")

    def step(acc, x):
        end = acc["at"] + x["size"].cast("long")
        moved = F.when(x["kind"].isin(*counted), state(end, acc["since"], acc["out"])) if counted else F.when(F.lit(False), acc)
        return (moved.when(x["kind"].isin(*apart), state(end, end, closed(acc))) if apart else moved).otherwise(acc)

    ops = F.arrays_zip(kinds.alias("kind"), sizes.alias("size"))
    blocks = F.aggregate(ops, state(start, start, F.array().cast(span)), step, closed)
    kept = [c for c in alignments.columns if c not in ("cigar", "a_start", "a_end")]
    out = alignments.filter(F.col("cigar").isNotNull() & F.col("a_start").isNotNull()).select(*kept, F.explode(blocks).alias("x"))
    return out.select(*kept, F.col("x.s").alias("a_start"), F.col("x.e").alias("a_end"))


def depth_runs(blocks: DataFrame, bin_size: int = BIN) -> DataFrame:
    """sample, contig, start, end, depth: the longest stretches of one depth above 0 between places where blocks start or end.

    Neighbouring stretches differ in depth unless they meet at a border of two bins. Blocks are a_start and a_end
    of sample and contig, a null sample or contig one like others; empty blocks and null ends cover nothing. No table has more rows than blocks have ends.
    """
    if bin_size < 1:
        raise ValueError("bins have 1 base or more")
    ends = F.explode(F.array(F.struct(F.col("a_start").cast("long").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("a_end").cast("long").alias("pos"), F.lit(-1).alias("d"))))
    steps = blocks.filter("a_end > a_start").select(*KEY, ends.alias("x")).groupBy(*KEY, F.col("x.pos").alias("pos")).agg(F.sum("x.d").alias("d")).filter("d <> 0")
    steps = steps.withColumn("bin", F.floor(F.col("pos") / bin_size))
    bins = steps.groupBy(*KEY, "bin").agg(F.sum("d").alias("net"), F.min("pos").alias("first"))
    along = Window.partitionBy(*KEY).orderBy("bin")
    before = F.coalesce(F.sum("net").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = bins.select(*KEY, "bin", before.alias("carried"), F.lead("first").over(along).alias("next"))
    inside = Window.partitionBy(*KEY, "bin").orderBy("pos")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) for c in KEY]
    t = steps.alias("s").join(bins.alias("b"), [*same, F.col("s.bin") == F.col("b.bin")]).select("s.sample", "s.contig", "s.bin", "s.pos", "s.d", "b.carried", "b.next")
    t = t.select(*KEY, F.col("pos").alias("start"), F.coalesce(F.lead("pos").over(inside), F.col("next")).alias("end"), (F.col("carried") + F.sum("d").over(inside)).alias("depth"))
    return t.filter("depth > 0")


def sums_in_regions(blocks: DataFrame, regions: DataFrame, bin_size: int = BIN) -> DataFrame:
    """``regions`` (sample, contig, gene, start, end) with depth_sum, the sum of the depths of their bases; 0 where nothing lies.

    Blocks are a_start, a_end and depth. What lies before a position is one number of its contig, carried from bin to bin as in
    ``depth_runs``, and a region is the difference of two: no block meets a region, and no table has more rows than both have ends.
    """
    pair = lambda first, last, name, one: F.explode(F.array(F.struct(F.col(first).cast("long").alias("pos"), (-one).alias(name)), F.struct(F.col(last).cast("long").alias("pos"), one.alias(name))))
    steps = blocks.filter("a_end > a_start").select(*KEY, pair("a_start", "a_end", "d", -F.col("depth").cast("long")).alias("x")).select(*KEY, "x.pos", "x.d")
    wanted = regions.filter("end > start").select(*KEY, "gene", pair("start", "end", "sign", F.lit(1)).alias("x")).select(*KEY, "gene", "x.pos", "x.sign")
    marks = steps.unionByName(wanted.select(*KEY, "pos", F.lit(0).cast("long").alias("d"))).groupBy(*KEY, "pos").agg(F.sum("d").alias("d"))
    # a step adds its depth to each base behind it: up to x they are the sum of d * (x - pos)
    marks = marks.withColumn("bin", F.floor(F.col("pos") / bin_size))
    bins = marks.groupBy(*KEY, "bin").agg(F.sum("d").alias("net"), F.sum(F.col("d") * F.col("pos")).alias("far"))
    along = Window.partitionBy(*KEY).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(*KEY, "bin", *[F.coalesce(F.sum(c).over(along), F.lit(0)).alias(c) for c in ("net", "far")])
    inside = Window.partitionBy(*KEY, "bin").orderBy("pos")
    depth, far = F.col("net") + F.sum("d").over(inside), F.col("far") + F.sum(F.col("d") * F.col("pos")).over(inside)
    at = marks.join(bins, [*KEY, "bin"]).select(*KEY, "pos", (depth * F.col("pos") - far).alias("before"))
    sums = wanted.join(at, [*KEY, "pos"]).groupBy(*KEY, "gene").agg(F.sum(F.col("sign") * F.col("before")).alias("depth_sum"))
    return regions.join(sums, [*KEY, "gene"], "left").withColumn("depth_sum", F.coalesce("depth_sum", F.lit(0)))


def depth_in_regions(runs: DataFrame, regions: DataFrame, bin_size: int = BIN) -> DataFrame:
    """``regions`` with the depth_sum of ``runs`` of one depth (see ``depth_runs``)."""
    return sums_in_regions(runs.select(*KEY, F.col("start").alias("a_start"), F.col("end").alias("a_end"), "depth"), regions, bin_size)


def mapping_errors(alignments: DataFrame) -> DataFrame:
    """Per sample over mapped, not secondary alignments: mapped_bases (read bases on the reference by M, I, = and X), mismatches (sum of ``nm``), deletions, clipped bases and error_rate.

    Null ``nm`` counts as none; a sample without mapped bases has a null rate.
    """
    bases = lambda kinds: F.aggregate(F.regexp_extract_all("cigar", F.lit(rf"(\d+)[{kinds}]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    some = (F.col("flag").bitwiseAND(4 + 256) == 0) & F.col("cigar").isNotNull()
    told = {"mapped_bases": bases("MI=X"), "mismatches": F.col("nm").cast("long"), "deleted_bases": bases("D"), "clipped_bases": bases("SH")}
    t = alignments.groupBy("sample").agg(*[F.coalesce(F.sum(F.when(some, c)), F.lit(0)).alias(n) for n, c in told.items()])
    return t.withColumn("error_rate", F.try_divide("mismatches", "mapped_bases"))
