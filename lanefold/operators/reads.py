"""Reads: pairing, filtering, duplicates and summaries for all samples at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanefold.operators.taxonomy import clade_members

from lanefold.functions.sequences import count_of, cut_tail_length, quality_at_least
from lanefold.functions.shared import written


def repair_pairs(reads: DataFrame, columns: tuple[str, ...] = ("seq", "qual")) -> DataFrame:
    """One row a (sample, read_id) with both mates' ``columns``, and ``single`` for those with one mate only."""
    side = lambda m: reads.filter(F.col("mate") == m).select("sample", "read_id", *[F.col(c).alias(f"{c}{m}") for c in columns])
    both = side(1).join(side(2), ["sample", "read_id"], "full")
    return both.withColumn("single", F.col(f"{columns[0]}1").isNull() | F.col(f"{columns[0]}2").isNull())


def filter_length(pairs: DataFrame, shortest: int = 100, longest: int = 300) -> DataFrame:
    """Mates cut to ``longest``; pairs stay if both are then ``shortest`` or more."""
    cut = {c: F.substring(c, 1, longest) for c in ("seq1", "seq2", "qual1", "qual2")}
    return pairs.withColumns(cut).filter((F.length("seq1") >= shortest) & (F.length("seq2") >= shortest))


def dedup_pairs(pairs: DataFrame) -> DataFrame:
    """One of each group of pairs with equal sequences: the lowest read_id with its qualities, and how many ``copies`` there were.

    A missing mate equals only a missing mate. Partial aggregation keeps copies out of the shuffle.
    """
    t = pairs.groupBy("sample", "seq1", "seq2").agg(F.min(F.struct("read_id", "qual1", "qual2")).alias("x"), F.count("*").alias("copies"))
    return t.select("sample", "seq1", "seq2", "x.read_id", "x.qual1", "x.qual2", "copies")


#: Codes of the reasons why a read goes; the highest of its mates is the pair's. 0 is a read that stays.
REASONS = {"too_many_n": 12, "too_short": 16, "too_long": 17, "low_quality": 20}


def _measures(seq: Column, qual: Column, q: int) -> dict[str, Column]:
    return {"size_": F.length(seq), "n_": count_of(seq, "N"), "gc_": count_of(seq, "GC"), **{f"q{x}_": quality_at_least(qual, x) for x in sorted({q, 20, 30})}}


def _measured(pairs: DataFrame, m: int, q: int = 20) -> dict[str, Column]:
    """A mate's measures: those that the pairs have, else from its sequence and qualities."""
    names = _measures(F.lit(""), F.lit(""), q)
    return {c: F.col(f"{c}{m}") for c in names} if f"size_{m}" in pairs.columns else _measures(F.col(f"seq{m}"), F.col(f"qual{m}"), q)


def measured_pairs(reads: DataFrame, q: int = 15) -> DataFrame:
    """``repair_pairs`` with what filtering and its summary need of a mate (``q`` as in ``filter_reasons``) in the place of sequences and qualities.

    Reads are measured once, at the call; a few numbers a read are shuffled, no letters.
    """
    names = _measures(F.col("seq"), F.col("qual"), q)
    return repair_pairs(written(reads.select("sample", "read_id", "mate", *[v.alias(c) for c, v in names.items()]), "measures"), tuple(names))


def filter_reasons(pairs: DataFrame, shortest: int = 15, longest: int = 0, q: int = 15, low_pct: int = 40, most_n: int = 5) -> DataFrame:
    """``pairs`` (or ``measured_pairs`` with the same ``q``) with ``reason``: passed, low_quality, too_many_n, too_short or too_long.

    A mate has low quality if more than ``low_pct`` percent of its bases are below ``q``; then come its Ns, then its
    length (``longest`` 0: no limit). A missing mate is too short, missing qualities count as good.
    """
    def code(m: int) -> Column:
        of = _measured(pairs, m, q)
        size = F.coalesce(of["size_"], F.lit(0))
        low = size - F.coalesce(of[f"q{q}_"], size)
        out = F.when(low * 100 > size * low_pct, REASONS["low_quality"]).when(F.coalesce(of["n_"], F.lit(0)) > most_n, REASONS["too_many_n"]).when(size < shortest, REASONS["too_short"])
        return (out.when(size > longest, REASONS["too_long"]) if longest else out).otherwise(0)

    worst, name = F.greatest(code(1), code(2)), F.lit("passed")
    for reason, n in REASONS.items():
        name = F.when(worst == n, reason).otherwise(name)
    return pairs.withColumn("reason", name)


def mates(pairs: DataFrame) -> DataFrame:
    """sample, read_id, mate, seq and qual of every mate that exists."""
    both = F.array(*[F.struct(F.lit(m).alias("mate"), F.col(f"seq{m}").alias("seq"), F.col(f"qual{m}").alias("qual")) for m in (1, 2)])
    return pairs.select("sample", "read_id", F.inline(both)).filter("seq IS NOT NULL")


def filter_summary(judged: DataFrame) -> DataFrame:
    """One row a sample of pairs with ``reason``: reads by reason, and size, quality, GC and mean lengths before (``raw_``) and after.

    A pair counts as two reads under its reason, a lone mate as one. Mean lengths are whole numbers, cut. A sample
    without a read left has zeros after. One pass and one shuffle of as many rows as there are samples. ``judged`` may come from ``measured_pairs``.
    """
    per, size = [], []
    for m in (1, 2):
        of = _measured(judged, m)
        per.append((of["size_"].isNotNull().cast("long"), of["size_"], of["q20_"], of["q30_"], of["gc_"]))
        size.append(of["size_"])
    add = lambda k: sum((F.coalesce(p[k], F.lit(0)) for p in per), F.lit(0).cast("long"))
    kept, out = F.col("reason") == "passed", []
    for reason in ("passed", *REASONS):
        out.append(F.sum(F.when(F.col("reason") == reason, add(0)).otherwise(0)).alias("passed_filter_reads" if reason == "passed" else f"{reason}_reads"))
    for prefix, here in (("raw_", F.lit(True)), ("", kept)):
        some = lambda c: F.sum(F.when(here, c).otherwise(0))  # noqa: B023, E731
        names = ("total_reads", "total_bases", "q20_bases", "q30_bases", "_gc")
        out += [some(add(k)).alias(f"{prefix}{n}") for k, n in enumerate(names)]
        out += [F.coalesce(F.floor(F.avg(F.when(here, size[m - 1]))), F.lit(0)).alias(f"{prefix}read{m}_mean_length") for m in (1, 2)]
    t = judged.groupBy("sample").agg(*out)
    for prefix in ("raw_", ""):
        rate = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col(f"{prefix}total_bases")), F.lit(0.0))  # noqa: B023, E731
        t = t.withColumns({f"{prefix}q20_rate": rate(f"{prefix}q20_bases"), f"{prefix}q30_rate": rate(f"{prefix}q30_bases"), f"{prefix}gc_content": rate(f"{prefix}_gc")})
    return t.drop("raw__gc", "_gc")


def cut_tail(reads: DataFrame, window: int = 4, q: int = 20) -> DataFrame:
    keep = cut_tail_length(F.col("qual"), window, q)
    return reads.withColumn("_n", keep).withColumns({"seq": F.left("seq", F.col("_n")), "qual": F.left("qual", F.col("_n"))}).drop("_n")


def read_summary(reads: DataFrame) -> DataFrame:
    """Per sample and mate: reads, bases, bases of q20 and q30, their rates, mean length and GC fraction."""
    bases = F.sum(F.length("seq"))
    t = reads.groupBy("sample", "mate").agg(
        F.count("*").alias("n_reads"), bases.alias("bases"), F.sum(quality_at_least(F.col("qual"), 20)).alias("q20_bases"),
        F.sum(quality_at_least(F.col("qual"), 30)).alias("q30_bases"), F.sum(count_of(F.col("seq"), "GC")).alias("gc_bases"),
    )
    rate = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("bases")), F.lit(0.0))
    return t.withColumns({"q20_rate": rate("q20_bases"), "q30_rate": rate("q30_bases"), "gc_content": rate("gc_bases"), "mean_length": F.try_divide(F.col("bases").cast("double"), F.col("n_reads"))})


def position_profile(reads: DataFrame) -> DataFrame:
    """Per sample and place in the read: reads, each base (all but ACGT as ``other``), GC, and mean (sum), quartiles and tenths of the qualities.

    Bases are counted by quality first, so the percentiles see a few hundred rows a place whatever the number of reads.
    Missing qualities are left out of the quality columns; reads without bases give no row.
    """
    at = reads.select("sample", F.posexplode(F.split("seq", "")).alias("pos", "base"), "qual").filter("base <> ''")
    q = F.ascii(F.nullif(F.substr("qual", F.col("pos") + 1, F.lit(1)), F.lit(""))) - 33
    some = at.groupBy("sample", (F.col("pos") + 1).alias("pos"), "base", q.alias("q")).agg(F.count("*").alias("k"))
    count = lambda c: F.sum(F.when(c, F.col("k")).otherwise(0))
    each = [count(F.col("base") == b).alias(f"n_{b.lower()}") for b in "ACGT"]
    spread = F.percentile("q", [0.1, 0.25, 0.5, 0.75, 0.9], F.col("k")).alias("_p")
    t = some.groupBy("sample", "pos").agg(
        F.sum("k").alias("n"), *each, count(~F.col("base").isin(*"ACGT")).alias("n_other"), count(F.col("base").isin("G", "C")).alias("gc"),
        F.sum(F.col("q") * F.col("k")).alias("quality_sum"), spread,
    )
    return t.withColumns({f"q{p}": F.get("_p", F.lit(i)) for i, p in enumerate((10, 25, 50, 75, 90))}).drop("_p")


def exclude_clades(pairs: DataFrame, assigned: DataFrame, closure: DataFrame, taxids: list[int]) -> DataFrame:
    """Pairs not assigned to an excluded taxon or anything below it; unclassified ones stay."""
    banned = closure.filter(F.col("ancestor").isin(taxids)).select("taxid").distinct()
    hit = assigned.join(banned, "taxid", "left_semi").select("sample", "read_id").distinct()
    return pairs.join(hit, ["sample", "read_id"], "left_anti")


def exclude_clade_ranges(pairs: DataFrame, assigned: DataFrame, labels: DataFrame, taxids: list[int]) -> DataFrame:
    """``exclude_clades`` by the numbers of ``tree_labels``: a taxon is excluded if its number lies in an excluded clade's."""
    banned = clade_members(labels, taxids)
    hit = assigned.join(banned, "taxid", "left_semi").select("sample", "read_id").distinct()
    return pairs.join(hit, ["sample", "read_id"], "left_anti")


def retention(report: DataFrame, taxids: list[int]) -> DataFrame:
    """Reads kept and removed per sample from a clade report (sample, taxid, rank, clade_reads)."""
    total = F.sum(F.when((F.col("rank") == "U") | (F.col("taxid") == 1), F.col("clade_reads")).otherwise(0))
    gone = F.sum(F.when(F.col("taxid").isin(taxids), F.col("clade_reads")).otherwise(0))
    t = report.groupBy("sample").agg(total.alias("total_reads"), gone.alias("removed_reads"))
    t = t.withColumn("kept_reads", F.col("total_reads") - F.col("removed_reads"))
    return t.withColumn("retention_pct", F.coalesce(F.round(F.try_divide(F.col("kept_reads") * 100.0, F.col("total_reads")), 2), F.lit(0.0)))


def retention_shares(report: DataFrame, taxids: list[int]) -> DataFrame:
    """sample, taxid, removed_reads and share_pct (of all the sample's reads, 0 if there are none) of each excluded taxon in the report."""
    all_reads = retention(report, taxids).select("sample", "total_reads")
    gone = report.filter(F.col("taxid").isin(taxids)).groupBy("sample", "taxid").agg(F.sum("clade_reads").alias("removed_reads"))
    share = F.coalesce(F.round(F.try_divide(F.col("removed_reads") * 100.0, F.col("total_reads")), 2), F.lit(0.0))
    return gone.join(all_reads, "sample").select("sample", "taxid", "removed_reads", share.alias("share_pct"))


def mean_read_length(summary: DataFrame) -> DataFrame:
    """Mean over the mates of their mean lengths, without zeros; null if none."""
    return summary.groupBy("sample").agg(F.avg(F.when(F.col("mean_length") != 0, F.col("mean_length"))).alias("mean_read_length"))
