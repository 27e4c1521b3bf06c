"""Contigs: contaminant actions, names, length floors, statistics, gene regions and depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanefold.functions.sequences import count_of, reverse_complement
from lanefold.functions.shared import written
from lanefold.operators.coverage import BIN, KEY, alignment_blocks, good_alignments, sums_in_regions
from lanefold.operators.quantiles import percentiles

ACTIONS = ("EXCLUDE", "TRIM", "REVIEW")
POLICIES = ("exclude", "short-only", "keep")


# Contigs are named by assemblers alike in every sample: sample and name (KEY) identify one.


def action_summary(actions: DataFrame) -> DataFrame:
    """Per sample and kind of action: different contigs and bases; 0 where a sample with any action has none. Null ends count as no bases."""
    kinds = actions.select("sample").distinct().select("sample", F.explode(F.array(*map(F.lit, ACTIONS))).alias("action"))
    t = actions.groupBy("sample", "action").agg(F.countDistinct("contig").alias("contigs"), F.sum(F.col("a_end") - F.col("a_start") + 1).alias("bp"))
    return kinds.join(t, ["sample", "action"], "left").select("sample", "action", F.coalesce("contigs", F.lit(0)).alias("contigs"), F.coalesce("bp", F.lit(0)).cast("long").alias("bp"))


def apply_actions(contigs: DataFrame, actions: DataFrame) -> DataFrame:
    """The clean pieces: excluded contigs go, trimmed intervals (1-based, closed) are cut out; piece counts from 1.

    Intervals of a contig are merged in order of their start; a cut at an end shortens, one inside splits. Actions of one
    sample don't touch contigs of the same name in another; actions of unknown contigs do nothing.
    """
    cuts = actions.filter("action = 'TRIM'").groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("a_start", "a_end"))).alias("cuts"))
    kept = contigs.join(actions.filter("action = 'EXCLUDE'").select(*KEY).distinct(), KEY, "left_anti").join(cuts, KEY, "left")
    start = F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("out"))
    step = lambda acc, x: F.struct(
        F.greatest(acc["at"], (x["a_end"] + 1).cast("long")).alias("at"),
        F.when(x["a_start"] > acc["at"], F.array_append(acc["out"], F.struct(acc["at"].alias("s"), (x["a_start"] - 1).cast("long").alias("e")))).otherwise(acc["out"]).alias("out"),
    )
    close = lambda acc: F.array_append(acc["out"], F.struct(acc["at"].alias("s"), F.length("seq").cast("long").alias("e")))
    spans = F.filter(F.aggregate(F.coalesce("cuts", F.array().cast("array<struct<a_start:bigint,a_end:bigint>>")), start, step, close), lambda x: x["e"] >= x["s"])
    pieces = kept.select("sample", "contig", "seq", F.posexplode(spans).alias("n", "x"))
    return pieces.select("sample", "contig", (F.col("n") + 1).alias("piece"), F.substr("seq", F.col("x.s").cast("int"), (F.least(F.col("x.e"), F.length("seq")) - F.col("x.s") + 1).cast("int")).alias("seq"))


def removed_pieces(contigs: DataFrame, actions: DataFrame) -> DataFrame:
    """sample, contig, a_start, a_end, seq of what ``apply_actions`` takes away: excluded contigs as a whole, else each merged trimmed interval inside the contig.

    Intervals that touch or overlap are one piece; empty contigs and intervals outside give no row.
    """
    n = F.length("seq").cast("long")
    gone = actions.filter("action = 'EXCLUDE'").select(*KEY).distinct()
    whole = contigs.join(gone, KEY, "left_semi").filter(n > 0).select(*KEY, F.lit(1).cast("long").alias("a_start"), n.alias("a_end"), "seq")
    trims = actions.filter("action = 'TRIM'").join(gone, KEY, "left_anti").groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct(F.greatest(F.col("a_start").cast("long"), F.lit(1)).alias("s"), F.col("a_end").cast("long").alias("e")))).alias("cuts"))
    cut = contigs.join(trims, KEY).withColumn("cuts", F.filter(F.transform("cuts", lambda x: F.struct(x["s"].alias("s"), F.least(x["e"], n).alias("e"))), lambda x: x["e"] >= x["s"]))
    span = "array<struct<s:bigint,e:bigint>>"
    open_ = F.struct(F.lit(0).cast("long").alias("s"), F.lit(-1).cast("long").alias("e"), F.array().cast(span).alias("out"))
    step = lambda acc, x: F.when(acc["e"] < 0, F.struct(x["s"].alias("s"), x["e"].alias("e"), acc["out"].alias("out"))).when(
        x["s"] <= acc["e"] + 1, F.struct(acc["s"].alias("s"), F.greatest(acc["e"], x["e"]).alias("e"), acc["out"].alias("out"))
    ).otherwise(F.struct(x["s"].alias("s"), x["e"].alias("e"), F.array_append(acc["out"], F.struct(acc["s"].alias("s"), acc["e"].alias("e"))).alias("out")))
    close = lambda acc: F.when(acc["e"] < 0, acc["out"]).otherwise(F.array_append(acc["out"], F.struct(acc["s"].alias("s"), acc["e"].alias("e"))))
    parts = cut.select(*KEY, "seq", F.explode(F.aggregate("cuts", open_, step, close)).alias("x"))
    parts = parts.select(*KEY, F.col("x.s").alias("a_start"), F.col("x.e").alias("a_end"), F.substr("seq", F.col("x.s").cast("int"), (F.col("x.e") - F.col("x.s") + 1).cast("int")).alias("seq"))
    return whole.unionByName(parts)


def review_names(actions: DataFrame, policy: str, short: int = 1000) -> DataFrame:
    """sample and contig of those under review that the policy removes: all, those no longer than ``short``, or none."""
    if policy not in POLICIES:
        raise ValueError(f"unknown review policy {policy!r}")
    rows = actions.filter("action = 'REVIEW'")
    rows = rows.filter(F.col("a_end") <= short) if policy == "short-only" else rows.filter(F.lit(policy == "exclude"))
    return rows.select(*KEY).distinct()


def drop_named(contigs: DataFrame, names: DataFrame) -> DataFrame:
    """Contigs that ``names`` (sample, contig) doesn't hold; null names drop nothing, repeated ones drop once."""
    return contigs.join(names.select(*KEY), KEY, "left_anti")


def length_floor(contigs: DataFrame, least: int = 500) -> tuple[DataFrame, DataFrame]:
    """Contigs of ``least`` bases or more, and how many non-empty ones each sample loses."""
    short = contigs.groupBy("sample").agg(F.count_if((F.length("seq") > 0) & (F.length("seq") < least)).alias("n_short"))
    return contigs.filter(F.length("seq") >= least), short


def filter_hits(hits: DataFrame, span: int = 200, identity: float = 98) -> DataFrame:
    """Hits longer than ``span`` and more alike than ``identity``; a null in any of them drops the hit, repeated rows stay."""
    return hits.filter((F.col("q_end") - F.col("q_start") > span) & (F.col("identity") > identity))


def adaptor_actions(report: DataFrame) -> DataFrame:
    """sample, contig, action, a_start, a_end from an adaptor report (sample, contig, length, action, ranges).

    ``ACTION_EXCLUDE`` drops the contig, ``ACTION_TRIM`` cuts every interval of ``ranges`` (``12..40,90..100``, 1-based and
    closed); other actions and unreadable ranges give no row.
    """
    trim = F.filter(F.split("ranges", ","), lambda x: x.rlike(r"^\s*\d+\.\.\d+\s*$"))
    spans = F.transform(trim, lambda x: F.struct(*(F.regexp_extract(x, r"(\d+)\.\.(\d+)", k).cast("long").alias(n) for k, n in ((1, "s"), (2, "e")))))
    whole = F.array(F.struct(F.lit(1).cast("long").alias("s"), F.col("length").cast("long").alias("e")))
    t = report.withColumn("action", F.regexp_extract("action", r"^(?:ACTION_)?(EXCLUDE|TRIM)$", 1))
    t = t.select(*KEY, "action", F.explode(F.when(F.col("action") == "EXCLUDE", whole).when(F.col("action") == "TRIM", spans)).alias("x"))
    return t.select(*KEY, "action", F.col("x.s").alias("a_start"), F.col("x.e").alias("a_end"))


def decontaminate(contigs: DataFrame, actions: DataFrame, policy: str = "exclude", least: int = 500, adaptors: DataFrame | None = None, classes: DataFrame | None = None) -> DataFrame:
    """Actions, review by policy, the length floor, adaptor actions (see ``adaptor_actions``), then removal by domain (lines of ``classes``).

    The floor holds for what the adaptor screen is given, so a piece may be shorter after its adaptors are cut. Adaptor places are those of the pieces that the first actions leave, named by contig for a single piece, and by
    contig and number (``c.2``) for the others.
    """
    clean = length_floor(drop_named(apply_actions(contigs, actions), review_names(actions, policy)), least)[0]
    if adaptors is not None:
        named = F.when(F.col("piece") == 1, F.col("contig").cast("string")).otherwise(F.concat_ws(".", "contig", "piece"))
        again = apply_actions(clean.select("sample", named.alias("contig"), "seq"), adaptors.withColumn("contig", F.col("contig").cast("string")))
        clean = again.select("sample", "contig", "piece", "seq")
    if classes is not None:
        gone = domain_removal(classes)
        clean = clean.join(gone.select("sample", F.col("contig").alias("_c")), (clean["sample"] == gone["sample"]) & (clean["contig"].cast("string") == F.col("_c")), "left_anti")
    return clean


def _lengths(contigs: DataFrame, by: list[str]) -> DataFrame:
    """``by``, length, how many sequences have it (k), and their Ns and GC: all that statistics need, from one pass; null sequences are left out."""
    of = contigs.filter("seq IS NOT NULL").select(*by, F.length("seq").alias("length"), count_of(F.col("seq"), "N").alias("_n"), count_of(F.col("seq"), "GC").alias("_gc"))
    return written(of.groupBy(*by, "length").agg(F.count("*").alias("k"), F.sum("_n").alias("_n"), F.sum("_gc").alias("_gc")), "lengths")


def _stats(lengths: DataFrame, by: list[str]) -> DataFrame:
    """The columns of ``seq_stats`` from counted lengths."""
    total, n = F.sum(F.col("length") * F.col("k")), F.sum("k")
    t = lengths.groupBy(*by).agg(
        n.alias("num_seqs"), total.alias("sum_len"), F.min("length").alias("min_len"), (total.cast("double") / n).alias("avg_len"), F.max("length").alias("max_len"),
        F.sum("_n").alias("n_bases"), F.try_divide(F.sum("_gc") * 100.0, total).alias("gc_pct"),
    )
    quarts = percentiles(lengths, by, ["length"], {"1": 0.25, "2": 0.5, "3": 0.75}, weight="k")
    t = t.alias("t").join(quarts.alias("q"), [F.col(f"t.{c}").eqNullSafe(F.col(f"q.{c}")) for c in by], "left").select("t.*", *[F.col(f"q.length_{k}").alias(f"q{k}") for k in "123"])
    return t.join(_crossings(lengths.select(*by, F.col("length").cast("long").alias("length"), "k"), by, (50,)).select(*by, F.col("n").alias("n50")), by, "left")


def seq_stats(contigs: DataFrame) -> DataFrame:
    """Number, lengths with quartiles, N50, gaps and GC of each sample's contigs; null sequences are left out, rates of no bases are null.

    Sequences are read once, at the call; the rest works on a row for each different length.
    """
    return _stats(_lengths(contigs, ["sample"]), ["sample"])


def scaffold_and_contig_stats(contigs: DataFrame) -> DataFrame:
    """``seq_stats`` of the scaffolds (kind ``scaffold``) and of their parts between gaps (kind ``contig``), from one pass over the sequences."""
    of = lambda kind, seq: F.struct(F.lit(kind).alias("kind"), seq.alias("seq"))
    parts = F.filter(F.split("seq", "N+"), lambda x: x != "")
    both = contigs.select("sample", F.inline(F.concat(F.array(of("scaffold", F.col("seq"))), F.transform(parts, lambda x: of("contig", x)))))
    by = ["sample", "kind"]
    t = _stats(_lengths(both, by), by)
    return t.select(*[c for c in t.columns if c != "kind"], "kind")


def nstar(lengths: DataFrame, fractions: tuple[int, ...] = (10, 20, 30, 40, 50, 60, 70, 80, 90, 100), sizes: DataFrame | None = None) -> DataFrame:
    """sample, pct, n (length at which the running sum crosses pct % of the total), l (contigs needed), aun.

    ``sizes`` (sample, expected) puts a sample's expected size in the place of its total (NG*); a sample without a positive
    size has no rows then, as its N* would pass for NG*. A percentage never reached has nulls. Contigs are counted by length first, so the window runs over a sample's
    different lengths, not its contigs; null lengths are left out, a sample of empty contigs has a null aun.
    """
    size = F.col("length").cast("long")
    return _crossings(lengths.filter("length IS NOT NULL").groupBy("sample", size.alias("length")).agg(F.count("*").alias("k")), ["sample"], fractions, sizes)


def _crossings(t: DataFrame, by: list[str], fractions: tuple[int, ...], sizes: DataFrame | None = None) -> DataFrame:
    """``nstar`` by any columns, of counted lengths (length, k)."""
    totals = t.groupBy(*by).agg(F.sum(F.col("length") * F.col("k")).alias("total"), F.sum(F.col("length").cast("double") * F.col("length") * F.col("k")).alias("squares"))
    if sizes is not None:
        totals = totals.join(sizes.filter("expected >= 1").select("sample", "expected"), "sample").withColumn("total", F.col("expected").cast("long"))
    w = Window.partitionBy(*by).orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    t = t.select(*by, "length", "k", F.sum(F.col("length") * F.col("k")).over(w).alias("run"), F.sum("k").over(w).alias("rank")).join(totals, by)
    before = F.col("run") - F.col("length") * F.col("k")

    def crossing(p: int) -> Column:
        """The largest length that reaches the share, and the contigs up to the one that does."""
        lacking = F.col("total") * p - before * 100
        more = F.greatest(F.ceil(F.try_divide(lacking, F.col("length") * 100)), F.lit(1))
        return F.max(F.when(F.col("run") * 100 >= F.col("total") * p, F.struct("length", (F.col("rank") - F.col("k") + more).alias("l"))))

    t = t.groupBy(*by).agg(F.array(*[F.struct(F.lit(p).alias("pct"), crossing(p).alias("at")) for p in fractions]).alias("xs"), F.first(F.try_divide("squares", "total")).alias("aun"))
    return t.select(*by, "aun", F.explode("xs").alias("x")).select(*by, "x.pct", F.col("x.at.length").alias("n"), F.col("x.at.l").alias("l"), "aun")


def split_scaffolds(contigs: DataFrame) -> DataFrame:
    """Scaffolds cut at runs of N; empty pieces are dropped."""
    parts = contigs.select("sample", "contig", F.posexplode(F.split("seq", "N+")).alias("part", "seq"))
    return parts.filter("seq <> ''").withColumn("length", F.length("seq"))


def gene_regions(genes: DataFrame, contigs: DataFrame) -> DataFrame:
    """sample, gene, contig, start, end: complete genes on known contigs as 0-based half-open regions, ends in order and clipped to the contig."""
    t = genes.filter("status = 'Complete'").join(contigs.select(*KEY, "length"), KEY)
    t = t.select("sample", "gene", "contig", (F.greatest(F.least("g_start", "g_end"), F.lit(1)) - 1).alias("start"), F.least(F.greatest("g_start", "g_end"), F.col("length")).alias("end"))
    return t.filter("end > start")


def region_counts(genes: DataFrame, contigs: DataFrame) -> DataFrame:
    """sample, kept and skipped complete genes: skipped are those on unknown contigs or with nothing left inside theirs."""
    kept = gene_regions(genes, contigs).groupBy("sample").agg(F.count("*").alias("kept"))
    complete = genes.groupBy("sample").agg(F.count_if(F.col("status") == "Complete").alias("complete"))
    t = complete.join(kept, "sample", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    return t.select("sample", "kept", (F.col("complete") - F.col("kept")).alias("skipped"))


def gene_sequences(genes: DataFrame, contigs: DataFrame) -> DataFrame:
    """sample, gene, contig, strand, header (``>gene|contig:start-end(strand)``) and sequence of all found genes; the minus strand is reverse-complemented."""
    t = genes.filter("status <> 'Missing'").join(contigs.select(*KEY, "seq"), KEY)
    lo = F.greatest(F.least("g_start", "g_end"), F.lit(1))
    hi = F.greatest(F.greatest("g_start", "g_end"), lo + 1)
    part = F.substr("seq", lo.cast("int"), (hi - lo + 1).cast("int"))
    header = F.concat(F.lit(">"), "gene", F.lit("|"), "contig", F.lit(":"), lo, F.lit("-"), hi, F.lit("("), "strand", F.lit(")"))
    return t.select("sample", "gene", "contig", "strand", header.alias("header"), F.when(F.col("strand") == "-", reverse_complement(part)).otherwise(part).alias("seq"))


def region_depth(alignments: DataFrame, regions: DataFrame, min_mapq: int = 20, bin_size: int = BIN) -> DataFrame:
    """Bases of good alignments over each region; regions without any stay with 0.

    Flags unmapped, secondary, failed and duplicate are left out. With a ``cigar`` the bases are those of its blocks,
    deletions counted and skips not. Alignments and regions meet as positions of a contig (see ``sums_in_regions``),
    so deep coverage and crowded regions don't multiply.
    """
    good = good_alignments(alignments, min_mapq)
    good = alignment_blocks(good) if "cigar" in alignments.columns else good
    return sums_in_regions(good.select(*KEY, "a_start", "a_end", F.lit(1).alias("depth")), regions, bin_size)


def region_status(regions: DataFrame, samples: DataFrame, least: int = 20) -> DataFrame:
    """sample, regions and status of every row of ``samples``: ``too_few_busco_regions`` below ``least``, else ``ok``."""
    t = samples.select("sample").distinct().join(regions.groupBy("sample").agg(F.count("*").alias("regions")), "sample", "left")
    t = t.withColumn("regions", F.coalesce("regions", F.lit(0)))
    return t.withColumn("status", F.when(F.col("regions") < least, "too_few_busco_regions").otherwise("ok"))


def contig_depth(alignments: DataFrame, contigs: DataFrame, min_mapq: int = 0) -> DataFrame:
    """Mean depth of each contig: aligned bases inside it by its length; 0 without alignments, null without bases.

    With a ``cigar`` the bases are those of M, = and X, as deleted ones have no read base; without one, those from a_start to
    a_end. Lengths are joined to the alignments, a join that can be split where a contig has most of them, and each task sums
    what it has before the shuffle.
    """
    good = good_alignments(alignments, min_mapq)
    if "cigar" in alignments.columns:
        good = alignment_blocks(good, "M=X")
    long = contigs.select(*KEY, F.col("length").alias("most"))
    inside = F.greatest(F.least("a_end", "most") - F.greatest("a_start", F.lit(0)), F.lit(0))
    sums = good.select(*KEY, "a_start", "a_end").join(long, KEY).groupBy(*KEY).agg(F.sum(inside).alias("bases"))
    got = contigs.select(*KEY, "length").join(sums, KEY, "left")
    return got.select(*KEY, "length", F.try_divide(F.coalesce("bases", F.lit(0)), F.col("length")).alias("meandepth"))


def mapping_summary(alignments: DataFrame) -> DataFrame:
    """Per sample: alignments, mapped, reverse, secondary, properly paired and duplicate ones and the mean quality; null flags count in the total only."""
    flag = lambda bit: F.count_if(F.col("flag").bitwiseAND(bit) > 0)
    return alignments.groupBy("sample").agg(
        F.count("*").alias("total"), F.count_if(F.col("flag").bitwiseAND(4) == 0).alias("mapped"), flag(16).alias("reverse"), flag(256).alias("secondary"),
        flag(2).alias("paired"), flag(1024).alias("duplicates"), F.avg("mapq").alias("mean_mapq"),
    )


#: Domain categories in the order of their report.
DOMAINS = ("archaea", "bacteria", "organelle", "mitochondrion", "plastid", "prokarya")


def domain_summary(classes: DataFrame, by: str = "sample") -> DataFrame:
    """by, ord, category, num_contigs, bp of all six categories of each sample, 0 where absent.

    ``line`` is a row of the classifier's report. A category counts wherever it stands as a whole word, so an
    organelle contig counts under ``organelle`` and its kind; bases come from the first ``len=`` of the line.
    """
    bp = F.coalesce(F.nullif(F.regexp_extract("line", r"len=(\d+)", 1), F.lit("")).cast("long"), F.lit(0))
    hit = lambda d: F.col("line").rlike(rf"\b{d}\b")
    t = classes.groupBy(by).agg(F.array(*[F.struct(F.lit(d).alias("category"), F.count_if(hit(d)).alias("num_contigs"), F.coalesce(F.sum(F.when(hit(d), bp)), F.lit(0)).alias("bp")) for d in DOMAINS]).alias("xs"))
    return t.select(by, F.posexplode("xs").alias("ord", "x")).select(by, "ord", "x.category", "x.num_contigs", "x.bp")


def domain_removal(classes: DataFrame, by: str = "sample") -> DataFrame:
    """Different contigs (the first word of a line) of any of the categories."""
    t = classes.filter(F.col("line").rlike(rf"\b({'|'.join(DOMAINS)})\b"))
    return t.select(by, F.split(F.trim("line"), r"\s+")[0].alias("contig")).distinct()
