"""Cost and use of jobs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanefold.operators.quantiles import percentiles


def duration_seconds(c: Column) -> Column:
    """Seconds of ``D-HH:MM:SS(.ms)``, ``HH:MM:SS``, ``MM:SS`` or plain seconds, to 3 decimals."""
    t = F.regexp_replace(F.regexp_replace(c, ",", "."), r"\s", "")
    days = F.when(F.contains(t, F.lit("-")), F.substring_index(t, "-", 1).cast("double")).otherwise(0.0)
    parts = F.split(F.substring_index(t, "-", -1), ":")
    x = lambda i: F.get(parts, F.lit(i)).cast("double")
    clock = F.when(F.size(parts) == 1, x(0)).when(F.size(parts) == 2, x(0) * 60 + x(1)).otherwise(x(0) * 3600 + x(1) * 60 + x(2))
    return F.round(days * 86400 + clock, 3)


def duration_hours(c: Column) -> Column:
    """Hours of ``D-HH:MM:SS`` or ``HH:MM:SS``; minutes and seconds are cut, not rounded, to four decimals each. Null without three parts."""
    t = F.regexp_replace(c, r"\s", "")
    days = F.when(F.contains(t, F.lit("-")), F.substring_index(t, "-", 1).try_cast("double")).otherwise(0.0)
    parts = F.split(F.substring_index(t, "-", -1), ":")
    x = lambda i: F.get(parts, F.lit(i)).try_cast("decimal(18,6)")
    cut = lambda v, by: (F.floor(v * 10_000 / by) / 10_000).cast("double")
    return F.when(F.size(parts) == 3, F.round(days * 24 + x(0).cast("double") + cut(x(1), 60) + cut(x(2), 3600), 4))


def memory_gb(c: Column, default_unit: str = "M", cpus: Column | None = None, nodes: Column | None = None) -> Column:
    """GB (1024-based) of ``1000Kc``, ``10.5G`` or ``16GBn``; B is bytes, no unit ``default_unit`` (of K, M, G, T, B).

    A closing c or n (per core, per node) multiplies by ``cpus`` or ``nodes`` where they are given and above 0. Null
    without a number.
    """
    t = F.upper(F.regexp_replace(c, r"\s", ""))
    value, unit, scope = (F.regexp_extract(t, r"^([0-9]+(?:\.[0-9]+)?)([KMGT]?I?B?)([CN]?)$", k) for k in (1, 2, 3))
    unit = F.when(unit == "", default_unit.upper()[:1]).otherwise(F.left(unit, F.lit(1)))
    factor = F.when(unit == "K", 1 / 1024**2).when(unit == "M", 1 / 1024).when(unit == "G", 1.0).when(unit == "T", 1024.0).otherwise(1 / 1024**3)
    times = F.lit(1.0)
    for letter, n in (("C", cpus), ("N", nodes)):
        if n is not None:
            times = F.when((scope == letter) & (n > 0), n.cast("double")).otherwise(times)
    return F.when(value != "", value.try_cast("double") * factor * times)


def service_units(jobs: DataFrame) -> DataFrame:
    """``su``: charge rate of the partition times the larger share of a node (cores, or memory up to 1) times nodes times hours."""
    p = F.col("job_partition")
    of = lambda gpu, high, copy, other: F.when(p.contains("gpu"), gpu).when(p.contains("highmem"), high).when(p.contains("copy"), copy).otherwise(other)
    per_node = F.try_divide(F.col("cores"), F.col("nodes"))
    cores = F.round(per_node / of(8.0, 128.0, 64.0, 128.0), 6)
    mem = F.round(F.least(F.try_divide(F.col("mem_gb"), F.col("nodes")) / of(1e18, 980.0, 115.0, 230.0), F.lit(1.0)), 6)
    share = F.when(p.contains("gpu"), cores).otherwise(F.greatest(cores, mem))
    return jobs.withColumn("su", F.round(of(512.0, 128.0, 0.0, 128.0) * share * F.col("nodes") * F.col("elapsed_s") / 3600, 4))


def efficiencies(jobs: DataFrame) -> DataFrame:
    """CPU, memory (at most 100) and wall-time efficiency in percent.

    The CPU time that was there is ``cpu_time_raw`` in seconds where it is above 0, else ``alloc_cpus`` (or ``cores`` without
    that column) by the elapsed time: both count hardware threads, of which a core has two, while ``cores`` of a job
    roll-up are whole cores.
    """
    cpus = F.coalesce("alloc_cpus", "cores") if "alloc_cpus" in jobs.columns else F.col("cores")
    there = cpus * F.col("elapsed_s")
    if "cpu_time_raw" in jobs.columns:
        there = F.when(F.col("cpu_time_raw") > 0, F.col("cpu_time_raw")).otherwise(there)
    return jobs.withColumns({
        "cpu_eff": F.round(F.try_divide(F.col("cpu_s") * 100.0, there), 4),
        "mem_eff": F.round(F.least(F.try_divide(F.col("rss_gb") * 100.0, F.col("mem_gb")), F.lit(100.0)), 4),
        "wall_eff": F.round(F.try_divide(F.col("elapsed_s") * 100.0, F.col("limit_s")), 4),
    })


EFFICIENCIES = ["cpu_eff", "mem_eff", "wall_eff"]


def run_summary(jobs: DataFrame) -> DataFrame:
    """Jobs, SU in all, of failed jobs and the median, and quartiles of the efficiencies; a table without jobs has 0 and nulls."""
    sums = jobs.agg(F.count("*").alias("jobs"), F.round(F.sum("su"), 2).alias("su_total"), F.round(F.sum(F.when(F.col("state") != "COMPLETED", F.col("su")).otherwise(0.0)), 2).alias("su_failed"))
    names = ("min", "q1", "median", "q3", "max")
    quarts = percentiles(jobs, [], ["su", *EFFICIENCIES], dict(zip(names, (0.0, 0.25, 0.5, 0.75, 1.0), strict=True)), 6)
    return sums.crossJoin(quarts.select("su_median", *[f"{c}_{n}" for c in EFFICIENCIES for n in names]))  # one row each


def state_counts(jobs: DataFrame) -> DataFrame:
    """state and jobs, how many ended so; a null state is one of its own."""
    return jobs.groupBy("state").agg(F.count("*").alias("jobs"))


def by_process(jobs: DataFrame) -> DataFrame:
    """Jobs, SU and median efficiencies by the last part of the process name, dearest first; a null name is a group of its own.

    ``rank`` is the place in that order, names deciding ties.
    """
    t = jobs.withColumn("process", F.element_at(F.split("process", ":"), -1))
    sums = t.groupBy("process").agg(F.count("*").alias("jobs"), F.round(F.sum("su"), 2).alias("su"))
    half = percentiles(t, ["process"], EFFICIENCIES, {"median": 0.5}, 6).withColumnRenamed("process", "_p")
    rank = F.row_number().over(Window.orderBy(F.desc("su"), F.asc("process")))  # a row a process
    return sums.join(half, F.col("process").eqNullSafe(F.col("_p")), "left").drop("_p").withColumn("rank", rank).orderBy("rank")


def with_tags(jobs: DataFrame, tags: DataFrame) -> DataFrame:
    """The jobs whose tag is in ``tags`` (tag), each once; null tags match nothing."""
    return jobs.join(tags.select("tag").distinct(), "tag", "left_semi")


def cost_per_sample(jobs: DataFrame) -> DataFrame:
    """sample_id, n_jobs, direct_su, overhead_su_share, total_su, n_failed_jobs, dearest first.

    A job belongs to the sample that its tag starts with (``OG`` and digits: OG1.a and OG1.b are both OG1's); all other
    SU are shared evenly. Without any sample they stand as direct SU of ``_UNATTRIBUTED``, with no share. Null tags and
    SU count as untagged and 0; null states as failed.
    """
    t = jobs.select(F.nullif(F.regexp_extract(F.coalesce("tag", F.lit("")), "^OG[0-9]+", 0), F.lit("")).alias("sample_id"), F.coalesce("su", F.lit(0.0)).alias("su"), (F.coalesce("state", F.lit("")) != "COMPLETED").alias("failed"))
    each = t.groupBy("sample_id").agg(F.count("*").alias("n_jobs"), F.sum("su").alias("direct"), F.count_if("failed").alias("n_failed_jobs"))
    known = each.filter("sample_id IS NOT NULL")
    rest = each.agg(F.sum(F.when(F.col("sample_id").isNull(), F.col("direct"))).alias("rest"), F.sum(F.when(F.col("sample_id").isNull(), F.col("n_jobs"))).alias("rest_jobs"), F.count("sample_id").alias("n"))
    share = F.coalesce(F.try_divide("rest", "n"), F.lit(0.0))
    row = lambda df: df.select("sample_id", "n_jobs", F.round("direct", 4).alias("direct_su"), F.round("share", 4).alias("overhead_su_share"), F.round(F.col("direct") + F.col("share"), 4).alias("total_su"), "n_failed_jobs")
    shared = known.crossJoin(rest.select(share.alias("share")))  # one row
    lonely = rest.filter("n = 0 AND rest_jobs > 0").select(F.lit("_UNATTRIBUTED").alias("sample_id"), F.col("rest_jobs").alias("n_jobs"), F.col("rest").alias("direct"), F.lit(0.0).alias("share"), F.lit(0).cast("long").alias("n_failed_jobs"))
    return row(shared).unionByName(row(lonely)).orderBy(F.desc("direct_su"), "sample_id")


def expected_files(samples: DataFrame, files: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """sample, pattern and state of every sample and pattern: ``Found`` and the first path, or ``Missing``.

    ``files`` has sample and path; a pattern is a glob (``*`` and ``?``) over the whole path. Samples without any file
    are all missing; null paths match nothing.
    """
    glob = lambda g: "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in g) + "$"
    hits = F.array_compact(F.array(*[F.when(F.col("path").rlike(glob(g)), n) for n, g in patterns.items()]))
    found = files.select("sample", "path", F.explode(hits).alias("pattern")).groupBy("sample", "pattern").agg(F.min("path").alias("first"))
    every = samples.select("sample").distinct().select("sample", F.explode(F.array(*map(F.lit, patterns))).alias("pattern"))
    t = every.join(found, ["sample", "pattern"], "left")
    return t.select("sample", "pattern", F.coalesce(F.concat(F.lit("Found "), "first"), F.lit("Missing")).alias("state"))


def file_matrix(states: DataFrame, patterns: list[str]) -> DataFrame:
    """One row a sample with a column for each pattern, and ``gaps``, how many are missing."""
    t = states.groupBy("sample").pivot("pattern", patterns).agg(F.first("state"))
    return t.withColumn("gaps", sum(((F.col(f"`{p}`") == "Missing").cast("int") for p in patterns), F.lit(0)))


def _bands(c: Column, bands: tuple[tuple[float, str], ...], last: str | None = None) -> Column:
    out = F.when(c.isNull(), F.lit(None))
    for below, name in bands:
        out = out.when(c < below, name)
    return out.otherwise(last) if last else out


def advice(jobs: DataFrame, spare: float = 1.5) -> DataFrame:
    """Bands of memory, CPU and wall-time efficiency and, where a request was too large, what to ask for next time.

    Memory is suggested in whole GB, wall time in hours, both with ``spare``. CPU isn't judged on GPU partitions.
    """
    mem, wall = F.col("mem_eff"), F.col("wall_eff")
    cpu = F.when(~F.col("job_partition").contains("gpu"), F.col("cpu_eff"))
    return jobs.withColumns({
        "mem_band": _bands(mem, ((10, "very low"), (50, "low"), (98, "good")), "very high"), "mem_suggest_gb": F.when(mem < 50, F.floor(F.col("rss_gb") * spare + 0.999)),
        "cpu_band": F.when(cpu <= 100, _bands(cpu, ((25, "low"), (50, "moderate"), (80, "good")), "very good")),
        "wall_band": _bands(wall, ((30, "very low"), (60, "low"), (80, "moderate"), (100, "good"))), "wall_suggest_h": F.when(wall < 80, F.regexp_replace(F.format_number(F.col("elapsed_s") / 3600 * spare, 2), ",", "").cast("double")),
    })


#: States of jobs that have ended.
FINISHED = r"^(COMPLETED|FAILED|CANCELLED|OUT_OF_MEM|TIMEOUT)"


def roll_up(steps: DataFrame) -> DataFrame:
    """One row a finished job: its own row and the largest memory of its steps.

    ``steps`` has jobid (``123``, ``123.batch``), state, alloc_cpus, ave_rss and ntasks. Cores are half the allocated
    CPUs, which stay as ``alloc_cpus`` for the efficiencies; memory is the largest ave_rss times ntasks, null where no row has it. Jobs without a row of their own go.
    """
    own = ~F.col("jobid").contains(".")
    t = steps.groupBy(F.split("jobid", r"\.")[0].alias("job_id")).agg(F.max(F.when(own, F.struct("state", "alloc_cpus"))).alias("p"), F.max(F.col("ave_rss") * F.coalesce("ntasks", F.lit(1))).alias("used_rss"))
    return t.select("job_id", "p.state", F.floor(F.col("p.alloc_cpus") / 2).alias("cores"), "p.alloc_cpus", "used_rss").filter(F.col("state").rlike(FINISHED))


def with_metadata(jobs: DataFrame, meta: DataFrame) -> DataFrame:
    """Jobs with process and tag of the first metadata row (by ord) of their identifier, ``UNKNOWN`` where there is none."""
    first = meta.groupBy("job_id").agg(F.min(F.struct("ord", "process", "tag")).alias("m")).select("job_id", "m.process", "m.tag")
    j = jobs.drop("process", "tag").join(first, "job_id", "left")
    return j.withColumns({c: F.coalesce(c, F.lit("UNKNOWN")) for c in ("process", "tag")})


def recompute_decision(state: DataFrame, unkeyed: str = "invalidate", stale: str = "rerun") -> DataFrame:
    """``decision`` for each earlier result: fresh, skip, continue, or why it can't be used or was adopted.

    ``state`` has present, stored_key, key, done, has_output and checkpoint. The keys are compared before completeness
    is looked at, so a finished but outdated result is never reused. ``stale='fail'`` gives ``refused-stale``.
    """
    if unkeyed not in ("invalidate", "adopt") or stale not in ("rerun", "archive", "fail"):
        raise ValueError(f"unknown policy {unkeyed!r} or {stale!r}")
    c = F.col
    whole = c("done") & c("has_output")
    none = ~c("present")
    old = F.coalesce("stored_key", F.lit("")) == ""
    adopted = F.when(whole, "adopted-unkeyed-skip").when(c("checkpoint"), "adopted-unkeyed-continue").otherwise("invalidated-unkeyed-fresh")
    return state.withColumn("decision", (
        F.when(none, "fresh").when(old, adopted if unkeyed == "adopt" else F.lit("invalidated-unkeyed-fresh"))
        .when(c("stored_key") != c("key"), "refused-stale" if stale == "fail" else "invalidated-stale-fresh")
        .when(whole, "skip").when(c("checkpoint"), "continue").otherwise("fresh")
    ))


def merge_versions(versions: DataFrame) -> DataFrame:
    """One version of each (grp, tool): that of the first file, files of the whole run before others, then by path."""
    late = F.when(F.element_at(F.split("path", "/"), -1).startswith("software_versions"), 0).otherwise(1)
    return versions.groupBy("grp", "tool").agg(F.min(F.struct(late.alias("late"), "path", "version"))["version"].alias("version"))


def copy_rules(path: Column, rules: list[str]) -> Column:
    """Whether a path is copied: the first of ``rules`` whose glob fits it says so (``+ glob``) or not (``- glob``); without any it is.

    In a glob ``**`` is anything, ``*`` anything but a slash and ``?`` one letter but a slash. It fits the whole path, or its end after a slash
    unless it begins with one, as in the copying tool.
    """
    out = None
    for rule in rules:
        sign, _, glob = rule.partition(" ")
        if sign not in ("+", "-") or not glob:
            raise ValueError(f"{rule!r} isn't '+ glob' or '- glob'")
        parts = re.split(r"(\*\*|\*|\?)", glob.lstrip("/"))
        body = "".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts)
        fits = path.rlike(f"^{body}$" if glob.startswith("/") else f"(^|/){body}$")
        out = F.when(fits, F.lit(sign == "+")) if out is None else out.when(fits, F.lit(sign == "+"))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def copy_audit(files: DataFrame, key: str = "sample", rules: list[str] | None = None) -> DataFrame:
    """Objects and bytes of both sides of a copy per sample, and whether they agree; ``rules`` (see ``copy_rules``) choose the files by their ``path``.

    A sample of which no file is chosen stays, with zeros.
    """
    if rules:
        files = files.withColumn("side", F.when(copy_rules(F.col("path"), rules), F.col("side")))
    part = lambda side: (F.count_if(F.col("side") == side).alias(f"{side}_objects"), F.coalesce(F.sum(F.when(F.col("side") == side, F.col("bytes"))), F.lit(0)).alias(f"{side}_bytes"))
    t = files.groupBy(key).agg(*part("local"), *part("remote"))
    yes = lambda c: F.when(c, "YES").otherwise("NO")
    return t.withColumns({"objects_match": yes(F.col("local_objects") == F.col("remote_objects")), "bytes_match": yes(F.col("local_bytes") == F.col("remote_bytes"))})


#: Options of resources, which don't change a result.
RESOURCES = ("-m", "-t", "--memory", "--num-cpu-threads")


def without_resources(args: str) -> str:
    """Arguments without those of ``RESOURCES`` and their values, one blank between words."""
    out, skip = [], False
    for word in args.split():
        if skip:
            skip = False
        elif word in RESOURCES:
            skip = True
        elif word.partition("=")[0] not in RESOURCES or "=" not in word:
            out.append(word)
    return " ".join(out)


def checkpoint_key(reads: DataFrame, version: str, args: str = "", key: str = "sample") -> DataFrame:
    """key and checkpoint_key: SHA-256 of the manifest of an assembly: version, arguments without resources, prefix, and names and sizes of its read files.

    ``reads`` has key, prefix, path and bytes. The manifest is the one text that finished assemblies were keyed with, so
    its lines are put together; an assembly has a few read files. Their order and folders don't matter. Null paths are left out.
    """
    line = F.concat(F.lit("read="), F.element_at(F.split("path", "/"), -1), F.lit("\t"), F.col("bytes").cast("string"))
    t = reads.groupBy(key, "prefix").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    head = F.array(F.lit(f"megahit_version={version}"), F.lit(f"args={without_resources(args)}"), F.concat(F.lit("out_prefix="), F.coalesce("prefix", F.lit(""))))
    return t.select(key, F.sha2(F.concat(F.array_join(F.concat(head, "lines"), "\n"), F.lit("\n")), 256).alias("checkpoint_key"))


def fingerprint(files: DataFrame, key: str = "sample", version: str = "1", args: str = "", buckets: int = 256) -> DataFrame:
    """key and fingerprint: SHA-256 over version, arguments and all names and sizes of a sample's files, for any number of files.

    A digest of digests: each file's line is hashed, the hashes of a bucket (by the first byte of the hash) are added up by
    halves, with their number, and the buckets in order give the fingerprint. So order and partitioning don't matter, sums are made before the
    shuffle and no group is one string; repeated lines count. 8 words of 32 bits of each hash are summed apart, so a
    bucket's sum is as hard to meet by chance as the hash.
    """
    line = F.sha2(F.concat_ws("\t", F.lit(version), "component", F.col("event_id").cast("string"), F.col("bytes").cast("string")), 256)
    t = files.select(key, line.alias("h")).withColumn("b", F.conv(F.substr("h", F.lit(1), F.lit(4)), 16, 10).cast("int") % buckets)
    words = [F.sum(F.conv(F.substr("h", F.lit(1 + 8 * k), F.lit(8)), 16, 10).cast("decimal(20,0)")).alias(f"w{k}") for k in range(8)]
    t = t.groupBy(key, "b").agg(F.count("*").alias("n"), *words)
    one = F.concat_ws(":", F.lpad(F.col("b").cast("string"), 8, "0"), F.col("n").cast("string"), *[F.col(f"w{k}").cast("string") for k in range(8)])
    each = t.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(one)), "\n").alias("x"))
    return each.select(key, F.sha2(F.concat(F.lit(f"{version}\n{without_resources(args)}\n"), "x"), 256).alias("fingerprint"))


def raw_audit(local: DataFrame, remote: DataFrame, key: str = "og_id") -> DataFrame:
    """key, files and bytes of both sides (``files``, ``bytes``; null where a side lacks the key) and whether they agree."""
    side = lambda df, n: df.groupBy(key).agg(F.sum("files").alias(f"{n}_files"), F.sum("bytes").alias(f"{n}_bytes"))
    j = side(local, "local").join(side(remote, "remote"), key, "full")
    return j.withColumn("agrees", F.coalesce((F.col("local_files") == F.col("remote_files")) & (F.col("local_bytes") == F.col("remote_bytes")), F.lit(False)))
