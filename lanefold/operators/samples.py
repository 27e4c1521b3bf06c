"""Samples: which files belong to which, which reference set they need, and what keeps one from being used."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Taxonomic classes by the reference set that scores them; narrower sets come first.
LINEAGES = {
    "actinopterygii": ("Actinopteri", "Actinopterygii", "Teleostei"),
    "vertebrata": (
        "Chondrichthyes", "Elasmobranchii", "Holocephali", "Mammalia", "Aves", "Reptilia", "Crocodylia", "Amphibia", "Myxini", "Hyperoartia",
        "Petromyzonti", "Coelacanthimorpha", "Coelacanthi", "Dipneusti", "Lepidosauria", "Testudines",
    ),
    "crustacea": ("Malacostraca", "Thecostraca", "Branchiopoda", "Copepoda", "Ostracoda", "Maxillopoda"),
    "mollusca": ("Gastropoda", "Bivalvia", "Polyplacophora", "Cephalopoda", "Scaphopoda", "Monoplacophora"),
    "anthozoa": ("Anthozoa",),
    "arthropoda": ("Pycnogonida", "Merostomata", "Chilopoda", "Diplopoda", "Symphyla", "Pauropoda"),
}
#: Sets that always exist; the others fall back to the widest one where they have no path.
REQUIRED = ("actinopterygii", "vertebrata")


def read_role(name: Column) -> Column:
    """``R1`` or ``R2`` from a file name: before a dot or at the end first, else as a token anywhere; else null."""
    closing = lambda r: F.when(name.rlike(rf"[._]{r}(\.|$)"), r)
    token = lambda r: F.when(name.rlike(rf"(^|[._]){r}([._]|$)"), r)
    return F.coalesce(closing("R1"), closing("R2"), token("R1"), token("R2"))


def discover_pairs(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(og_id, r1, r2) of samples with both mates, and (og_id, reason) of the others, from ``path``.

    Only names ending in fastq or fq count, packed or not; the first path of a role in order wins. Files without a
    role are left out; a null path is no file.
    """
    name = F.element_at(F.split("path", "/"), -1)
    t = files.select("path", name.alias("name")).filter(F.col("name").rlike(r"\.(fastq|fq)(\.gz)?$"))
    t = t.select(F.split("name", r"\.")[0].alias("og_id"), "path", read_role(F.col("name")).alias("role")).filter("role is not null")
    first = lambda r: F.min(F.when(F.col("role") == r, F.col("path"))).alias(r.lower())
    by = t.groupBy("og_id").agg(first("R1"), first("R2"))
    whole = F.col("r1").isNotNull() & F.col("r2").isNotNull()
    return by.filter(whole), by.filter(~whole).select("og_id", F.when(F.col("r1").isNull(), "missing R1").otherwise("missing R2").alias("reason"))


def group_lanes(files: DataFrame, sheet: DataFrame | None = None) -> DataFrame:
    """og_id and its sorted paths; the identifier is the upper-case letters and digits a name starts with.

    Names that don't start so are left out, as are identifiers that ``sheet`` (og_id) doesn't list.
    """
    t = files.select(F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^([A-Z]+\d+)", 1).alias("og_id"), "path").filter("og_id <> ''")
    if sheet is not None:
        t = t.join(sheet.select("og_id"), "og_id", "left_semi")
    return t.groupBy("og_id").agg(F.array_sort(F.collect_list("path")).alias("paths"))


def unresolved(samples: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """sample and the comma-joined names of its fields that are null, empty or ``unknown``; none: no row."""
    absent = lambda c: F.when(F.coalesce(F.lower(F.trim(F.col(c).cast("string"))), F.lit("")).isin("", "unknown"), c)
    t = samples.select("sample", F.array_compact(F.array(*[absent(c) for c in fields])).alias("f"))
    return t.filter(F.size("f") > 0).select("sample", F.array_join("f", ", ").alias("missing"))


def lineage_set(class_name: Column, paths: dict[str, str], widest: str) -> Column:
    """The reference set of a taxonomic class; null where the class is unknown.

    ``paths`` has the sets that exist. A class of an optional set that doesn't, or of none, gets the widest one.
    """
    missing = [s for s in REQUIRED if s not in paths]
    if missing:
        raise ValueError(f"no path of the sets {missing}")
    known = class_name.isNotNull() & ~F.lower(class_name).isin("", "unknown")
    chain = reduce(lambda acc, s: acc.when(class_name.isin(*LINEAGES[s]), F.lit(paths[s])), [s for s in LINEAGES if s in paths], F.when(~known, F.lit(None)))
    return chain.when(known, F.lit(widest))


def lineage_tag(path: Column) -> Column:
    """The first four letters of the last part of a set's path, as its result files carry them."""
    return F.substring(F.element_at(F.filter(F.split(path, "/"), lambda p: p != ""), -1), 1, 4)


def select_components(wanted: DataFrame, candidates: DataFrame, preferred: dict[str, str], tag: str | None = None, tagged: str = "busco") -> DataFrame:
    """og_id, seq_date, component, outcome and name of the one file each wanted component takes.

    ``wanted`` has og_id, seq_date, component and optional; ``candidates`` og_id, component, name, seq_date and parsed.
    A component's preferred marker, where any name of the sample has it, leaves only such names; with ``tag`` the
    tagged component takes names with ``.component.tag.`` only. Outcomes: matched; ambiguous (several); malformed (a
    candidate of this identity didn't parse); optional or missing (none).
    """
    mark = F.create_map(*[F.lit(x) for pair in preferred.items() for x in pair])[F.col("component")] if preferred else F.lit(None).cast("string")
    c = candidates.withColumn("_pref", F.coalesce(F.contains("name", mark), F.lit(False)))
    if tag is not None:
        c = c.filter((F.col("component") != tagged) | F.contains("name", F.lit(f".{tagged}.{tag}.")))
    has = c.groupBy("og_id", "component").agg(F.max("_pref").alias("_any"))
    c = c.join(has, ["og_id", "component"]).filter(~F.col("_any") | F.col("_pref"))
    got = c.groupBy("og_id", "seq_date", "component").agg(F.count_if("parsed").alias("_n"), F.count_if(~F.col("parsed")).alias("_bad"), F.min(F.when(F.col("parsed"), F.col("name"))).alias("_name"))
    t = wanted.join(got, ["og_id", "seq_date", "component"], "left")
    n, bad = F.coalesce("_n", F.lit(0)), F.coalesce("_bad", F.lit(0))
    outcome = F.when((n == 1) & (bad == 0), "matched").when(n > 1, "ambiguous").when(bad > 0, "malformed").when(F.col("optional"), "optional").otherwise("missing")
    t = t.withColumn("outcome", outcome)
    return t.select("og_id", "seq_date", "component", "outcome", F.when(F.col("outcome") == "matched", F.col("_name")).alias("name"))


def run_links(drafts: DataFrame, sequencing: DataFrame, instruments: dict[str, str]) -> DataFrame:
    """og_id, seq_date, outcome, runs (linked, sorted identifiers) and others of each draft.

    A draft (og_id, seq_date, mach) is linked to Illumina DNA libraries of its day on the instrument that its machine
    code names. Without one it is ``pending`` if the day has no sequencing at all, else ``refused`` with the
    technologies and libraries that are there.
    """
    inst = F.create_map(*[F.lit(x) for pair in instruments.items() for x in pair])[F.col("mach")]
    s = sequencing.select("og_id", "seq_date", "sequencing_id", "technology", "library_type", "instrument")
    j = drafts.select("og_id", "seq_date", inst.alias("_want")).join(s, ["og_id", "seq_date"], "left")
    fits = (F.col("technology") == "Illumina") & (F.col("library_type") == "illumina") & (F.col("instrument") == F.col("_want"))
    what = F.concat_ws(" ", F.coalesce("technology", F.lit("?")), F.coalesce("library_type", F.lit("?")))
    t = j.groupBy("og_id", "seq_date").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(fits, F.col("sequencing_id")))).cast("array<string>"), ", ").alias("runs"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("sequencing_id").isNotNull(), what))), ", ").alias("others"),
    )
    return t.withColumn("outcome", F.when(F.col("runs") != "", "linked").when(F.col("others") == "", "pending").otherwise("refused"))


#: Tiers of a curated match that name the sample's own species, and those that are near misses.
EXACT_LEVELS = ("species_exact", "synonym_exact")
FUZZY_LEVELS = ("family_fuzzy", "order_fuzzy")


def resolve(samples: DataFrame) -> DataFrame:
    """``samples`` with taxid, class, source and rank_used in place of what the curated table and the taxonomy say.

    Needs match_level, db_taxid, db_class (curated; null without a match) and tax_taxid, tax_class, tax_rank (all null
    without one). An exact match with both values stands alone. Otherwise the curated class stays, unless the match
    is fuzzy and the taxonomy knows the name, and the taxid is the taxonomy's where it has one, since a relative's
    number isn't the sample's. ``source`` is db, db+taxdump, taxdump or unresolved.
    """
    level, has = F.coalesce("match_level", F.lit("")), F.coalesce("tax_taxid", "tax_class", "tax_rank").isNotNull()
    exact = level.isin(*EXACT_LEVELS)
    db_class = F.nullif("db_class", F.lit(""))
    alone = exact & F.col("db_taxid").isNotNull() & db_class.isNotNull()
    trusted = (level != "") & ~(level.isin(*FUZZY_LEVELS) & has)
    own = exact & F.col("db_taxid").isNotNull()
    taxid = F.when(trusted & own, F.col("db_taxid")).when(trusted, F.coalesce("tax_taxid", "db_taxid")).otherwise(F.col("tax_taxid"))
    class_ = F.when(trusted, F.coalesce(db_class, F.nullif("tax_class", F.lit("")))).otherwise(F.nullif("tax_class", F.lit("")))
    used = F.when(alone, False).when(trusted, (db_class.isNull() & F.coalesce(F.col("tax_class") != "", F.lit(False))) | (~own & F.col("tax_taxid").isNotNull())).otherwise(has)
    source = F.when(taxid.isNull() | class_.isNull(), "unresolved").when(trusted & used, "db+taxdump").when(trusted, "db").otherwise("taxdump")
    t = samples.select("*", taxid.alias("_t"), class_.alias("_c"), source.alias("_s"), F.when(used, F.coalesce("tax_rank", F.lit(""))).otherwise("").alias("_r"))
    kept = [c for c in samples.columns if c not in ("db_taxid", "db_class", "tax_taxid", "tax_class", "tax_rank", "taxid", "class", "source", "rank_used")]
    return t.select(*kept, F.col("_t").alias("taxid"), F.col("_c").alias("class"), F.col("_s").alias("source"), F.col("_r").alias("rank_used"))


def build_sheet(pairs: DataFrame, resolved: DataFrame, run: str) -> DataFrame:
    """One sheet row for each pair of files (og_id, r1, r2); what isn't resolved is ``unknown``. The date is the second part of ``run``."""
    date = run.split("_")[1] if run.count("_") else ""
    r = resolved.select("og_id", "nominal_species_id", F.col("taxid").cast("string").alias("taxid"), "class")
    known = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown"))
    return pairs.join(r, "og_id", "left").select(
        F.col("og_id").alias("sample"), F.lit(run).alias("run"), F.lit(date).alias("date"), F.concat("og_id", F.lit(f".ilmn.{date}")).alias("prefix"),
        known("nominal_species_id").alias("nom_species_id"), known("taxid").alias("taxon_id"), known("class").alias("class"), F.col("r1").alias("fastq_1"), F.col("r2").alias("fastq_2"),
    )


def split_batch(wanted: DataFrame, files: DataFrame, first: tuple[str, ...], one: tuple[str, ...], status: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``wanted`` (og_id, seq_date) with a path for every component, and the others with the reason they are skipped.

    ``files`` has og_id, seq_date, component and path. A component of ``one`` must have exactly one distinct path, one of ``first`` takes
    the smallest. ``status`` (og_id, seq_date, status) must be ``ok`` for a row that has all.
    """
    keys = ["og_id", "seq_date"]
    path = lambda c: F.when(F.col("component") == c, F.col("path"))
    got = [F.when(F.lit(c in first) | (F.count_distinct(path(c)) == 1), F.min(path(c))).alias(c) for c in (*one, *first)]
    t = wanted.select(*keys).join(files.groupBy(*keys).agg(*got), keys, "left")
    t = t.join(status.groupBy(*keys).agg(F.min(F.coalesce(F.col("status") == "ok", F.lit(False))).alias("_ok")), keys, "left")
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in (*one, *first)]))
    reason = F.when(F.size(absent) > 0, F.concat(F.lit("missing or ambiguous: "), F.array_join(absent, " "))).when(~F.coalesce("_ok", F.lit(False)), "depth status is not ok")
    t = t.withColumn("reason", reason)
    return t.filter("reason is null").select(*keys, *one, *first), t.filter("reason is not null").select(*keys, "reason")


def bundle(files: DataFrame, samples: DataFrame, shared: list[str]) -> DataFrame:
    """sample and its sorted files with the ``shared`` ones behind; files of unknown samples and samples without files are left out."""
    own = files.join(samples.select("sample").distinct(), "sample", "left_semi").groupBy("sample").agg(F.array_sort(F.collect_list("path")).alias("own"))
    return own.select("sample", F.concat("own", F.array(*map(F.lit, shared)).cast("array<string>")).alias("files"))


def collapse_parameters(rows: DataFrame, order: dict[str, int], run: str = "") -> DataFrame:
    """position, tool, params, notes and samples: equal rows counted once samples and run are replaced by placeholders.

    Tools stand by ``order`` (others at 999) and then by name.
    """

    def hide(c: str) -> Column:
        without = F.regexp_replace(F.coalesce(c, F.lit("")), "OG[0-9]+", "<sample>")
        return F.replace(without, F.lit(run), F.lit("<run>")) if run else without

    t = rows.groupBy("tool", hide("params").alias("params"), hide("notes").alias("notes")).agg(F.count("*").alias("samples"))
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])[F.col("tool")] if order else F.lit(None).cast("int")
    return t.select(F.coalesce(rank, F.lit(999)).alias("position"), "tool", "params", "notes", "samples").orderBy("position", F.lower("tool"), "params", "notes")
