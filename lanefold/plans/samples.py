"""Queries on the files, names, reference sets and stored rows of samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanefold.operators import contigs as C
from lanefold.operators import samples as P
from lanefold.operators import store as S
from lanefold.operators import taxonomy as X
from lanefold.plans.audits import _GRAMS
from lanefold.plans.registry import query
from lanefold.sources.adapters import domain, with_domain

_ROLES = """roles AS (SELECT path, split_part(name, '.', 1) AS og_id, CASE WHEN contains(name, '.R1.') OR contains(name, '_R1.') THEN 'R1' WHEN contains(name, '.R2.') OR contains(name, '_R2.') THEN 'R2'
  WHEN list_contains(string_split(replace(name, '.', '_'), '_'), 'R1') THEN 'R1' WHEN list_contains(string_split(replace(name, '.', '_'), '_'), 'R2') THEN 'R2' END AS role
  FROM (SELECT path, replace(path, '/in/', '') AS name FROM fastq_files) n WHERE suffix(name, '.fq') OR suffix(name, '.fastq') OR suffix(name, '.fq.gz') OR suffix(name, '.fastq.gz')),
mates AS (SELECT og_id, min(path) FILTER (role = 'R1') AS r1, min(path) FILTER (role = 'R2') AS r2 FROM roles WHERE role IS NOT NULL GROUP BY og_id)"""


@query(with_domain("fastq_files", f"WITH {_ROLES} SELECT * FROM mates WHERE r1 IS NOT NULL AND r2 IS NOT NULL"))
def a1_discover_pairs(spark, sf_dir):
    return P.discover_pairs(domain(spark, sf_dir, "fastq_files"))[0]


@query(with_domain("fastq_files", f"WITH {_ROLES} SELECT og_id, CASE WHEN r1 IS NULL THEN 'missing R1' ELSE 'missing R2' END AS reason FROM mates WHERE r1 IS NULL OR r2 IS NULL"))
def a1_incomplete_pairs(spark, sf_dir):
    return P.discover_pairs(domain(spark, sf_dir, "fastq_files"))[1]


@query(with_domain("fastq_files", """SELECT split_part(replace(path, '/in/', ''), '.', 1) AS og_id, string_agg(path, ';' ORDER BY path) AS paths FROM fastq_files
WHERE split_part(replace(path, '/in/', ''), '.', 1) IN (SELECT 'OG' || c_custkey FROM customer WHERE c_custkey % 2 = 0) GROUP BY ALL"""))
def a4_group_lanes(spark, sf_dir):
    sheet = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_custkey % 2 = 0").select(F.concat(F.lit("OG"), F.col("c_custkey").cast("string")).alias("og_id"))
    return P.group_lanes(domain(spark, sf_dir, "fastq_files"), sheet).withColumn("paths", F.array_join("paths", ";"))


_KINDS = ("archaea", "bacteria", "organelle", "mitochondrion", "plastid", "prokarya")
_WORDS = "words AS (SELECT *, string_split_regex(line, '[ \\t=]') AS w FROM classes)"


@query(with_domain("classes", f"""WITH {_WORDS}, k AS (SELECT unnest({list(_KINDS)}) AS category, unnest(range(6)) AS ord), s AS (SELECT DISTINCT sample FROM classes)
SELECT s.sample, k.ord, k.category, count(w) AS num_contigs, coalesce(sum(w[3]::BIGINT), 0)::BIGINT AS bp FROM s CROSS JOIN k LEFT JOIN words ON words.sample = s.sample AND list_contains(w, k.category) GROUP BY ALL"""))
def e6_domain_summary(spark, sf_dir):
    return C.domain_summary(domain(spark, sf_dir, "classes"))


@query(with_domain("classes", f"WITH {_WORDS} SELECT DISTINCT sample, w[1] AS contig FROM words WHERE list_has_any(w, {list(_KINDS)})"))
def e7_domain_removal(spark, sf_dir):
    return C.domain_removal(domain(spark, sf_dir, "classes"))


@query(with_domain("asked", r"""WITH w AS (SELECT id, string_split_regex(trim(raw), '\s+') AS w FROM asked)
SELECT id, CASE WHEN len(w) > 1 AND regexp_full_match(w[2], '[A-Za-z]+') AND lower(w[2]) NOT IN ('sp', 'spp', 'cf', 'aff', 'nr') THEN w[1] || ' ' || w[2] || '|' || w[1] ELSE w[1] END AS forms FROM w"""))
def i2_candidates(spark, sf_dir):
    return domain(spark, sf_dir, "asked").select("id", F.array_join(X.candidates(F.col("raw")), "|").alias("forms"))


@query("""SELECT s_suppkey AS id, s_name AS matched_name, 1000 + s_suppkey AS taxid, r_name AS class_name, n_name AS order_name, s_name AS family_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
UNION ALL SELECT -1 - n_nationkey, n_name, 100 + n_nationkey, r_name, n_name, NULL FROM nation JOIN region ON r_regionkey = n_regionkey WHERE lower(n_name) NOT IN (SELECT lower(p_name) FROM part)""")
def i7_lineage_for_name(spark, sf_dir):
    nodes = domain(spark, sf_dir, "tax_nodes")
    s, n = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "nation"))
    more = F.when(F.col("s_suppkey") % 3 == 0, " sp.").when(F.col("s_suppkey") % 3 == 1, " alba").otherwise("")
    names = s.select(F.col("s_suppkey").alias("id"), F.concat(F.col("s_name"), more).alias("name")).unionByName(n.select((-1 - F.col("n_nationkey")).alias("id"), F.upper("n_name").alias("name")))
    t = X.lineage_for_name(names, X.name_index(nodes), X.lineage_of(nodes))
    return t.withColumn("matched_name", F.when(F.col("id") < 0, F.col("order_name")).otherwise(F.col("matched_name")))


_ROW = "c.taxid, c.class, c.species"
_NEAR = lambda c: f"""SELECT a.id, {{p}}, len(list_intersect(q.g, k.g)) / len(list_distinct(list_concat(q.g, k.g))) AS sim, {_ROW} FROM asked a JOIN gq q ON q.name = a.clean CROSS JOIN gk k JOIN curated c ON c.{c} = k.name
  WHERE len(list_intersect(q.g, k.g)) / len(list_distinct(list_concat(q.g, k.g))) >= 0.65"""  # noqa: E731


@query(with_domain("asked curated", f"""WITH gq AS (SELECT name, {_GRAMS} AS g FROM (SELECT DISTINCT clean AS name FROM asked) x), gk AS (SELECT name, {_GRAMS} AS g FROM (SELECT family AS name FROM curated UNION SELECT order_name FROM curated) x),
syn AS (SELECT *, unnest(string_split(synonym, ',')) AS one FROM curated),
m AS (SELECT a.id, 1 AS p, 1.0::DOUBLE AS sim, {_ROW} FROM asked a JOIN curated c ON lower(c.species) = lower(a.raw) UNION ALL SELECT a.id, 2, 1.0, {_ROW} FROM asked a JOIN syn c ON lower(trim(c.one)) = lower(a.raw)
  UNION ALL SELECT a.id, 3, 1.0, {_ROW} FROM asked a JOIN curated c ON lower(c.genus) = lower(a.genus) UNION ALL SELECT a.id, 4, 1.0, {_ROW} FROM asked a JOIN curated c ON lower(c.family) = lower(a.raw)
  UNION ALL SELECT a.id, 5, 1.0, {_ROW} FROM asked a JOIN curated c ON lower(c.order_name) = lower(a.raw) UNION ALL {_NEAR("family").format(p=6)} UNION ALL {_NEAR("order_name").format(p=7)})
SELECT id, taxid, class, species, ['species_exact', 'synonym_exact', 'genus_exact', 'family_exact', 'order_exact', 'family_fuzzy', 'order_fuzzy'][p] AS match_level
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p, sim DESC, taxid NULLS LAST, species, class) AS n FROM m) x WHERE n = 1"""))
def i8_curated_match(spark, sf_dir):
    return X.curated_match(domain(spark, sf_dir, "asked"), domain(spark, sf_dir, "curated"))


@query(with_domain("fits", """SELECT sample, array_to_string(list_filter([CASE WHEN size_max IS NULL THEN 'size_max' END, CASE WHEN het_max IS NULL THEN 'het_max' END, CASE WHEN sample % 10 = 0 THEN 'class' END], lambda x: x IS NOT NULL), ', ') AS missing
FROM fits WHERE size_max IS NULL OR het_max IS NULL OR sample % 10 = 0"""))
def i13_unresolved(spark, sf_dir):
    t = domain(spark, sf_dir, "fits").withColumn("class", F.when(F.col("sample") % 10 == 0, "Unknown").otherwise("Aves"))
    return P.unresolved(t, ("size_max", "het_max", "class"))


_CLASSES = ("Teleostei", "Aves", "Copepoda", "Anthozoa", "Symphyla", "Insecta", "unknown")
_SETS = {"actinopterygii": "/db/actinopterygii_odb12", "vertebrata": "/db/vertebrata_odb12", "crustacea": "/db/crustacea_odb12", "arthropoda": "/db/arthropoda_odb12/"}


@query(with_domain("fits", f"""WITH p AS (SELECT sample, {list(_CLASSES)}[sample % 7 + 1] AS class, ['acti', 'vert', 'crus', 'meta', 'arth', 'meta', NULL][sample % 7 + 1] AS tag FROM fits) SELECT * FROM p"""))
def i14_lineage_tag(spark, sf_dir):
    t = domain(spark, sf_dir, "fits").select("sample", F.get(F.array(*[F.lit(c) for c in _CLASSES]), (F.col("sample") % 7).cast("int")).alias("class"))
    return t.withColumn("tag", P.lineage_tag(P.lineage_set(F.col("class"), _SETS, "/db/metazoa_odb12")))


@query(with_domain("components", """WITH w AS (SELECT o.og_id, s.seq_date, c.component, c.component = 'signup' AS optional FROM (SELECT DISTINCT og_id FROM components) o, (SELECT DISTINCT seq_date FROM components) s, (SELECT DISTINCT component FROM components) c),
c1 AS (SELECT *, component = 'purchase' AND contains(name, '_reseeded_') AS pref FROM components WHERE component <> 'error' OR contains(name, '.error.meta.')),
c2 AS (SELECT * FROM (SELECT *, bool_or(pref) OVER (PARTITION BY og_id, component) AS any_pref FROM c1) x WHERE pref OR NOT any_pref),
g AS (SELECT w.og_id, w.seq_date, w.component, w.optional, count(*) FILTER (c2.parsed) AS n, count(*) FILTER (NOT c2.parsed) AS bad, min(c2.name) FILTER (c2.parsed) AS name FROM w LEFT JOIN c2 USING (og_id, seq_date, component) GROUP BY ALL)
SELECT og_id, seq_date, component, CASE WHEN n = 1 AND bad = 0 THEN 'matched' WHEN n > 1 THEN 'ambiguous' WHEN bad > 0 THEN 'malformed' WHEN optional THEN 'optional' ELSE 'missing' END AS outcome, CASE WHEN n = 1 AND bad = 0 THEN name END AS name FROM g"""))
def j1_select_components(spark, sf_dir):
    t = domain(spark, sf_dir, "components")
    wanted = t.select("og_id").distinct().crossJoin(F.broadcast(t.select("seq_date").distinct())).crossJoin(F.broadcast(t.select("component").distinct()))
    return P.select_components(wanted.withColumn("optional", F.col("component") == "signup"), t, {"purchase": "_reseeded_"}, "meta", "error")


@query(with_domain("fits", """SELECT sample, CASE WHEN sample % 2 = 0 THEN CASE WHEN sample % 4 = 0 THEN NULL ELSE bias END ELSE kmercov END AS kmercov, coalesce(CASE WHEN sample % 2 = 0 THEN lam END, CASE WHEN sample % 3 = 0 THEN -1.0::DOUBLE END) AS lam, fit_all FROM fits"""))
def j2_overlay(spark, sf_dir):
    t, s = domain(spark, sf_dir, "fits"), F.col("sample")
    verdicts = t.filter(s % 2 == 0).select("sample", F.when(s % 4 != 0, F.col("bias")).alias("kmercov"), "lam")
    return S.overlay(t.select("sample", "kmercov", "fit_all"), verdicts, t.filter(s % 3 == 0).select("sample", F.lit(-1.0).alias("lam")), ["sample"])


@query(with_domain("components", "SELECT og_id, count(*) AS identities FROM (SELECT DISTINCT og_id, seq_date FROM components) x GROUP BY og_id HAVING count(*) > 1"))
def j3_mixed_identities(spark, sf_dir):
    return S.mixed_identities(domain(spark, sf_dir, "components"), "og_id", ["seq_date"]).withColumn("identities", F.col("identities").cast("bigint"))


@query(with_domain("drafts sequencing", """WITH j AS (SELECT d.og_id, d.seq_date, s.sequencing_id, coalesce(technology, '?') || ' ' || coalesce(library_type, '?') AS what,
  coalesce(technology = 'Illumina' AND library_type = 'illumina' AND instrument = CASE mach WHEN 'NOVA' THEN 'NovaSeq' WHEN 'NEXT' THEN 'NextSeq' END, false) AS fits FROM drafts d LEFT JOIN sequencing s ON s.og_id = d.og_id AND s.seq_date = d.seq_date),
g AS (SELECT og_id, seq_date, coalesce(array_to_string(list_sort(list(DISTINCT sequencing_id) FILTER (fits)), ', '), '') AS runs, coalesce(array_to_string(list_sort(list(DISTINCT what) FILTER (sequencing_id IS NOT NULL)), ', '), '') AS others FROM j GROUP BY ALL)
SELECT *, CASE WHEN runs <> '' THEN 'linked' WHEN others = '' THEN 'pending' ELSE 'refused' END AS outcome FROM g"""))
def j6_run_links(spark, sf_dir):
    return P.run_links(domain(spark, sf_dir, "drafts"), domain(spark, sf_dir, "sequencing"), {"NOVA": "NovaSeq", "NEXT": "NextSeq"})


@query(with_domain("fits", """SELECT count(*) AS samples, count(*) FILTER (sample % 5 <> 0) AS valid, count(*) FILTER (sample % 5 = 0) AS invalid, count(*) FILTER (sample % 5 <> 0 AND sample % 7 <> 0) AS verified,
count(*) FILTER (sample % 5 <> 0 AND sample % 7 = 0) AS mismatched, count(*) FILTER (sample % 5 <> 0 AND sample % 7 = 0) = 0 AS safe_to_rerun FROM fits"""))
def j8_backfill_summary(spark, sf_dir):
    s = F.col("sample")
    return S.backfill_summary(domain(spark, sf_dir, "fits").select("sample", (s % 5 != 0).alias("valid"), F.when(s % 7 == 0, 2).otherwise(0).alias("mismatches")))


@query(with_domain("fits", "SELECT DISTINCT sample FROM fits WHERE sample % 5 = 0 OR peak_cov IS NULL OR peak_cov % 4 = 0"))
def j8_safe_to_rerun(spark, sf_dir):
    t = domain(spark, sf_dir, "fits").select("sample", (F.col("sample") % 5 != 0).alias("valid"), (F.col("peak_cov") % 4 != 0).alias("committed"))
    return S.safe_to_rerun(t, ["sample"])


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS bal, c_mktsegment AS segment FROM customer WHERE c_custkey % 4 <> 0""")
def j9_partial_upsert(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment"))
    return S.partial_upsert(c.filter("k % 4 <> 0"), c.filter("k % 3 = 0").select("k", (F.col("bal") + 1).alias("bal")), ["k"], ["bal"])[0]
