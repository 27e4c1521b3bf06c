"""Queries on taxonomy, the statistics store, files and job accounting."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanefold.operators import accounting as A
from lanefold.operators import store as S
from lanefold.operators import taxonomy as X
from lanefold.operators.snapshots import Snapshots
from lanefold.plans.registry import query
from lanefold.plans.scratch import scratch
from lanefold.sources.adapters import domain, with_domain
from lanefold.sources.tables import ACCOUNTING, job_accounting, read_curated

_CLOSED = "closed AS (WITH RECURSIVE c AS (SELECT taxid, taxid AS ancestor, 0 AS depth FROM tax_nodes UNION ALL SELECT c.taxid, t.parent, c.depth + 1 FROM c JOIN tax_nodes t ON t.taxid = c.ancestor JOIN tax_nodes p ON p.taxid = t.parent) SELECT * FROM c)"


@query(r"""WITH n AS (SELECT p_partkey AS id, concat(CASE p_partkey % 4 WHEN 0 THEN '"' ELSE '' END, p_name, CASE p_partkey % 5 WHEN 0 THEN ' cf. (TBC)' WHEN 1 THEN ' sp.' ELSE ' 7x' END) AS name FROM part),
c AS (SELECT id, regexp_replace(regexp_replace(name, '\([^)]*\)|`[^`]*`|["'']', ' ', 'g'), '(?i)\b(spp?|cf|aff|nr|TBC)\b\.?', ' ', 'g') AS t FROM n)
SELECT id, array_to_string(list_slice(list_filter(list_transform(string_split_regex(trim(t), '\s+'), lambda w: regexp_replace(w, '^[^A-Za-z]+|[^A-Za-z]+$', '', 'g')), lambda w: w <> ''), 1, 2), ' ') AS species FROM c""")
def i1_clean_species(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    k = F.col("p_partkey")
    name = F.concat(F.when(k % 4 == 0, '"').otherwise(""), "p_name", F.when(k % 5 == 0, " cf. (TBC)").when(k % 5 == 1, " sp.").otherwise(" 7x"))
    return p.select(k.alias("id"), X.clean_species(name).alias("species"))


@query(with_domain("tax_nodes", f"WITH {_CLOSED} SELECT * FROM closed"))
def i3_closure(spark, sf_dir):
    return X.closure(domain(spark, sf_dir, "tax_nodes"))


@query(with_domain("tax_nodes", f"""WITH {_CLOSED}, n AS (SELECT ancestor AS taxid, count(*) AS size FROM closed GROUP BY ancestor), d AS (SELECT taxid, max(depth) AS level FROM closed GROUP BY taxid)
SELECT n.taxid, d.level::BIGINT AS level, n.size::BIGINT AS size FROM n JOIN d ON d.taxid = n.taxid"""))
def i3_tree_labels(spark, sf_dir):
    """Level and clade size of every taxon; the numbers that hold a clade together are tested against the closure."""
    return X.tree_labels(domain(spark, sf_dir, "tax_nodes")).select("taxid", "level", "size")


@query(with_domain("tax_nodes", f"WITH {_CLOSED} SELECT taxid FROM closed WHERE ancestor = 11"))
def i4_in_clade(spark, sf_dir):
    return X.clade_members(X.tree_labels(domain(spark, sf_dir, "tax_nodes")), [11])


@query(with_domain("tax_nodes", "SELECT lower(name) AS key, min(taxid) AS taxid FROM tax_nodes GROUP BY lower(name) HAVING count(DISTINCT taxid) = 1"))
def i5_name_index(spark, sf_dir):
    return X.name_index(domain(spark, sf_dir, "tax_nodes"))


@query(with_domain("tax_nodes", f"""WITH {_CLOSED}, up AS (SELECT c.taxid, c.depth, t.rank, t.name FROM closed c JOIN tax_nodes t ON t.taxid = c.ancestor)
SELECT taxid, arg_min(name, depth) FILTER (rank = 'class') AS class_name, arg_min(name, depth) FILTER (rank = 'order') AS order_name, arg_min(name, depth) FILTER (rank = 'family') AS family_name FROM up GROUP BY taxid"""))
def i6_lineage(spark, sf_dir):
    nodes = domain(spark, sf_dir, "tax_nodes")
    return X.lineage_of(nodes)


_GRAMS = r"(SELECT list_sort(list_distinct(flatten(list_transform(list_filter(string_split_regex(lower(name), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i::INT, 3)))))))"


@query(f"""WITH a AS (SELECT s_suppkey AS id, s_name AS name FROM supplier), b AS (SELECT c_custkey AS id, replace(c_name, 'Customer', 'Supplier') AS name FROM customer),
ga AS (SELECT id, {_GRAMS} AS g FROM a), gb AS (SELECT id, {_GRAMS} AS g FROM b),
s AS (SELECT ga.id AS left_id, gb.id AS right_id, len(list_intersect(ga.g, gb.g)) / len(list_distinct(list_concat(ga.g, gb.g))) AS similarity FROM ga, gb)
SELECT left_id, right_id, round(similarity, 9) AS similarity FROM s WHERE similarity >= 0.65""")
def i10_trigram_matches(spark, sf_dir):
    a = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    b = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("id"), F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("name"))
    return X.trigram_matches(a, b).withColumn("similarity", F.round("similarity", 9))


def _tables(spark, sf_dir, *names):
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


@query("""SELECT c.c_custkey AS k, coalesce(n.v, c.c_acctbal) AS v, c.c_mktsegment AS segment, n.orders FROM customer c
JOIN (SELECT o_custkey, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE round(sum(o_totalprice), 2) END AS v, count(*) AS orders FROM orders GROUP BY o_custkey) n ON n.o_custkey = c.c_custkey""")
def b5_keyed_join(spark, sf_dir):
    c, o = _tables(spark, sf_dir, "customer", "orders")
    left = c.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.col("c_mktsegment").alias("segment"))
    right = o.groupBy(F.col("o_custkey").alias("k")).agg(F.round(F.sum("o_totalprice"), 2).alias("v"), F.count("*").alias("orders")).withColumn("v", F.when(F.col("k") % 3 != 0, F.col("v")))
    return S.keyed_join(["k"], S.assert_unique(left, ["k"]), right)


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_totalprice DESC, o_orderkey) AS n FROM orders) x WHERE n = 1")
def b7_pick_one(spark, sf_dir):
    (o,) = _tables(spark, sf_dir, "orders")
    return S.pick_one(o, ["o_custkey"], F.when(F.col("o_orderstatus") == "F", 0).otherwise(1), F.col("o_totalprice").desc(), "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("""WITH have AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderkey % 3 = 0 GROUP BY o_custkey)
SELECT k, n FROM have UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_custkey NOT IN (SELECT k FROM have)""")
def b12_fill_missing(spark, sf_dir):
    c, o = _tables(spark, sf_dir, "customer", "orders")
    have = o.filter("o_orderkey % 3 = 0").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    return S.fill_missing(c.select(F.col("c_custkey").alias("k")), have, ["k"], lambda rest: rest.select("k", F.lit(-1).cast("long").alias("n")))


_STORED = "stored AS (SELECT c_custkey AS k, c_acctbal AS bal, c_mktsegment AS segment FROM customer WHERE c_custkey % 4 <> 0), newer AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal + 1 END AS bal FROM customer WHERE c_custkey % 3 <> 0)"


def _stored(spark, sf_dir):
    (c,) = _tables(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return (
        c.filter(k % 4 != 0).select(k.alias("k"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment")),
        c.filter(k % 3 != 0).select(k.alias("k"), F.when(k % 7 != 0, F.col("c_acctbal") + 1).alias("bal")),
    )


@query(f"WITH {_STORED} SELECT coalesce(s.k, n.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.bal ELSE s.bal END AS bal, s.segment FROM stored s FULL JOIN newer n ON n.k = s.k")
def j5_upsert(spark, sf_dir):
    return S.upsert(*_stored(spark, sf_dir), ["k"], ["bal"])


@query(f"""WITH {_STORED} SELECT coalesce(s.k, n.k) AS k, 'bal' AS field, s.bal AS expected, n.bal AS actual FROM stored s FULL JOIN newer n ON n.k = s.k
WHERE NOT (coalesce(abs(s.bal - n.bal) <= 0.005, false) OR (s.bal IS NULL AND n.bal IS NULL))""")
def j7_verify(spark, sf_dir):
    stored, new = _stored(spark, sf_dir)
    return S.verify(stored, new, ["k"], {"bal": 0.005})


@query(with_domain("jobs", """WITH t AS (SELECT job_id, CASE job_id % 3 WHEN 0 THEN concat(job_id % 4, '-', lpad((job_id % 24)::VARCHAR, 2, '0'), ':05:09') WHEN 1 THEN concat(job_id % 60, ':30.250') ELSE concat(job_id % 900, '.5') END AS d FROM jobs)
SELECT job_id, d AS duration, CASE job_id % 3 WHEN 0 THEN job_id % 4 * 86400.0::DOUBLE + job_id % 24 * 3600 + 309 WHEN 1 THEN job_id % 60 * 60 + 30.25::DOUBLE ELSE job_id % 900 + 0.5::DOUBLE END AS seconds FROM t"""))
def k1_duration(spark, sf_dir):
    j, s = F.col("job_id"), lambda c: c.cast("string")
    text = F.when(j % 3 == 0, F.concat(s(j % 4), F.lit("-"), F.lpad(s(j % 24), 2, "0"), F.lit(":05:09"))).when(j % 3 == 1, F.concat(s(j % 60), F.lit(":30.250"))).otherwise(F.concat(s(j % 900), F.lit(".5")))
    return domain(spark, sf_dir, "jobs").select("job_id", text.alias("duration")).withColumn("seconds", A.duration_seconds(F.col("duration")))


@query(with_domain("jobs", """SELECT job_id, CASE job_id % 3 WHEN 0 THEN concat(job_id % 5000, 'Kc') WHEN 1 THEN concat(job_id % 50, '.5G') ELSE concat(job_id % 4000, 'M') END AS memory,
round(CASE job_id % 3 WHEN 0 THEN (job_id % 5000) / 1048576.0::DOUBLE WHEN 1 THEN job_id % 50 + 0.5::DOUBLE ELSE (job_id % 4000) / 1024.0::DOUBLE END, 9) AS gb FROM jobs"""))
def k2_memory(spark, sf_dir):
    j, s = F.col("job_id"), lambda c: c.cast("string")
    text = F.when(j % 3 == 0, F.concat(s(j % 5000), F.lit("Kc"))).when(j % 3 == 1, F.concat(s(j % 50), F.lit(".5G"))).otherwise(F.concat(s(j % 4000), F.lit("M")))
    return domain(spark, sf_dir, "jobs").select("job_id", text.alias("memory")).withColumn("gb", F.round(A.memory_gb(F.col("memory")), 9))


@query(with_domain("jobs", """SELECT job_id, (job_id % 3) * 24 + job_id % 24 + floor(job_id % 60 * 10000 / 60.0) / 10000 + floor(job_id % 59 * 10000 / 3600.0) / 10000 AS hours,
CASE job_id % 4 WHEN 0 THEN (job_id % 5000) / 1048576.0::DOUBLE * cores WHEN 1 THEN (job_id % 50 + 0.5::DOUBLE) * nodes WHEN 2 THEN (job_id % 4000) / 1073741824.0::DOUBLE ELSE (job_id % 900) / 1024.0::DOUBLE END AS gb FROM jobs"""))
def k2_requests(spark, sf_dir):
    j, s, two = F.col("job_id"), lambda c: c.cast("string"), lambda c: F.lpad(c.cast("string"), 2, "0")
    took = F.concat(s(j % 3), F.lit("-"), two(j % 24), F.lit(":"), two(j % 60), F.lit(":"), two(j % 59))
    asked = F.when(j % 4 == 0, F.concat(s(j % 5000), F.lit("Kc"))).when(j % 4 == 1, F.concat(s(j % 50), F.lit(".5Gn"))).when(j % 4 == 2, F.concat(s(j % 4000), F.lit("B"))).otherwise(s(j % 900))
    t = domain(spark, sf_dir, "jobs")
    return t.select("job_id", A.duration_hours(took).alias("hours"), A.memory_gb(asked, "M", F.col("cores"), F.col("nodes")).alias("gb"))


_SU = """su AS (SELECT *, CASE WHEN contains(job_partition, 'gpu') THEN 512.0::DOUBLE WHEN contains(job_partition, 'copy') THEN 0 ELSE 128 END AS rate,
  round(cores / nodes / CASE WHEN contains(job_partition, 'gpu') THEN 8 WHEN contains(job_partition, 'copy') THEN 64 ELSE 128 END, 6) AS cs,
  round(least(mem_gb / nodes / CASE WHEN contains(job_partition, 'gpu') THEN 1e18 WHEN contains(job_partition, 'highmem') THEN 980 WHEN contains(job_partition, 'copy') THEN 115 ELSE 230 END, 1.0), 6) AS ms FROM jobs),
costed AS (SELECT *, round(rate * CASE WHEN contains(job_partition, 'gpu') THEN cs ELSE greatest(cs, ms) END * nodes * elapsed_s / 3600, 4) AS su,
  round(cpu_s * 100.0::DOUBLE / (cores * elapsed_s), 4) AS cpu_eff, round(least(rss_gb * 100.0::DOUBLE / mem_gb, 100.0), 4) AS mem_eff, round(elapsed_s * 100.0::DOUBLE / limit_s, 4) AS wall_eff FROM su)"""


def _costed(spark, sf_dir):
    return A.efficiencies(A.service_units(domain(spark, sf_dir, "jobs")))


@query(with_domain("jobs", f"WITH {_SU} SELECT job_id, cpu_eff, mem_eff, wall_eff FROM costed"))
def k4_efficiencies(spark, sf_dir):
    return _costed(spark, sf_dir).select("job_id", "cpu_eff", "mem_eff", "wall_eff")


@query(with_domain("jobs", f"WITH {_SU} SELECT job_id, su FROM costed"))
def k5_service_units(spark, sf_dir):
    return _costed(spark, sf_dir).select("job_id", "su")


@query(with_domain("jobs", f"""WITH {_SU} SELECT job_id, CASE WHEN mem_eff < 10 THEN 'very low' WHEN mem_eff < 50 THEN 'low' WHEN mem_eff < 98 THEN 'good' WHEN mem_eff IS NOT NULL THEN 'very high' END AS mem_band,
CASE WHEN mem_eff < 50 THEN floor(rss_gb * 1.5::DOUBLE + 0.999::DOUBLE)::BIGINT END AS mem_suggest_gb,
CASE WHEN contains(job_partition, 'gpu') OR cpu_eff > 100 THEN NULL WHEN cpu_eff < 25 THEN 'low' WHEN cpu_eff < 50 THEN 'moderate' WHEN cpu_eff < 80 THEN 'good' WHEN cpu_eff <= 100 THEN 'very good' END AS cpu_band,
CASE WHEN wall_eff < 30 THEN 'very low' WHEN wall_eff < 60 THEN 'low' WHEN wall_eff < 80 THEN 'moderate' WHEN wall_eff < 100 THEN 'good' END AS wall_band,
CASE WHEN wall_eff < 80 THEN printf('%.2f', elapsed_s / 3600 * 1.5::DOUBLE)::DOUBLE END AS wall_suggest_h FROM costed"""))
def k6_advice(spark, sf_dir):
    return A.advice(_costed(spark, sf_dir)).select("job_id", "mem_band", "mem_suggest_gb", "cpu_band", "wall_band", "wall_suggest_h")


@query(with_domain("steps", """SELECT p.jobid AS job_id, p.state, p.alloc_cpus // 2 AS cores, p.alloc_cpus, max(s.ave_rss * coalesce(s.ntasks, 1)) AS used_rss FROM steps p LEFT JOIN steps s ON split_part(s.jobid, '.', 1) = p.jobid
WHERE NOT contains(p.jobid, '.') AND p.state <> 'RUNNING' GROUP BY p.jobid, p.state, p.alloc_cpus"""))
def k3_roll_up(spark, sf_dir):
    return A.roll_up(domain(spark, sf_dir, "steps"))


@query(with_domain("jobs job_meta", """WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ord) AS n FROM job_meta) x WHERE n = 1)
SELECT jobs.job_id, coalesce(f.process, 'UNKNOWN') AS process, coalesce(f.tag, 'UNKNOWN') AS tag FROM jobs LEFT JOIN f ON f.job_id = jobs.job_id"""))
def k11_job_metadata(spark, sf_dir):
    return A.with_metadata(domain(spark, sf_dir, "jobs"), domain(spark, sf_dir, "job_meta")).select("job_id", "process", "tag")


@query(with_domain("checkpoints", """SELECT id, CASE WHEN NOT present THEN 'fresh' WHEN coalesce(stored_key, '') = '' THEN CASE WHEN done AND has_output THEN 'adopted-unkeyed-skip' WHEN checkpoint THEN 'adopted-unkeyed-continue' ELSE 'invalidated-unkeyed-fresh' END
WHEN stored_key <> key THEN 'invalidated-stale-fresh' WHEN done AND has_output THEN 'skip' WHEN checkpoint THEN 'continue' ELSE 'fresh' END AS decision FROM checkpoints"""))
def k16_recompute_decision(spark, sf_dir):
    return A.recompute_decision(domain(spark, sf_dir, "checkpoints"), unkeyed="adopt").select("id", "decision")


@query(with_domain("tool_versions", """SELECT grp, tool, version FROM (SELECT *, row_number() OVER (PARTITION BY grp, tool ORDER BY CASE WHEN contains(path, '/software_versions') THEN 0 ELSE 1 END, path) AS n FROM tool_versions) x WHERE n = 1"""))
def k17_merge_versions(spark, sf_dir):
    return A.merge_versions(domain(spark, sf_dir, "tool_versions"))


_Q = ", ".join(f"round(quantile_cont({c}, {q}), 6) AS {c}_{n}" for c in ("cpu_eff", "mem_eff", "wall_eff") for n, q in (("min", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1)))


@query(with_domain("jobs", f"WITH {_SU} SELECT count(*) AS jobs, round(sum(su), 2) AS su_total, round(sum(CASE WHEN state <> 'COMPLETED' THEN su ELSE 0 END), 2) AS su_failed, round(quantile_cont(su, 0.5), 6) AS su_median, {_Q} FROM costed"))
def k7_run_summary(spark, sf_dir):
    return A.run_summary(_costed(spark, sf_dir))


@query(with_domain("jobs", "SELECT state, count(*) AS jobs FROM jobs GROUP BY state"))
def k7_state_counts(spark, sf_dir):
    return A.state_counts(domain(spark, sf_dir, "jobs"))


@query(with_domain("jobs", """SELECT job_id, round(cpu_s * 100.0::DOUBLE / CASE WHEN job_id % 3 = 0 THEN elapsed_s * 3 ELSE cores * 2 * elapsed_s END, 4) AS cpu_eff FROM jobs"""))
def k4_raw_cpu_time(spark, sf_dir):
    k = F.col("job_id")
    jobs = domain(spark, sf_dir, "jobs").withColumns({"alloc_cpus": F.col("cores") * 2, "cpu_time_raw": F.when(k % 3 == 0, F.col("elapsed_s") * 3).when(k % 3 == 1, 0)})
    return A.efficiencies(jobs).select("job_id", "cpu_eff")


@query(with_domain("jobs", f"""WITH {_SU} SELECT string_split(process, ':')[-1] AS process, count(*) AS jobs, round(sum(su), 2) AS su, round(quantile_cont(cpu_eff, 0.5), 6) AS cpu_eff_median,
round(quantile_cont(mem_eff, 0.5), 6) AS mem_eff_median, round(quantile_cont(wall_eff, 0.5), 6) AS wall_eff_median, row_number() OVER (ORDER BY round(sum(su), 2) DESC, string_split(process, ':')[-1])::INT AS rank FROM costed GROUP BY string_split(process, ':')[-1]"""))
def k8_by_process(spark, sf_dir):
    return A.by_process(_costed(spark, sf_dir))


@query(with_domain("jobs", f"""WITH {_SU}, t AS (SELECT CASE WHEN tag LIKE 'OG%' THEN regexp_extract(tag, '^OG[0-9]+') END AS sample_id, su, state FROM costed),
d AS (SELECT sample_id, count(*) AS n_jobs, sum(su) AS direct, count(*) FILTER (state <> 'COMPLETED') AS n_failed_jobs FROM t WHERE sample_id IS NOT NULL GROUP BY sample_id),
o AS (SELECT coalesce(sum(su), 0) / (SELECT count(*) FROM d) AS share FROM t WHERE sample_id IS NULL)
SELECT sample_id, n_jobs, round(direct, 4) AS direct_su, round(share, 4) AS overhead_su_share, round(direct + share, 4) AS total_su, n_failed_jobs FROM d, o"""))
def k9_cost_per_sample(spark, sf_dir):
    lanes = F.when(F.col("tag").startswith("OG") & (F.col("job_id") % 2 == 0), F.concat("tag", F.lit(".b"))).otherwise(F.col("tag"))
    return A.cost_per_sample(_costed(spark, sf_dir).withColumn("tag", lanes))


@query(with_domain("jobs", "SELECT job_id, tag FROM jobs WHERE tag IN (SELECT concat('OG', c_custkey::VARCHAR) FROM customer WHERE c_custkey % 3 = 1)"))
def k10_tag_filter(spark, sf_dir):
    (c,) = _tables(spark, sf_dir, "customer")
    wanted = c.filter("c_custkey % 3 = 1").select(F.concat(F.lit("OG"), F.col("c_custkey").cast("string")).alias("tag"))
    return A.with_tags(domain(spark, sf_dir, "jobs"), wanted).select("job_id", "tag")


_GLOBS = {"views": "view/*.remote", "clicks": "click*/*1?.local", "all_local": "*.local", "never": "none/*"}
_LIKES = {"views": "view/%.remote", "clicks": "click%/%1_.local", "all_local": "%.local", "never": "none/%"}
_PATHS = "paths AS (SELECT sample, concat(component, '/f', event_id, '.', side) AS path FROM files)"
_STATES = "states AS (SELECT s.sample, p.pattern, coalesce(concat('Found ', min(f.path)), 'Missing') AS state FROM (SELECT DISTINCT sample FROM files) s CROSS JOIN (VALUES " + ", ".join(f"('{n}', '{g}')" for n, g in _LIKES.items()) + ") p(pattern, pat) LEFT JOIN paths f ON f.sample = s.sample AND f.path LIKE p.pat GROUP BY s.sample, p.pattern)"
_STATES = _STATES.replace("coalesce(concat('Found ', min(f.path)), 'Missing')", "CASE WHEN min(f.path) IS NULL THEN 'Missing' ELSE concat('Found ', min(f.path)) END")


def _states(spark, sf_dir):
    files = domain(spark, sf_dir, "files")
    paths = files.select("sample", F.concat("component", F.lit("/f"), F.col("event_id").cast("string"), F.lit("."), "side").alias("path"))
    return A.expected_files(files, paths, _GLOBS)


@query(with_domain("files", f"WITH {_PATHS}, {_STATES} SELECT * FROM states"))
def k12_expected_files(spark, sf_dir):
    return _states(spark, sf_dir)


@query(with_domain("files", f"WITH {_PATHS}, {_STATES} SELECT sample, " + ", ".join(f"max(state) FILTER (pattern = '{n}') AS {n}" for n in _LIKES) + ", count(*) FILTER (state = 'Missing')::INT AS gaps FROM states GROUP BY sample"))
def k12_file_matrix(spark, sf_dir):
    return A.file_matrix(_states(spark, sf_dir), list(_GLOBS))


@query(with_domain("files", """WITH t AS (SELECT sample, count(*) FILTER (side = 'local') AS local_objects, coalesce(sum(bytes) FILTER (side = 'local'), 0)::BIGINT AS local_bytes, count(*) FILTER (side = 'remote') AS remote_objects, coalesce(sum(bytes) FILTER (side = 'remote'), 0)::BIGINT AS remote_bytes FROM files GROUP BY sample)
SELECT *, CASE WHEN local_objects = remote_objects THEN 'YES' ELSE 'NO' END AS objects_match, CASE WHEN local_bytes = remote_bytes THEN 'YES' ELSE 'NO' END AS bytes_match FROM t"""))
def k13_copy_audit(spark, sf_dir):
    return A.copy_audit(domain(spark, sf_dir, "files"))


_RULES = ["+ view/*.keep", "- click/**", "- /purchase/1*", "+ */?.x"]


@query(with_domain("files", """WITH p AS (SELECT *, concat(component, '/', event_id, CASE WHEN event_id % 4 = 0 THEN '.keep' ELSE '.x' END) AS path FROM files),
c AS (SELECT *, CASE WHEN regexp_matches(path, '(^|/)view/[^/]*\\.keep$') THEN true WHEN regexp_matches(path, '(^|/)click/.*$') THEN false WHEN regexp_matches(path, '^purchase/1[^/]*$') THEN false ELSE true END AS ok FROM p),
t AS (SELECT sample, count(*) FILTER (side = 'local' AND ok) AS local_objects, coalesce(sum(bytes) FILTER (side = 'local' AND ok), 0)::BIGINT AS local_bytes, count(*) FILTER (side = 'remote' AND ok) AS remote_objects, coalesce(sum(bytes) FILTER (side = 'remote' AND ok), 0)::BIGINT AS remote_bytes FROM c GROUP BY sample)
SELECT *, CASE WHEN local_objects = remote_objects THEN 'YES' ELSE 'NO' END AS objects_match, CASE WHEN local_bytes = remote_bytes THEN 'YES' ELSE 'NO' END AS bytes_match FROM t"""))
def k13_filtered_copy_audit(spark, sf_dir):
    path = F.concat("component", F.lit("/"), F.col("event_id").cast("string"), F.when(F.col("event_id") % 4 == 0, ".keep").otherwise(".x"))
    return A.copy_audit(domain(spark, sf_dir, "files").withColumn("path", path), rules=_RULES)


@query(with_domain("files", """WITH l AS (SELECT sample, component, string_agg(concat('read=', event_id, '.fq', chr(9), bytes), chr(10) ORDER BY concat('read=', event_id, '.fq', chr(9), bytes)) AS lines FROM files GROUP BY sample, component)
SELECT concat(sample, '.', component) AS assembly, sha256(concat('megahit_version=1.2.9', chr(10), 'args=--k-list 21,29 --no-mercy', chr(10), 'out_prefix=', component, chr(10), lines, chr(10))) AS checkpoint_key FROM l"""))
def k15_checkpoint_key(spark, sf_dir):
    t = domain(spark, sf_dir, "files").select(F.concat_ws(".", F.col("sample").cast("string"), "component").alias("assembly"), F.col("component").alias("prefix"), F.concat(F.lit("/in/"), F.col("event_id").cast("string"), F.lit(".fq")).alias("path"), "bytes")
    return A.checkpoint_key(t, "1.2.9", "--k-list 21,29  -t 32 --memory=0.9 --no-mercy -m 8", key="assembly")


_WORDS = ", ".join(f"sum(('0x' || substr(h, {1 + 8 * k}, 8))::BIGINT)::VARCHAR AS w{k}" for k in range(8))


@query(with_domain("files", f"""WITH l AS (SELECT sample, sha256(concat_ws(chr(9), '1', component, event_id::VARCHAR, bytes::VARCHAR)) AS h FROM files),
b AS (SELECT sample, ('0x' || substr(h, 1, 4))::BIGINT % 256 AS b, count(*)::VARCHAR AS n, {_WORDS} FROM l GROUP BY sample, b), o AS (SELECT sample, concat_ws(':', lpad(b::VARCHAR, 8, '0'), n, {", ".join(f"w{k}" for k in range(8))}) AS x FROM b)
SELECT sample, sha256('1' || chr(10) || 'k 21' || chr(10) || string_agg(x, chr(10) ORDER BY x)) AS fingerprint FROM o GROUP BY sample"""))
def k15_fingerprint(spark, sf_dir):
    return A.fingerprint(domain(spark, sf_dir, "files"), args="k   21 -t 8")


#: Columns of a record and where they are stored; one under another name.
_FAMILIES = {"assembly": {"size_max": "draft_fit", "fit_full": "draft_fit", "absent": "draft_fit"}, "decontamination": {"num_contigs": ("draft_contamination", "num_contigs_lt_500bp")}}


@query(with_domain("fits", """WITH r AS (SELECT sample, CASE WHEN sample % 4 = 0 THEN NULL ELSE size_max END AS size_max, CASE WHEN sample % 4 = 0 THEN NULL ELSE fit_full END AS fit_full, CASE WHEN sample % 3 = 0 THEN NULL ELSE sample % 40 END AS num_contigs FROM fits WHERE sample % 5 < 3),
stored AS (SELECT sample, 1 AS size_max, CAST(0 AS DOUBLE) AS fit_full, 7 AS kept FROM fits WHERE sample % 2 = 0), n AS (SELECT * FROM r WHERE size_max IS NOT NULL OR fit_full IS NOT NULL)
SELECT 'draft_fit' AS table_name, coalesce(s.sample, n.sample) AS sample, CASE WHEN n.sample IS NOT NULL THEN n.size_max ELSE s.size_max END AS a, CASE WHEN n.sample IS NOT NULL THEN n.fit_full ELSE s.fit_full END AS b, kept AS c FROM stored s FULL JOIN n ON n.sample = s.sample
UNION ALL SELECT 'draft_contamination', sample, num_contigs, NULL, NULL FROM r WHERE num_contigs IS NOT NULL"""))
def j10_family_upload(spark, sf_dir):
    t, s = domain(spark, sf_dir, "fits"), F.col("sample")
    record = t.filter(s % 5 < 3).select("sample", *[F.when(s % 4 != 0, F.col(c)).alias(c) for c in ("size_max", "fit_full")], F.when(s % 3 != 0, s % 40).alias("num_contigs"))
    stored = t.filter(s % 2 == 0).select("sample", F.lit(1).cast("long").alias("size_max"), F.lit(0.0).alias("fit_full"), F.lit(7).alias("kept"))
    got = S.upsert_families({"draft_fit": stored}, record, _FAMILIES, ["sample"])
    rows = lambda name, a, b, c: got[name].select(F.lit(name).alias("table_name"), "sample", F.col(a).alias("a"), b.alias("b"), c.alias("c"))
    return rows("draft_fit", "size_max", F.col("fit_full"), F.col("kept")).unionByName(rows("draft_contamination", "num_contigs_lt_500bp", F.lit(None).cast("double"), F.lit(None).cast("int")))


@query(with_domain("fits", """WITH r AS (SELECT sample, CASE WHEN sample % 4 = 0 THEN NULL ELSE size_max END AS size_max, CASE WHEN sample % 4 = 0 THEN NULL ELSE fit_full END AS fit_full, CASE WHEN sample % 3 = 0 THEN NULL ELSE sample % 40 END AS num_contigs FROM fits WHERE sample % 5 < 3),
stored AS (SELECT sample, 1 AS size_max, CAST(0 AS DOUBLE) AS fit_full, 7 AS kept FROM fits WHERE sample % 2 = 0), n AS (SELECT * FROM r WHERE size_max IS NOT NULL OR fit_full IS NOT NULL)
SELECT 'draft_fit' AS table_name, coalesce(s.sample, n.sample) AS sample, CASE WHEN n.sample IS NOT NULL THEN n.size_max ELSE s.size_max END AS a, CASE WHEN n.sample IS NOT NULL THEN n.fit_full ELSE s.fit_full END AS b, kept AS c FROM stored s FULL JOIN n ON n.sample = s.sample
UNION ALL SELECT 'draft_contamination', sample, num_contigs, NULL, NULL FROM r WHERE num_contigs IS NOT NULL"""))
def j5_snapshot_commit(spark, sf_dir):
    """The same upload as two commits over both tables, read back from the latest snapshot."""
    t, s = domain(spark, sf_dir, "fits"), F.col("sample")
    record = t.filter(s % 5 < 3).select("sample", *[F.when(s % 4 != 0, F.col(c)).alias(c) for c in ("size_max", "fit_full")], F.when(s % 3 != 0, s % 40).alias("num_contigs"))
    stored = t.filter(s % 2 == 0).select("sample", F.lit(1).cast("long").alias("size_max"), F.lit(0.0).alias("fit_full"), F.lit(7).alias("kept"))
    store = Snapshots(spark, scratch(spark, "snapshots"), {"draft_fit": ["sample"], "draft_contamination": ["sample"]}, 8)
    store.commit({"draft_fit": stored}, base=0)
    store.commit(S.family_tables(record, _FAMILIES, ["sample"]), base=1)
    rows = lambda name, a, b, c: store.read(name).select(F.lit(name).alias("table_name"), "sample", F.col(a).alias("a"), b.alias("b"), c.alias("c"))
    return rows("draft_fit", "size_max", F.col("fit_full"), F.col("kept")).unionByName(rows("draft_contamination", "num_contigs_lt_500bp", F.lit(None).cast("double"), F.lit(None).cast("int")))


@query(with_domain("steps", """SELECT jobid AS "JobID", split_part(jobid, '.', 1) AS job_id, NOT contains(jobid, '.') AS is_parent, state AS "State", alloc_cpus::VARCHAR AS "AllocCPUS", ave_rss::VARCHAR AS "AveRSS", ntasks::VARCHAR AS "NTasks",
CASE WHEN alloc_cpus % 5 = 0 THEN 'N/A' ELSE '2025-01-31 10:00:00' END AS "Submit" FROM steps"""))
def a25_job_accounting(spark, sf_dir):
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    given = {"JobID": text("jobid"), "State": text("state"), "AllocCPUS": text("alloc_cpus"), "AveRSS": text("ave_rss"), "NTasks": text("ntasks"), "Submit": F.when(F.col("alloc_cpus") % 5 == 0, "Unknown").otherwise("2025-01-31T10:00:00")}
    lines = domain(spark, sf_dir, "steps").select(F.concat_ws("|", *[given.get(c, F.lit("")) for c in ACCOUNTING]).alias("value"))
    return job_accounting(lines).select("JobID", "job_id", "is_parent", "State", "AllocCPUS", "AveRSS", "NTasks", "Submit")


@query("SELECT p_partkey AS taxid, p_name AS species FROM part WHERE p_partkey % 9 <> 0")
def a26_curated(spark, sf_dir):
    return read_curated(spark, sf_dir, "part").filter("p_partkey % 9 <> 0").select(F.col("p_partkey").alias("taxid"), F.col("p_name").alias("species"))
