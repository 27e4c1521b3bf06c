"""Queries on contigs, gene regions and depth."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanefold.operators import contigs as C
from lanefold.operators import coverage as V
from lanefold.operators import depth as D
from lanefold.operators import flows
from lanefold.plans.registry import query
from lanefold.sources.adapters import domain, with_domain


@query(with_domain("actions", """SELECT s.sample, k.action, count(DISTINCT a.contig) AS contigs, coalesce(sum(a.a_end - a.a_start + 1), 0)::BIGINT AS bp
FROM (SELECT DISTINCT sample FROM actions) s CROSS JOIN (VALUES ('EXCLUDE'), ('TRIM'), ('REVIEW')) k(action) LEFT JOIN actions a ON a.action = k.action AND a.sample = s.sample GROUP BY s.sample, k.action"""))
def e1_action_summary(spark, sf_dir):
    return C.action_summary(domain(spark, sf_dir, "actions"))


_CLEAN = """one AS (SELECT sample, contig, max(a_start) AS s, max(a_end) AS e FROM actions WHERE action = 'TRIM' GROUP BY sample, contig),
base AS (SELECT c.*, s, e FROM contigs c LEFT JOIN one ON one.contig = c.contig AND one.sample = c.sample WHERE NOT EXISTS (SELECT 1 FROM actions x WHERE x.action = 'EXCLUDE' AND x.sample = c.sample AND x.contig = c.contig)),
raw AS (SELECT sample, contig, 1 AS side, CASE WHEN s IS NULL THEN seq ELSE substr(seq, 1, (s - 1)::INT) END AS seq FROM base
  UNION ALL SELECT sample, contig, 2, substr(seq, (e + 1)::INT) FROM base WHERE s IS NOT NULL),
clean AS (SELECT sample, contig, row_number() OVER (PARTITION BY sample, contig ORDER BY side) AS piece, seq FROM raw WHERE length(seq) > 0)"""
_UNREVIEWED = "NOT EXISTS (SELECT 1 FROM actions x WHERE x.action = 'REVIEW' AND x.sample = {t}.sample AND x.contig = {t}.contig)"


@query(with_domain("actions contigs", f"WITH {_CLEAN} SELECT * FROM clean"))
def e2_apply_actions(spark, sf_dir):
    return C.apply_actions(domain(spark, sf_dir, "contigs"), domain(spark, sf_dir, "actions"))


@query(with_domain("actions contigs", """WITH gone AS (SELECT DISTINCT sample, contig FROM actions WHERE action = 'EXCLUDE'),
one AS (SELECT sample, contig, greatest(max(a_start), 1) AS s, max(a_end) AS e FROM actions WHERE action = 'TRIM' GROUP BY sample, contig)
SELECT c.sample, c.contig, 1::BIGINT AS a_start, length(seq) AS a_end, seq FROM contigs c JOIN gone g ON g.sample = c.sample AND g.contig = c.contig
UNION ALL SELECT c.sample, c.contig, s, least(e, length(seq)), substr(seq, s::INT, (least(e, length(seq)) - s + 1)::INT) FROM contigs c JOIN one o ON o.sample = c.sample AND o.contig = c.contig
WHERE s <= length(seq) AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.sample = c.sample AND g.contig = c.contig)"""))
def e2_removed_pieces(spark, sf_dir):
    return C.removed_pieces(domain(spark, sf_dir, "contigs"), domain(spark, sf_dir, "actions"))


@query(with_domain("actions", "SELECT DISTINCT sample, contig FROM actions WHERE action = 'REVIEW' AND a_end <= 1000"))
def e3_review_names(spark, sf_dir):
    return C.review_names(domain(spark, sf_dir, "actions"), "short-only")


@query(with_domain("actions contigs", f"SELECT sample, contig, length FROM contigs c WHERE {_UNREVIEWED.format(t='c')}"))
def e4_drop_named(spark, sf_dir):
    names = C.review_names(domain(spark, sf_dir, "actions"), "exclude")
    return C.drop_named(domain(spark, sf_dir, "contigs"), names).select("sample", "contig", "length")


@query(with_domain("contigs", "SELECT sample, count(*) FILTER (length > 0 AND length < 500) AS n_short FROM contigs GROUP BY sample"))
def e5_length_floor(spark, sf_dir):
    return C.length_floor(domain(spark, sf_dir, "contigs"))[1]


_ADAPT = """named AS (SELECT sample, CASE WHEN piece = 1 THEN contig::VARCHAR ELSE concat(contig, '.', piece) END AS contig, seq FROM clean c WHERE {r} AND length(seq) >= 500),
two AS (SELECT n.*, a.action, CAST(split_part(a.ranges, '..', 1) AS INT) AS s, CAST(split_part(a.ranges, '..', 2) AS INT) AS e FROM named n LEFT JOIN (SELECT * FROM adaptor_report WHERE action = 'ACTION_TRIM') a ON a.sample = n.sample AND a.contig::VARCHAR = n.contig
  WHERE NOT EXISTS (SELECT 1 FROM adaptor_report x WHERE x.action = 'ACTION_EXCLUDE' AND x.sample = n.sample AND x.contig::VARCHAR = n.contig)),
pieces AS (SELECT sample, contig, CASE WHEN s IS NULL THEN seq ELSE substr(seq, 1, s - 1) END AS seq FROM two UNION ALL SELECT sample, contig, substr(seq, e + 1) FROM two WHERE s IS NOT NULL),
bad AS (SELECT DISTINCT sample, string_split_regex(trim(line), '\\s+')[1] AS contig FROM classes WHERE regexp_matches(line, '\\b(archaea|bacteria|organelle|mitochondrion|plastid|prokarya)\\b'))"""


@query(with_domain("actions contigs adaptor_report contig_classes", f"""WITH {_CLEAN}, {_ADAPT.format(r=_UNREVIEWED.format(t="c")).replace("classes", "contig_classes")}
SELECT sample, count(*) AS pieces, sum(length(seq))::BIGINT AS bases FROM pieces p WHERE length(seq) > 0 AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.sample = p.sample AND bad.contig = p.contig) GROUP BY sample"""))
def e8_decontaminate(spark, sf_dir):
    t = {n: domain(spark, sf_dir, n) for n in ("contigs", "actions", "adaptor_report", "contig_classes")}
    clean = C.decontaminate(t["contigs"], t["actions"], adaptors=C.adaptor_actions(t["adaptor_report"]), classes=t["contig_classes"])
    return clean.groupBy("sample").agg(F.count("*").alias("pieces"), F.sum(F.length("seq")).alias("bases"))


@query(with_domain("hits", "SELECT query, subject, count(*) AS n FROM hits WHERE q_end - q_start > 200 AND identity > 98 GROUP BY query, subject"))
def e10_hit_summary(spark, sf_dir):
    return C.filter_hits(domain(spark, sf_dir, "hits")).groupBy("query", "subject").agg(F.count("*").alias("n"))


_STATS = """SELECT sample, count(*) AS num_seqs, sum(length)::BIGINT AS sum_len, min(length) AS min_len, avg(length) AS avg_len, max(length) AS max_len, quantile_cont(length, 0.25) AS q1, quantile_cont(length, 0.5) AS q2,
  quantile_cont(length, 0.75) AS q3, sum(length(regexp_replace(seq, '[^N]', '', 'g')))::BIGINT AS n_bases, sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) * 100.0::DOUBLE / sum(length) AS gc_pct FROM {t} GROUP BY sample"""


_N50 = "nx AS (SELECT sample, max(length) AS n50 FROM (SELECT sample, length, sum(length) OVER (PARTITION BY sample ORDER BY length DESC, n) AS run, sum(length) OVER (PARTITION BY sample) AS total FROM (SELECT sample, length, row_number() OVER () AS n FROM {t}) y) x WHERE run * 2 >= total GROUP BY sample)"


@query(with_domain("contigs", f"WITH {_N50.format(t='contigs')}, st AS ({_STATS.format(t='contigs')}) SELECT st.*, n50 FROM st LEFT JOIN nx ON nx.sample = st.sample"))
def f1_seq_stats(spark, sf_dir):
    return C.seq_stats(domain(spark, sf_dir, "contigs"))


_NSTAR = """, r AS (SELECT sample, length, sum(length) OVER w AS run, row_number() OVER w AS rank, sum(length) OVER (PARTITION BY sample) AS total FROM {t} WINDOW w AS (PARTITION BY sample ORDER BY length DESC, contig{more} ROWS UNBOUNDED PRECEDING)),
a AS (SELECT sample, sum(length::DOUBLE * length) / any_value(total) AS aun FROM r GROUP BY sample)
SELECT r.sample, p AS pct, max(length) FILTER (run * 100 >= total * p) AS n, min(rank) FILTER (run * 100 >= total * p) AS l, any_value(aun) AS aun
FROM r JOIN a ON a.sample = r.sample, (VALUES (10), (20), (30), (40), (50), (60), (70), (80), (90), (100)) x(p) GROUP BY r.sample, p"""


@query(with_domain("contigs", "WITH one AS (SELECT 1)" + _NSTAR.format(t="contigs", more="")))
def f2_nstar(spark, sf_dir):
    return C.nstar(domain(spark, sf_dir, "contigs"))


@query(with_domain("contigs", "WITH one AS (SELECT 1)" + _NSTAR.format(t="contigs", more="").replace("sum(length) OVER (PARTITION BY sample) AS total", "150000 * length(sample) AS total").replace("FROM contigs WINDOW", "FROM contigs WHERE length(sample) % 3 > 0 WINDOW")))
def f2_ngstar(spark, sf_dir):
    contigs = domain(spark, sf_dir, "contigs")
    sizes = contigs.select("sample").distinct().withColumn("expected", F.when(F.length("sample") % 3 > 0, F.length("sample") * 150_000))
    return C.nstar(contigs, sizes=sizes)


_PARTS = "parts AS (SELECT sample, contig, unnest(string_split_regex(seq, 'N+')) AS seq FROM contigs), p AS (SELECT *, length(seq) AS length FROM parts WHERE seq <> '')"


@query(with_domain("contigs", f"""WITH {_PARTS}, {_N50.format(t='contigs')}, {_N50.format(t='p').replace("nx AS", "np AS")}, st AS ({_STATS.format(t='contigs')}), sp AS ({_STATS.format(t='p')})
SELECT st.*, n50, 'scaffold' AS kind FROM st LEFT JOIN nx ON nx.sample = st.sample UNION ALL SELECT sp.*, n50, 'contig' FROM sp LEFT JOIN np ON np.sample = sp.sample"""))
def f3_scaffold_parts(spark, sf_dir):
    return C.scaffold_and_contig_stats(domain(spark, sf_dir, "contigs"))


_REGIONS = """regions AS (SELECT g.sample, gene, g.contig, greatest(least(g_start, g_end), 1) - 1 AS start_, least(greatest(g_start, g_end), length) AS end_
  FROM gene_table g JOIN supplier_contigs c ON c.contig = g.contig AND c.sample = g.sample WHERE status = 'Complete' AND least(greatest(g_start, g_end), length) > greatest(least(g_start, g_end), 1) - 1)"""


def _regions(spark, sf_dir):
    return C.gene_regions(domain(spark, sf_dir, "gene_table"), domain(spark, sf_dir, "supplier_contigs"))


@query(with_domain("gene_table supplier_contigs", f"WITH {_REGIONS} SELECT sample, gene, contig, start_ AS start, end_ AS \"end\" FROM regions"))
def f4_gene_regions(spark, sf_dir):
    return _regions(spark, sf_dir)


@query(with_domain("gene_table supplier_contigs", f"""WITH {_REGIONS}, k AS (SELECT sample, count(*) AS kept FROM regions GROUP BY sample)
SELECT g.sample, coalesce(any_value(kept), 0) AS kept, count(*) FILTER (status = 'Complete') - coalesce(any_value(kept), 0) AS skipped FROM gene_table g LEFT JOIN k ON k.sample = g.sample GROUP BY g.sample"""))
def f4_region_counts(spark, sf_dir):
    return C.region_counts(domain(spark, sf_dir, "gene_table"), domain(spark, sf_dir, "supplier_contigs"))


@query(with_domain("doc_genes gene_contigs", """WITH p AS (SELECT g.sample, gene, g.contig, strand, greatest(least(g_start, g_end), 1) AS lo, greatest(greatest(g_start, g_end), greatest(least(g_start, g_end), 1) + 1) AS hi, seq AS s
  FROM doc_genes g JOIN gene_contigs c ON c.contig = g.contig AND c.sample = g.sample WHERE status <> 'Missing'), q AS (SELECT *, substr(s, lo::INT, (hi - lo + 1)::INT) AS x FROM p)
SELECT sample, gene, contig, strand, concat('>', gene, '|', contig, ':', lo, '-', hi, '(', strand, ')') AS header, CASE WHEN strand = '-' THEN reverse(translate(x, 'ACGTN', 'TGCAN')) ELSE x END AS seq FROM q"""))
def f5_gene_sequences(spark, sf_dir):
    return C.gene_sequences(domain(spark, sf_dir, "doc_genes"), domain(spark, sf_dir, "gene_contigs"))


_GOOD = "mapq >= {q} AND (flag & 1796) = 0"
_ON = "a.contig = r.contig AND a.sample = r.sample AND a_start < end_ AND start_ < a_end"


@query(with_domain("gene_table supplier_contigs alignments", f"""WITH {_REGIONS} SELECT r.sample, r.gene, r.contig, any_value(start_) AS start, any_value(end_) AS "end", coalesce(sum(least(a_end, end_) - greatest(a_start, start_)), 0)::BIGINT AS depth_sum
FROM regions r LEFT JOIN (SELECT * FROM alignments WHERE {_GOOD.format(q=20)} AND a_end > a_start) a ON {_ON} GROUP BY r.sample, r.gene, r.contig"""))
def f6_region_depth(spark, sf_dir):
    return C.region_depth(domain(spark, sf_dir, "alignments"), _regions(spark, sf_dir)).select("sample", "gene", "contig", "start", "end", "depth_sum")


@query(with_domain("supplier_contigs alignments", f"""SELECT c.sample, c.contig, length, coalesce(sum(greatest(least(a_end, length) - greatest(a_start, 0), 0)), 0) / length AS meandepth
FROM supplier_contigs c LEFT JOIN (SELECT * FROM alignments WHERE {_GOOD.format(q=0)}) a ON a.contig = c.contig AND a.sample = c.sample GROUP BY c.sample, c.contig, length"""))
def f7_contig_depth(spark, sf_dir):
    return C.contig_depth(domain(spark, sf_dir, "alignments"), domain(spark, sf_dir, "supplier_contigs"))


@query(with_domain("gene_table supplier_contigs", f"WITH {_REGIONS} SELECT c.sample, count(r.gene) AS regions, CASE WHEN count(r.gene) < 20 THEN 'too_few_busco_regions' ELSE 'ok' END AS status FROM (SELECT DISTINCT sample FROM supplier_contigs) c LEFT JOIN regions r ON r.sample = c.sample GROUP BY c.sample"))
def f8_region_status(spark, sf_dir):
    return C.region_status(_regions(spark, sf_dir), domain(spark, sf_dir, "supplier_contigs"))


@query(with_domain("alignments", "SELECT sample, count(*) AS total, count(*) FILTER ((flag & 4) = 0) AS mapped, count(*) FILTER ((flag & 16) > 0) AS reverse, count(*) FILTER ((flag & 256) > 0) AS secondary, count(*) FILTER ((flag & 2) > 0) AS paired, count(*) FILTER ((flag & 1024) > 0) AS duplicates, avg(mapq) AS mean_mapq FROM alignments GROUP BY sample"))
def f9_mapping_summary(spark, sf_dir):
    return C.mapping_summary(domain(spark, sf_dir, "alignments"))


_OPS = """ops AS (SELECT n, sample, contig, a_start, i, regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 1)[i]::BIGINT AS size, regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 2)[i] AS kind
    FROM (SELECT row_number() OVER () AS n, * FROM cigars WHERE mapq >= {q} AND (flag & 1796) = 0) c, unnest(range(1, len(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 0)) + 1)) AS x(i)),
places AS (SELECT *, a_start + coalesce(sum(CASE WHEN kind IN ('M', '=', 'X', 'D', 'N') THEN size ELSE 0 END) OVER (PARTITION BY n ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ops),
covered AS (SELECT sample, contig, s, s + size AS e FROM places WHERE kind IN ({k}))"""
_DEEP, _READ = _OPS.format(q=20, k="'M', '=', 'X', 'D'"), _OPS.format(q=0, k="'M', '=', 'X'")


@query(with_domain("cigars", f"""WITH {_DEEP}, steps AS (SELECT sample, contig, pos, sum(d) AS d FROM (SELECT sample, contig, s AS pos, 1 AS d FROM covered UNION ALL SELECT sample, contig, e, -1 FROM covered) y GROUP BY ALL HAVING sum(d) <> 0),
runs AS (SELECT sample, contig, pos AS start, lead(pos) OVER w AS "end", sum(d) OVER w AS depth FROM steps WINDOW w AS (PARTITION BY sample, contig ORDER BY pos))
SELECT sample, contig, start::BIGINT AS start, "end"::BIGINT AS "end", depth::BIGINT AS depth FROM runs WHERE depth > 0"""))
def f6_depth_runs(spark, sf_dir):
    return V.depth_runs(V.alignment_blocks(V.good_alignments(domain(spark, sf_dir, "cigars"), 20)))


@query(with_domain("gene_table supplier_contigs cigars", f"""WITH {_REGIONS}, {_DEEP} SELECT r.sample, r.gene, r.contig, start_ AS start, end_ AS "end", coalesce(sum(least(e, end_) - greatest(s, start_)), 0)::BIGINT AS depth_sum
FROM regions r LEFT JOIN covered a ON a.contig = r.contig AND a.sample = r.sample AND s < end_ AND start_ < e GROUP BY ALL"""))
def f6_cigar_region_depth(spark, sf_dir):
    runs = V.depth_runs(V.alignment_blocks(V.good_alignments(domain(spark, sf_dir, "cigars"), 20)))
    return V.depth_in_regions(runs, _regions(spark, sf_dir)).select("sample", "gene", "contig", "start", "end", "depth_sum")


@query(with_domain("supplier_contigs cigars", f"""WITH {_READ} SELECT c.sample, c.contig, length, coalesce(sum(greatest(least(e, length) - greatest(s, 0), 0)), 0) / length AS meandepth
FROM supplier_contigs c LEFT JOIN covered a ON a.contig = c.contig AND a.sample = c.sample GROUP BY c.sample, c.contig, length"""))
def f7_cigar_contig_depth(spark, sf_dir):
    return C.contig_depth(domain(spark, sf_dir, "cigars"), domain(spark, sf_dir, "supplier_contigs"))


@query(with_domain("cigars", """WITH t AS (SELECT sample, (flag & 260) = 0 AS ok, nm, list_sum([x::BIGINT for x in regexp_extract_all(cigar, '([0-9]+)[MI=X]', 1)]) AS b, list_sum([x::BIGINT for x in regexp_extract_all(cigar, '([0-9]+)D', 1)]) AS d,
  list_sum([x::BIGINT for x in regexp_extract_all(cigar, '([0-9]+)[SH]', 1)]) AS c FROM cigars),
u AS (SELECT sample, coalesce(sum(b) FILTER (ok), 0)::BIGINT AS mapped_bases, coalesce(sum(nm) FILTER (ok), 0)::BIGINT AS mismatches, coalesce(sum(d) FILTER (ok), 0)::BIGINT AS deleted_bases, coalesce(sum(c) FILTER (ok), 0)::BIGINT AS clipped_bases FROM t GROUP BY sample)
SELECT *, mismatches / mapped_bases AS error_rate FROM u"""))
def f9_mapping_errors(spark, sf_dir):
    return V.mapping_errors(domain(spark, sf_dir, "cigars"))


_SAMPLES = f"""gr AS (SELECT r.sample, r.gene, start_, end_, coalesce(d, 0) AS depth_sum FROM regions r LEFT JOIN (
  SELECT r.gene AS g, sum(least(a_end, end_) - greatest(a_start, start_)) AS d FROM regions r JOIN alignments a ON {_ON} WHERE {_GOOD.format(q=20)} AND a_end > a_start GROUP BY r.gene) x ON x.g = r.gene),
weighted AS (SELECT sample, sum(depth_sum) / sum(end_ - start_) AS mean_depth, count(*) AS regions FROM gr GROUP BY sample)"""


def _weighted(spark, sf_dir):
    return D.weighted_depth(C.region_depth(domain(spark, sf_dir, "alignments"), _regions(spark, sf_dir)))


@query(with_domain("gene_table supplier_contigs alignments", f"WITH {_REGIONS}, {_SAMPLES} SELECT * FROM weighted"))
def g1_weighted_depth(spark, sf_dir):
    return _weighted(spark, sf_dir)


@query(with_domain("gene_table supplier_contigs alignments", f"WITH {_REGIONS}, {_SAMPLES} SELECT sample, CASE WHEN mean_depth <> 0 THEN mean_depth * (146 - 21 + 1) / 146 / 2 END AS lambda_depth FROM weighted"))
def g2_lambda(spark, sf_dir):
    return _weighted(spark, sf_dir).select("sample", D.lambda_of(F.col("mean_depth"), F.lit(146.0)).alias("lambda_depth"))


_PART = """dp AS (SELECT *, 61.0::DOUBLE + sample AS h FROM contig_depth),
kinds AS (SELECT *, CASE WHEN length < 500 THEN 'excluded' WHEN meandepth < h / 2 THEN 'below' WHEN meandepth > h * 2 THEN 'above' WHEN meandepth < greatest(h / 2, h * 0.75) THEN 'host_haplotig' ELSE 'host_collapsed' END AS kind FROM dp)"""
_SUMS = ", ".join(f"coalesce(sum(length) FILTER (kind IN ({k})), 0)::BIGINT AS {n}_size, count(*) FILTER (kind IN ({k})) AS {n}_contigs" for n, k in (("host", "'host_haplotig','host_collapsed'"), *((x, f"'{x}'") for x in ("host_collapsed", "host_haplotig", "below", "above", "excluded"))))


def _depths(spark, sf_dir):
    return domain(spark, sf_dir, "contig_depth").withColumn("host_depth", F.lit(61.0) + F.col("sample"))


@query(with_domain("contig_depth", f"WITH {_PART} SELECT sample, {_SUMS} FROM kinds GROUP BY sample"))
def g3_depth_partition(spark, sf_dir):
    return D.partition(_depths(spark, sf_dir))


_MODE = """bins AS (SELECT sample, floor(log2(meandepth) / 0.25) AS bin, sum(length) AS size, min(contig) AS first FROM contig_depth WHERE length >= 500 GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY size DESC, first) AS n, sum(size) OVER (PARTITION BY sample) AS total FROM bins),
modes AS (SELECT sample, pow(2.0, (bin + 0.5) * 0.25) AS depth_mode, size / total AS mode_fraction FROM best WHERE n = 1)"""


@query(with_domain("contig_depth", f"WITH {_MODE} SELECT sample, round(depth_mode, 6) AS depth_mode, round(mode_fraction, 9) AS mode_fraction FROM modes"))
def g4_depth_mode(spark, sf_dir):
    return D.depth_mode(domain(spark, sf_dir, "contig_depth")).select("sample", F.round("depth_mode", 6).alias("depth_mode"), F.round("mode_fraction", 9).alias("mode_fraction"))


@query(with_domain("contig_depth", f"""WITH {_MODE} SELECT sample, CASE WHEN 40 + sample * 3 < 50 THEN 'few_busco_regions' WHEN mode_fraction < 0.1 THEN 'no_dominant_mode'
  WHEN (61.0 + sample) / depth_mode > 2 OR depth_mode / (61.0 + sample) > 2 THEN 'anchor_off_mode' ELSE 'high' END AS confidence FROM modes"""))
def g5_partition_confidence(spark, sf_dir):
    modes = D.depth_mode(domain(spark, sf_dir, "contig_depth"))
    c = D.confidence(F.lit(40) + F.col("sample") * 3, F.lit(61.0) + F.col("sample"), F.col("depth_mode"), F.col("mode_fraction"), least_fraction=0.1)
    return modes.select("sample", c.alias("confidence"))


@query(with_domain("contig_depth", f"""WITH {_MODE}, anchored AS (SELECT c.*, depth_mode AS h FROM contig_depth c JOIN modes m ON m.sample = c.sample)
SELECT sample, coalesce(sum(length) FILTER (length >= 500 AND meandepth >= h / 2 AND meandepth <= h * 2), 0)::BIGINT AS host_size_mode_anchored FROM anchored GROUP BY sample"""))
def g6_mode_anchored(spark, sf_dir):
    t = domain(spark, sf_dir, "contig_depth")
    modes = D.depth_mode(t).select("sample", F.col("depth_mode").alias("host_depth"))
    return D.partition(t.join(modes, "sample")).select("sample", F.col("host_size").alias("host_size_mode_anchored"))


#: Samples of the depth record; 20 to 22 have no contigs, some no host depth or a reason why nothing was measured.
SAMPLES_SQL = """SELECT sample, CASE WHEN sample % 11 = 5 THEN 'too_few_busco_regions' ELSE 'ok' END AS status, 40 + sample * 3 AS busco_regions,
  CASE WHEN sample % 7 = 3 OR sample % 11 = 5 THEN NULL WHEN sample % 5 = 1 THEN 9.5 + sample ELSE 61.5 + sample END AS busco_mean_depth, CASE WHEN sample = 4 THEN 20 ELSE 146 END AS read_length,
  CASE WHEN sample = 2 THEN 0 ELSE 5000000 + sample * 1000 END AS total_bases, CASE WHEN sample = 6 THEN NULL ELSE 30000 + sample * 7 END AS assembly_size, CASE WHEN sample % 8 = 0 THEN NULL ELSE 20.0 + sample END AS kmercov
FROM (SELECT DISTINCT sample FROM contig_depth UNION ALL SELECT 20 UNION ALL SELECT 21 UNION ALL SELECT 22) x"""
_RECORD = f"""s AS ({SAMPLES_SQL}), d AS (SELECT c.*, s.busco_mean_depth AS h FROM contig_depth c JOIN s ON s.sample = c.sample),
k AS (SELECT *, CASE WHEN length < 500 THEN 'excluded' WHEN meandepth < h / 2 THEN 'below' WHEN meandepth > h * 2 THEN 'above' WHEN meandepth < greatest(h / 2, h * 0.75) THEN 'haplotig' ELSE 'collapsed' END AS kind FROM d WHERE h > 0),
p AS (SELECT sample, coalesce(sum(length) FILTER (kind IN ('haplotig', 'collapsed')), 0)::BIGINT AS host, coalesce(sum(length) FILTER (kind = 'above'), 0)::BIGINT AS above, coalesce(sum(length) FILTER (kind = 'below'), 0)::BIGINT AS below,
  count(*) FILTER (kind IN ('haplotig', 'collapsed')) AS n, coalesce(sum(length) FILTER (kind = 'collapsed'), 0)::BIGINT AS col, coalesce(sum(length) FILTER (kind = 'haplotig'), 0)::BIGINT AS hap FROM k GROUP BY sample),
{_MODE},
am AS (SELECT c.sample, coalesce(sum(length) FILTER (length >= 500 AND meandepth >= depth_mode / 2 AND meandepth <= depth_mode * 2), 0)::BIGINT AS at_mode FROM contig_depth c JOIN modes m ON m.sample = c.sample GROUP BY c.sample),
j AS (SELECT s.*, p.* EXCLUDE (sample), m.depth_mode AS mode, at_mode, cd.sample IS NOT NULL AS there, CASE WHEN busco_mean_depth <> 0 AND read_length > 21 THEN busco_mean_depth * (read_length - 20) / read_length / 2 END AS lam, nullif(total_bases, 0) / nullif(assembly_size, 0) AS mean
  FROM s LEFT JOIN p ON p.sample = s.sample LEFT JOIN modes m ON m.sample = s.sample LEFT JOIN am ON am.sample = s.sample LEFT JOIN (SELECT DISTINCT sample FROM contig_depth) cd ON cd.sample = s.sample),
q AS (SELECT *, CASE WHEN NOT there THEN 'no_contig_depth' WHEN busco_mean_depth IS NULL THEN 'no_host_depth' ELSE 'ok' END AS ps FROM j),
r AS (SELECT *, CASE WHEN ps = 'ok' THEN at_mode / (host + above + below) END AS frac, CASE WHEN ps = 'ok' THEN busco_mean_depth / mode END AS off FROM q),
n AS (SELECT *, CASE WHEN ps = 'ok' THEN CASE WHEN busco_regions < 50 THEN 'few_busco_regions' WHEN mode IS NULL OR frac IS NULL OR frac < 0.4 THEN 'no_dominant_mode' WHEN off > 2 OR 1 / off > 2 THEN 'anchor_off_mode' END END AS note FROM r)"""


def _record(spark, sf_dir):
    t = domain(spark, sf_dir, "contig_depth")
    sql = SAMPLES_SQL.replace("contig_depth", "{contig_depth}")
    got = D.depth_record(spark.sql(sql, contig_depth=t), t)
    doubles = [c for c, kind in got.dtypes if kind == "double"]
    return got.withColumns({c: F.round(c, 9) for c in doubles})


@query(with_domain("contig_depth", f"""WITH {_RECORD} SELECT sample AS sample_id, CASE WHEN lam IS NULL AND status = 'ok' THEN 'no_measurement' ELSE status END AS status, busco_regions, round(busco_mean_depth::DOUBLE, 9) AS busco_mean_depth, read_length::DOUBLE AS read_length,
  round(lam, 9) AS lambda_depth, round(mean, 9) AS assembly_mean_depth, round(busco_mean_depth / mean, 9) AS busco_depth_over_assembly_depth, assembly_size, kmercov::DOUBLE AS genomescope_kmercov, round(kmercov / lam, 9) AS kmercov_over_lambda_depth,
  CASE WHEN ps = 'ok' THEN host END AS host_assembly_size, round(CASE WHEN ps = 'ok' THEN host / (host + above + below) END, 9) AS host_assembly_fraction, CASE WHEN ps = 'ok' THEN above END AS symbiont_assembly_size,
  CASE WHEN ps = 'ok' THEN below END AS low_depth_assembly_size, CASE WHEN ps = 'ok' THEN n END AS host_contig_count, ps AS partition_status, CASE WHEN ps = 'ok' THEN col END AS host_collapsed_size, CASE WHEN ps = 'ok' THEN hap END AS host_haplotig_size,
  CASE WHEN ps = 'ok' THEN col + hap // 2 END AS host_haploid_size, round(CASE WHEN ps = 'ok' THEN mode END, 9) AS depth_mode, round(off, 9) AS anchor_over_mode, CASE WHEN ps = 'ok' THEN CASE WHEN note IS NULL THEN 'high' ELSE 'low' END END AS partition_confidence,
  note AS partition_note, CASE WHEN frac >= 0.4 AND (off > 2 OR off < 0.5) THEN at_mode END AS host_assembly_size_mode_anchored FROM n"""))
def g7_kmer_depth_record(spark, sf_dir):
    return _record(spark, sf_dir)


@query(with_domain("contig_depth", f"WITH {_RECORD} SELECT sample AS sample_id, CASE WHEN frac >= 0.4 AND (off > 2 OR off < 0.5) THEN at_mode END AS host_assembly_size_mode_anchored FROM n WHERE ps = 'ok'"))
def g6_mode_rule(spark, sf_dir):
    return _record(spark, sf_dir).filter("partition_status = 'ok'").select("sample_id", "host_assembly_size_mode_anchored")


def _depth_record(spark, sf_dir):
    t = {n: domain(spark, sf_dir, n) for n in ("gene_table", "supplier_contigs", "alignments")}
    sheet = t["supplier_contigs"].groupBy("sample").agg(F.sum("length").alias("assembly_size")).withColumn("assembly_size", F.when(F.col("sample") % 2 == 0, F.col("assembly_size"))).withColumns({"read_length": F.lit(146), "total_bases": F.lit(1_000_000), "kmercov": F.lit(30.0)})
    return flows.depth_only(sheet, t["gene_table"], t["supplier_contigs"], t["alignments"])


@query(with_domain("gene_table supplier_contigs alignments", f"""WITH {_REGIONS}, {_SAMPLES}, st AS (SELECT c.sample, count(r.gene) AS n FROM (SELECT DISTINCT sample FROM supplier_contigs) c LEFT JOIN regions r ON r.sample = c.sample GROUP BY c.sample),
 asm AS (SELECT sample, sum(length)::BIGINT AS size FROM supplier_contigs GROUP BY sample)
SELECT st.sample AS sample_id, CASE WHEN n < 20 THEN 'too_few_busco_regions' WHEN coalesce(mean_depth, 0) = 0 THEN 'no_measurement' ELSE 'ok' END AS status, coalesce(regions, 0) AS busco_regions,
  round(CASE WHEN n >= 20 AND mean_depth <> 0 THEN mean_depth * (146 - 21 + 1) / 146 / 2 END, 9) AS lambda_depth, size AS assembly_size
FROM st LEFT JOIN weighted w ON w.sample = st.sample AND n >= 20 LEFT JOIN asm ON asm.sample = st.sample"""))
def h11_depth_only(spark, sf_dir):
    got = _depth_record(spark, sf_dir)
    return got.select("sample_id", "status", "busco_regions", F.round("lambda_depth", 9).alias("lambda_depth"), "assembly_size")


@query(with_domain("gene_table supplier_contigs alignments", f"""WITH {_REGIONS}, {_SAMPLES}, st AS (SELECT c.sample, count(r.gene) AS n FROM (SELECT DISTINCT sample FROM supplier_contigs) c LEFT JOIN regions r ON r.sample = c.sample GROUP BY c.sample)
SELECT st.sample AS sample_id, 'fit' || st.sample AS verdict, round(CASE WHEN n >= 20 AND mean_depth <> 0 THEN mean_depth * (146 - 21 + 1) / 146 / 2 END, 9) AS lambda_depth, coalesce(regions, 0) AS busco_regions
FROM st LEFT JOIN weighted w ON w.sample = st.sample AND n >= 20 WHERE st.sample % 3 < 2 UNION ALL SELECT 77, 'fit77', 0.5, 7"""))
def h11_depth_upload(spark, sf_dir):
    """The depth-only flow to its end: eight columns of known samples change, others are refused, what isn't measured stays."""
    stored = domain(spark, sf_dir, "supplier_contigs").select(F.col("sample").alias("sample_id")).distinct().filter("sample_id % 3 < 2").unionByName(spark.range(77, 78).withColumnRenamed("id", "sample_id"))
    stored = stored.withColumns({"verdict": F.concat(F.lit("fit"), F.col("sample_id").cast("string")), "lambda_depth": F.lit(0.5), "busco_regions": F.lit(7).cast("long"), "busco_read_depth": F.lit(0.0), "host_assembly_size": F.lit(1).cast("long"),
                                 "host_assembly_fraction": F.lit(0.0), "host_haploid_size": F.lit(1).cast("long"), "partition_confidence": F.lit("x"), "partition_note": F.lit("x")})
    kept, _ = flows.upload_depth(stored, _depth_record(spark, sf_dir), ["sample_id"])
    return kept.select("sample_id", "verdict", F.round("lambda_depth", 9).alias("lambda_depth"), "busco_regions")
