"""Domain tables derived from the driver's tables.

Each is one SELECT that Spark and DuckDB both understand, so a query and its oracle start from equal rows.
``{G}`` stands for the flag that makes DuckDB's regexp_replace global, ``{EACH}(a, b))`` for a row for each number from a to b.
``reads`` holds the whole text of a document in pieces of 400 letters, whose halves are the mates; read_id is doc_id and the piece's number.
On Spark a text's letters are made once, for many texts together, and reads are cut from them in place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SEQ = "regexp_replace(translate(lower(coalesce(text, '')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC'), '[^ACGT]', ''{G})"

ADAPTERS = {
    "contigs": f"""SELECT sample, contig, seq, length(seq) AS length FROM (
        SELECT source AS sample, doc_id AS contig,
          CASE WHEN doc_id % 97 = 0 THEN concat(substr(s, 1, 50), 'NNNNNNNN', substr(s, 51)) ELSE s END AS seq
        FROM (SELECT source, doc_id, {_SEQ} AS s FROM {{documents}}) a) b WHERE length(seq) > 0""",
    "reads": f"""SELECT sample, read_id, mate, substr(piece, 1 + (mate - 1) * 200, 200) AS seq, translate(substr(piece, 1 + (mate - 1) * 200, 200), 'ACGT', 'I5#A') AS qual
        FROM (SELECT sample, doc_id * 1000000 + i AS read_id, substr(s, CAST(1 + i * 400 AS INT), 400) AS piece
          FROM (SELECT source AS sample, doc_id, s, {{EACH}}(0, CAST(floor((length(s) - 1) / 400) AS BIGINT))) AS i
            FROM (SELECT source, doc_id, {_SEQ} AS s FROM {{documents}}) a WHERE length(s) > 0) b) c CROSS JOIN (SELECT 1 AS mate UNION ALL SELECT 2 AS mate) m
        WHERE length(substr(piece, 1 + (mate - 1) * 200, 200)) > 0""",
    "alignments": """SELECT CAST(floor((l_suppkey % 100) / 10) AS BIGINT) AS sample, l_suppkey % 10 AS contig, (l_orderkey * 7 + l_linenumber * 13) % 5000 AS a_start,
          (l_orderkey * 7 + l_linenumber * 13) % 5000 + CAST(l_quantity AS BIGINT) AS a_end, l_linenumber * 8 AS mapq,
          CASE WHEN l_returnflag = 'R' THEN 256 WHEN l_returnflag = 'A' THEN 2 ELSE 16 END AS flag FROM {lineitem}""",
    "cigars": """SELECT CAST(floor((l_suppkey % 100) / 10) AS BIGINT) AS sample, l_suppkey % 10 AS contig, (l_orderkey * 7 + l_linenumber * 13) % 5000 AS a_start, l_linenumber * 8 AS mapq,
          CASE WHEN l_returnflag = 'R' THEN 256 WHEN l_returnflag = 'A' THEN 2 ELSE 16 END + CASE WHEN l_partkey % 50 = 0 THEN 4 ELSE 0 END AS flag, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_partkey % 6 END AS nm,
          CASE WHEN l_partkey % 50 = 0 THEN '*' ELSE concat(CASE WHEN l_linenumber % 3 = 0 THEN '5S' ELSE '' END, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 'M', CASE l_partkey % 5 WHEN 0 THEN '2D' WHEN 1 THEN '3I' WHEN 2 THEN '70N' WHEN 3 THEN '1P2D1I' ELSE '' END,
            CAST(1 + l_linenumber AS VARCHAR), CASE WHEN l_partkey % 2 = 0 THEN '=' ELSE 'X' END, CASE WHEN l_suppkey % 4 = 0 THEN '4H' ELSE '' END) END AS cigar FROM {lineitem}""",
    "gene_table": """SELECT CAST(floor((p_partkey % 100) / 10) AS BIGINT) AS sample, p_partkey AS gene, CASE p_size % 5 WHEN 0 THEN 'Missing' WHEN 1 THEN 'Fragmented' WHEN 2 THEN 'Duplicated' ELSE 'Complete' END AS status,
          p_partkey % 10 AS contig, CASE WHEN p_size % 2 = 0 THEN p_partkey * 3 % 4000 + 300 ELSE p_partkey * 3 % 4000 END AS g_start,
          CASE WHEN p_size % 2 = 0 THEN p_partkey * 3 % 4000 ELSE p_partkey * 3 % 4000 + 300 END AS g_end,
          CASE WHEN p_size % 2 = 0 THEN '-' ELSE '+' END AS strand FROM {part}""",
    "doc_genes": """SELECT p_partkey % 10 AS sample, p_partkey AS gene, CASE p_size % 5 WHEN 0 THEN 'Missing' WHEN 1 THEN 'Fragmented' WHEN 2 THEN 'Duplicated' ELSE 'Complete' END AS status, CAST(floor(p_partkey / 10) AS BIGINT) AS contig,
          CASE WHEN p_size % 2 = 0 THEN p_partkey * 3 % 400 + 300 ELSE p_partkey * 3 % 400 END AS g_start, CASE WHEN p_size % 2 = 0 THEN p_partkey * 3 % 400 ELSE p_partkey * 3 % 400 + 300 END AS g_end,
          CASE WHEN p_size % 2 = 0 THEN '-' ELSE '+' END AS strand FROM {part}""",
    "supplier_contigs": """SELECT sample, contig, max(length) AS length FROM (SELECT CAST(floor((s_suppkey % 100) / 10) AS BIGINT) AS sample, s_suppkey % 10 AS contig, 3500 + s_suppkey % 900 AS length FROM {supplier}) a GROUP BY sample, contig""",
    "contig_depth": """SELECT l_partkey % 20 AS sample, l_partkey AS contig, CAST(sum(CAST(l_quantity AS BIGINT)) * 3 AS BIGINT) AS length,
          CAST(7 + l_partkey * 37 % 200 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS meandepth FROM {lineitem} GROUP BY l_partkey""",
    "hist": """SELECT sample, cov, CAST(noise + floor(80000000 / (cov * cov * cov))
          + CASE WHEN sample % 4 = 0 THEN 0 ELSE greatest(0, 40000 - abs(cov - 40 - 4 * sample) * 2000) END AS BIGINT) AS cnt
        FROM (SELECT l_suppkey % 10 AS sample, l_partkey % 250 + 1 AS cov, count(*) AS noise FROM {lineitem} GROUP BY l_suppkey % 10, l_partkey % 250 + 1) a""",
    "fits": """SELECT c_custkey AS sample,
          CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 100000000 + c_custkey * 7919 % 500000000 END AS size_min,
          CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 0 ELSE 100000000 + c_custkey * 7919 % 500000000 + c_custkey % 5 * 1000 END AS size_max,
          CAST(40 + c_custkey * 13 % 60 AS DOUBLE) AS fit_all, CAST(40 + c_custkey * 17 % 60 AS DOUBLE) AS fit_full,
          CASE WHEN c_custkey % 9 = 0 THEN CAST(0 AS DOUBLE) ELSE c_custkey % 10 * CAST(0.25 AS DOUBLE) END AS het_min,
          CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN CAST(120 AS DOUBLE) ELSE c_custkey % 29 * CAST(0.5 AS DOUBLE) END AS het_max,
          CAST(5 + c_custkey % 50 AS DOUBLE) AS kmercov, c_custkey % 13 * CAST(0.5 AS DOUBLE) AS bias,
          CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 3 + c_custkey * 3 % 120 END AS peak_cov,
          80000000 + c_custkey * 104729 % 900000000 AS assembly_size,
          CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(1 + c_custkey * 11 % 40 AS DOUBLE) + CAST(0.25 AS DOUBLE) END AS lam,
          CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 60000000 + c_custkey * 15485863 % 400000000 END AS host_size,
          CASE WHEN c_custkey % 5 = 0 THEN 'no_host_depth' ELSE 'ok' END AS partition_status,
          CASE WHEN c_custkey % 3 = 0 THEN 'low' ELSE 'high' END AS partition_confidence,
          c_custkey * 7 % 100 AS busco_complete, 1000000000 + c_custkey * 32452843 % 30000000000 AS bases_before,
          900000000 + c_custkey * 32452843 % 29000000000 AS bases_after FROM {customer}""",
    "tax_nodes": """SELECT 1 AS taxid, CAST(NULL AS BIGINT) AS parent, 'clade' AS rank, 'root' AS name
        UNION ALL SELECT 10 + r_regionkey, 1, 'class', r_name FROM {region}
        UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 'order', n_name FROM {nation}
        UNION ALL SELECT 1000 + s_suppkey, 100 + s_nationkey, 'family', s_name FROM {supplier}
        UNION ALL SELECT 1000000 + p_partkey, 1000 + 1 + p_partkey % 10, 'species', p_name FROM {part}""",
    "jobs": """SELECT o_orderkey AS job_id, CASE WHEN o_orderkey % 5 = 0 THEN 'gpu' WHEN o_orderkey % 5 = 1 THEN 'highmem' WHEN o_orderkey % 7 = 0 THEN 'copy' ELSE 'work' END AS job_partition,
          CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'COMPLETED' ELSE 'TIMEOUT' END AS state,
          1 + o_orderkey % 64 AS cores, 1 + o_orderkey % 3 AS nodes, 60 + o_orderkey * 37 % 20000 AS elapsed_s, 3600 + o_orderkey % 6 * 3600 AS limit_s,
          30 + o_orderkey * 41 % 90000 AS cpu_s, CAST(1 + o_orderkey % 220 AS DOUBLE) AS mem_gb, CAST(o_orderkey * 3 % 180 AS DOUBLE) AS rss_gb,
          concat('PIPE:', CASE o_orderkey % 4 WHEN 0 THEN 'TRIM' WHEN 1 THEN 'KMER' WHEN 2 THEN 'ASSEMBLE' ELSE 'REPORT' END) AS process,
          CASE WHEN o_orderkey % 9 = 0 THEN 'shared' ELSE concat('OG', CAST(o_custkey % 50 AS VARCHAR)) END AS tag FROM {orders}""",
    "files": """SELECT user_id % 40 AS sample, event_type AS component, event_id, CAST(floor(abs(value) * 100) AS BIGINT) AS bytes,
          CASE WHEN event_id % 3 = 0 THEN 'remote' ELSE 'local' END AS side FROM {events}""",
    "hits": """SELECT l_orderkey AS query, l_suppkey AS subject, CAST(95 + l_discount * 100 - floor(l_discount * 20) AS DOUBLE) AS identity,
          CAST(l_linenumber * 100 AS BIGINT) AS q_start, CAST(l_linenumber * 100 + l_quantity * 8 AS BIGINT) AS q_end FROM {lineitem}""",
    "actions": """SELECT source AS sample, doc_id AS contig, CASE doc_id % 4 WHEN 0 THEN 'EXCLUDE' WHEN 1 THEN 'TRIM' ELSE 'REVIEW' END AS action,
          CASE WHEN doc_id % 4 = 1 THEN 1 + n_chars % 50 ELSE 1 END AS a_start, CASE WHEN doc_id % 4 = 1 THEN 40 + n_chars % 50 ELSE n_chars END AS a_end
        FROM {documents} WHERE doc_id % 5 < 2 AND n_chars > 100""",
    "gene_contigs": f"""SELECT CAST(doc_id % 10 AS BIGINT) AS sample, CAST(floor(doc_id / 10) AS BIGINT) AS contig, seq FROM (SELECT doc_id, {_SEQ} AS seq FROM {{documents}}) a WHERE length(seq) > 0""",
    "adaptor_report": """SELECT source AS sample, doc_id AS contig, n_chars AS length, CASE WHEN doc_id % 3 = 0 THEN 'ACTION_TRIM' WHEN doc_id % 7 = 0 THEN 'ACTION_EXCLUDE' ELSE 'FOUND' END AS action,
          CASE WHEN doc_id % 3 = 0 THEN concat(CAST(5 + doc_id % 20 AS VARCHAR), '..', CAST(30 + doc_id % 20 AS VARCHAR)) ELSE '' END AS ranges FROM {documents} WHERE doc_id % 4 = 2 AND n_chars > 100""",
    "fastq_files": """SELECT concat('/in/OG', CAST(user_id % 200 AS VARCHAR), CASE event_id % 7 WHEN 0 THEN '.R1.fastq.gz' WHEN 1 THEN '.ilmn_R2.fq.gz'
          WHEN 2 THEN concat('.a_R1_', CAST(event_id % 3 AS VARCHAR), '.fq') WHEN 3 THEN '.R2.fastq' WHEN 4 THEN '.R1.txt' ELSE '.plain.fq' END) AS path FROM {events}""",
    "classes": """SELECT coalesce(source, '?') AS sample, concat('c', CAST(doc_id AS VARCHAR), ' len=', CAST(coalesce(n_chars, 0) AS VARCHAR), chr(9), CASE doc_id % 7 WHEN 0 THEN 'eukarya' WHEN 1 THEN concat('organelle', chr(9), 'mitochondrion')
          WHEN 2 THEN 'bacteria' WHEN 3 THEN 'archaea' WHEN 4 THEN 'prokarya' WHEN 5 THEN concat('organelle', chr(9), 'plastid') ELSE 'notbacteria' END) AS line FROM {documents}""",
    "contig_classes": """SELECT source AS sample, concat(CAST(doc_id AS VARCHAR), ' len=', CAST(coalesce(n_chars, 0) AS VARCHAR), chr(9), CASE doc_id % 9 WHEN 1 THEN 'bacteria' WHEN 4 THEN concat('organelle', chr(9), 'plastid') ELSE 'eukarya' END) AS line FROM {documents}""",
    "curated": """SELECT CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_partkey END AS taxid, p_type AS class, concat(p_name, ' ', p_brand) AS species,
          concat(p_brand, ', syn ', CAST(p_partkey % 50 AS VARCHAR)) AS synonym, split_part(p_name, ' ', 1) AS genus, concat(p_type, 'idae') AS family, concat(p_type, 'iformes') AS order_name FROM {part}""",
    "asked": """SELECT id, raw, raw AS clean, split_part(raw, ' ', 1) AS genus FROM (SELECT c_custkey AS id, CASE c_custkey % 9 WHEN 0 THEN concat('COLD widget Brand#', CAST(c_custkey % 30 AS VARCHAR))
          WHEN 1 THEN concat('syn ', CAST(c_custkey % 70 AS VARCHAR)) WHEN 2 THEN 'large unknowna' WHEN 3 THEN 'ECONOMYidae' WHEN 4 THEN 'promoiformes' WHEN 5 THEN 'ECONOMYida' WHEN 6 THEN 'PROMOiforme'
          WHEN 7 THEN 'Zzz sp. x' ELSE 'zzz 3q' END AS raw FROM {customer}) a""",
    "components": """SELECT user_id % 60 AS og_id, concat('2', CAST(event_id % 2 AS VARCHAR)) AS seq_date, event_type AS component, event_id % 4 <> 0 AS parsed,
          concat('f', CAST(event_id AS VARCHAR), CASE WHEN event_id % 5 = 0 THEN '_reseeded_' ELSE '' END, CASE WHEN event_id % 3 = 0 THEN '.error.meta.' ELSE '.x.' END) AS name FROM {events}""",
    "sequencing": """SELECT o_custkey AS og_id, concat('d', CAST(o_orderkey % 3 AS VARCHAR)) AS seq_date, o_orderkey AS sequencing_id, CASE WHEN o_orderkey % 4 = 0 THEN 'PacBio' ELSE 'Illumina' END AS technology,
          CASE WHEN o_orderkey % 5 = 0 THEN 'hic' WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'illumina' END AS library_type, CASE WHEN o_orderkey % 2 = 0 THEN 'NovaSeq' ELSE 'NextSeq' END AS instrument FROM {orders}""",
    "drafts": """SELECT c_custkey AS og_id, concat('d', CAST(c_custkey % 3 AS VARCHAR)) AS seq_date, CASE c_custkey % 5 WHEN 0 THEN 'iSEQ' WHEN 1 THEN 'NEXT' ELSE 'NOVA' END AS mach FROM {customer}""",
    "steps": """SELECT CAST(o_orderkey AS VARCHAR) AS jobid, CASE WHEN o_orderkey % 10 = 0 THEN 'RUNNING' WHEN o_orderkey % 3 = 0 THEN 'CANCELLED by 1' ELSE 'COMPLETED' END AS state, 2 + o_orderkey % 64 AS alloc_cpus, CAST(NULL AS BIGINT) AS ave_rss, CAST(NULL AS BIGINT) AS ntasks FROM {orders}
        UNION ALL SELECT concat(CAST(l_orderkey AS VARCHAR), '.', CAST(l_linenumber AS VARCHAR)), 'COMPLETED', 2, l_partkey * 1000, CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_quantity AS BIGINT) END FROM {lineitem}""",
    "job_meta": """SELECT o_orderkey % 5000 AS job_id, o_orderkey AS ord, concat('P', CAST(o_orderkey % 4 AS VARCHAR)) AS process, concat('T', CAST(o_custkey % 7 AS VARCHAR)) AS tag FROM {orders} WHERE o_orderkey % 3 <> 0""",
    "checkpoints": """SELECT event_id AS id, event_id % 11 <> 0 AS present, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'old' ELSE 'k' END AS stored_key, 'k' AS key, event_id % 3 = 0 AS done,
          event_id % 5 <> 0 AS has_output, event_id % 7 < 4 AS checkpoint FROM {events}""",
    "tool_versions": """SELECT p_type AS grp, split_part(p_name, ' ', 2) AS tool, concat(CASE WHEN p_partkey % 20 = 3 THEN 'run/software_versions_' ELSE 'a/versions_' END, CAST(p_partkey AS VARCHAR)) AS path, CAST(p_size AS VARCHAR) AS version FROM {part}""",
    "sheet": """SELECT CASE WHEN c_custkey % 13 = 0 THEN concat('X', CAST(c_custkey AS VARCHAR)) ELSE concat('OG', CAST(c_custkey % 40 AS VARCHAR), CASE c_custkey % 3 WHEN 0 THEN 'M-1' ELSE '' END) END AS sample,
          CASE WHEN c_custkey % 17 = 0 THEN 'bad run' ELSE 'NOVA_250131_AD' END AS run, CASE WHEN c_custkey % 11 = 0 THEN 'Jan' ELSE '250131' END AS date, concat('p', CAST(c_custkey AS VARCHAR)) AS prefix, c_name AS nom_species_id,
          CASE c_custkey % 7 WHEN 0 THEN 'unknown' WHEN 1 THEN 'x' WHEN 2 THEN NULL ELSE '77' END AS taxon_id, c_mktsegment AS class, concat('/in/', CAST(c_custkey AS VARCHAR), '.R1.fq.gz') AS fastq_1,
          concat('/in/', CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 19 = 0 THEN '_2.fq.gz' ELSE '.R2.fastq.gz' END) AS fastq_2 FROM {customer}""",
    "draft_files": """SELECT concat('OG', CAST(user_id % 60 AS VARCHAR)) AS og_id, CASE WHEN event_id % 3 = 0 THEN '250131' ELSE '250214' END AS seq_date, CASE event_id % 4 WHEN 0 THEN 'fastp' WHEN 1 THEN 'busco' WHEN 2 THEN 'hist' ELSE 'depth' END AS component,
          concat('/d/OG', CAST(user_id % 60 AS VARCHAR), CASE WHEN event_id % 5 = 0 AND user_id % 3 = 0 THEN '.ilmn.NOVA_250131_AD.' ELSE '.ilmn.250214.' END, CASE event_id % 4 WHEN 0 THEN 'fastp.json' WHEN 1 THEN 'full_table.tsv' WHEN 2 THEN 'meryl.hist' ELSE 'other' END) AS path FROM {events}""",
    "matches": """SELECT concat('OG', CAST(c_custkey AS VARCHAR)) AS og_id, c_name AS nominal_species_id, CASE c_custkey % 6 WHEN 0 THEN 'species_exact' WHEN 1 THEN 'synonym_exact' WHEN 2 THEN 'genus_exact' WHEN 3 THEN 'family_fuzzy' WHEN 4 THEN 'order_fuzzy' END AS match_level,
          CASE WHEN c_custkey % 6 < 5 AND c_custkey % 5 > 1 THEN c_custkey * 10 END AS db_taxid, CASE WHEN c_custkey % 6 < 5 AND c_custkey % 7 > 1 THEN 'dbclass' END AS db_class,
          CASE WHEN c_custkey % 4 > 0 THEN c_custkey * 100 END AS tax_taxid, CASE WHEN c_custkey % 4 > 1 THEN 'taxclass' END AS tax_class, CASE WHEN c_custkey % 4 > 0 THEN 'genus' END AS tax_rank FROM {customer}""",
}
_TABLE = re.compile(r"\{(\w+)\}")
#: The base of each letter of either case, all other bytes, the two signs outside ASCII whose lower case has a letter, and qualities by base.
_BASES = bytes.maketrans(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b"ACGTACGTACGTACGTACGTACGTAC" * 2)
_OTHERS = bytes(c for c in range(256) if not chr(c).isascii() or not chr(c).isalpha())
_LOWERED = (("\u0130".encode(), b"i"), ("\u212a".encode(), b"k"))
_QUALITIES = bytes.maketrans(b"ACGT", b"I5#A")
#: Fixed value: letters of a mate. Letters that leave a task at once.
MATE, LETTERS = 200, 1 << 22


def _spread(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Texts dealt to all cores where their files have fewer partitions than these; work on texts outweighs that shuffle.

    Larger inputs have more partitions than cores and are read where they are.
    """
    cores = spark.sparkContext.defaultParallelism
    return documents.repartition(cores) if documents.rdd.getNumPartitions() < cores else documents


def _letters(texts: pa.Array) -> list[bytes]:
    """The letters of each text (null: none), as ``_SEQ`` has them."""
    out = []
    for raw in texts.cast(pa.binary()).to_pylist():
        for sign, letter in _LOWERED:
            raw = (raw or b"").replace(sign, letter)
        out.append(raw.translate(_BASES, _OTHERS))
    return out


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows with the letters of their last column, as many at once as have about ``LETTERS``."""
    for batch in batches:
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0), np.int64)) // LETTERS
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                rows = batch.slice(a, b - a)
                yield rows, _letters(rows.column(rows.num_columns - 1))


def _with_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, letters in _some(batches):
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(letters, pa.binary()).cast(pa.string())], names=["doc_id", "source", "letters"])


def _reads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``reads``: a text's letters are cut every ``MATE``, two cuts are a piece."""
    for rows, letters in _some(batches):
        size = np.array([len(x) for x in letters], np.int64)
        cuts = -(-size // MATE)
        owner = np.repeat(np.arange(len(size)), cuts)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        ends = np.concatenate([[0], np.cumsum(np.minimum(MATE, size[owner] - k * MATE))]).astype(np.int32)
        seq = b"".join(letters)
        text = lambda raw: pa.Array.from_buffers(pa.string(), len(owner), [None, pa.py_buffer(ends), pa.py_buffer(raw)])  # noqa: B023, E731
        at = pa.array(owner)
        read = pc.add_checked(pc.multiply_checked(rows.column(0).take(at), 1_000_000), pa.array(k // 2))
        yield pa.RecordBatch.from_arrays([rows.column(1).take(at), read, pa.array((k % 2 + 1).astype(np.int32)), text(seq), text(seq.translate(_QUALITIES))], names=["sample", "read_id", "mate", "seq", "qual"])


def domain(spark: SparkSession, sf_dir: str, name: str, where: str = "true") -> DataFrame:
    """One domain table, for a table of texts of those documents that meet ``where``."""
    sql = ADAPTERS[name].replace("{G}", "").replace("{EACH}", "explode(sequence")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(_TABLE.findall(sql))}
    if "documents" in tables and "text" in sql:
        texts = _spread(spark, tables["documents"].filter(where).select(F.col("doc_id").cast("long"), "source", "text"))
        if name == "reads":
            return texts.mapInArrow(_reads, "sample string, read_id long, mate int, seq string, qual string")
        tables["documents"] = texts.mapInArrow(_with_letters, "doc_id long, source string, letters string")
        sql = sql.replace(_SEQ.replace("{G}", ""), "letters")
    return spark.sql(sql.replace("VARCHAR", "STRING"), **tables)


def with_domain(names: str, sql: str) -> str:
    """``sql`` for DuckDB with the named domain tables in front."""
    duck = {n: ADAPTERS[n].replace("{G}", ", 'g'").replace("{EACH}", "unnest(generate_series") for n in names.split()}
    parts = [f"{n} AS ({_TABLE.sub(lambda m: m[1], t)})" for n, t in duck.items()]
    sql = sql.strip()
    return "WITH " + ", ".join(parts) + (", " + sql[5:] if sql.upper().startswith("WITH ") else " " + sql)
