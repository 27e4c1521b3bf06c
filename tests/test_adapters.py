"""The reads table against plain Python: every letter of every document, once."""

import re

import duckdb

from lanefold.sources.adapters import domain, with_domain

_MAP = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")
DOCS = [(1, "abc " * 400), (2, "z" * 400), (3, "y" * 401), (4, "x, " * 201), (5, "q" * 200), (6, ""), (7, "1 2"), (8, None), (9, "The End"), (10, "lorem ipsum dolor " * 5000)]


def test_reads_hold_whole_documents(spark, tmp_path):
    spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "'s' AS source").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for doc, text in DOCS:
        s = re.sub("[^ACGT]", "", (text or "").lower().translate(_MAP))
        for at in range(0, len(s), 200):
            seq = s[at : at + 200]
            want.append(("s", doc * 1000000 + at // 400, 1 + at // 200 % 2, seq, seq.translate(str.maketrans("ACGT", "I5#A"))))
    cols = "sample, read_id, mate, seq, qual"
    got = sorted(map(tuple, domain(spark, str(tmp_path), "reads").select(*cols.split(", ")).collect()))
    assert got == sorted(want)
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(duck.sql(with_domain("reads", f"SELECT {cols} FROM reads")).fetchall()) == sorted(want)


def test_letters_equal_those_of_the_sql(spark, tmp_path, monkeypatch):
    from lanefold.sources import adapters

    monkeypatch.setattr(adapters, "LETTERS", 50)
    odd = ["\u0130stanbul", "300 \u212a", "\u00c5\u00df\ufb01\u017f \u0391\u03a3", "a\tB\nc\x00d", "[Z]`z{", "\u1e9e\U0001f600q"]
    docs = [*DOCS, *((20 + k, x) for k, x in enumerate(odd))]
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "if(doc_id % 3 = 0, null, 's') AS source").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    documents = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name in ("contigs", "reads", "gene_contigs"):
        sql = adapters.ADAPTERS[name].replace("{G}", "").replace("{EACH}", "explode(sequence").replace("VARCHAR", "STRING")
        want, got = spark.sql(sql, documents=documents), domain(spark, str(tmp_path), name)
        assert got.dtypes == want.dtypes and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr), name
        assert "regexp_replace" not in got._jdf.queryExecution().toString()  # letters of many texts together, not sign by sign
