"""Columns whose names an operator uses on the way or makes, through every operator that takes documents."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lanefold.llm import collocations, decontaminate, language, language_model, mixing, periodicity, simhash, suffix_dedup, toxicity

CLASH = ["t1", "_t1", "r1", "r2", "size", "score", "items", "_found", "_size", "_h", "_n", "_block", "_id", "target", "shards", "shard", "position", "lang_pred", "n_hit", "fp", "word", "row", "h", "y", "SPANS"]
TEXTS = ["one two three four five six seven eight", "un deux trois quatre cinq six sept", None, "", "one two three four five six seven eight", "ab " * 300, "ten more words that stand in no other text of this table"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, ("en", "fr")[k % 2], f"s{k % 2}") for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit(f"<{c}>") for c in CLASH}).cache()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "un deux trois quatre cinq six sept"), (2, None)], "item_id long, text string")


def test_made_columns_replace_and_others_stay(spark, docs, items):
    labels = spark.createDataFrame([(0, 1)], "doc_id long, toxic int")
    for name, rows in {
        "cut": suffix_dedup.cut_repeats(docs), "plan": mixing.plan_mix(docs), "hit": decontaminate.contamination(docs, items), "lang": language.predict(docs, language.train(docs)),
        "tox": toxicity.score(docs, toxicity.train(docs, labels)), "runs": periodicity.find_runs(docs),
    }.items():
        got = {r["doc_id"]: r for r in rows.collect()}
        assert len(got) == len(TEXTS), name
        made = {"plan": {"size", "target", "shards"}, "hit": {"items", "n_hit", "SPANS"}, "lang": {"lang_pred", "score"}, "tox": {"score", "SPANS"}}.get(name, set())
        for k, r in got.items():
            assert r["text"] == TEXTS[k] and all(r[c] == f"<{c}>" for c in CLASH if c not in made), name


def test_filters_give_back_their_columns(spark, docs, items):
    for name, rows in {"one": simhash.keep_one(docs), "clean": decontaminate.decontaminated(docs, items), "known": language.recognised(docs, floor=0.0), "mixed": mixing.mixed(docs)}.items():
        assert rows.columns == docs.columns, name
        got = rows.collect()
        assert got and all(r[c] == f"<{c}>" for r in got for c in CLASH), name
    stages = dict(corpus_pipeline.STAGES)
    assert stages["mixture"](spark, docs, "").columns == docs.columns


def test_others(docs):
    counts = language_model.word_counts(docs)
    head = language_model.head_of(counts)
    assert language_model.score_texts(docs, counts, head, None).count() == len(TEXTS)
    assert collocations.collocations(docs, least=2).count() > 0 and simhash.near_duplicates(docs).count() == len(TEXTS)


def test_one_of_rows_that_differ_elsewhere(spark):
    rows = [(1, "same text", "a"), (1, "same text", "b"), (1, "same text", "b")]
    kept = {tuple(simhash.keep_one(spark.createDataFrame(order, "doc_id long, text string, other string").repartition(n)).head()) for order in (rows, rows[::-1]) for n in (1, 3)}
    assert len(kept) == 1
