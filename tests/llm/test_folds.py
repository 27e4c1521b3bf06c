"""Samples of labelled rows."""

from lanefold.llm._folds import held_out, labelled_sample


def test_every_label_is_sampled(spark):
    rows = spark.range(4000).selectExpr("id AS doc_id", "concat('l', id % 1300) AS lang").union(spark.range(4000, 4400).selectExpr("id", "'common'"))
    got = [tuple(r) for r in labelled_sample(rows, "lang", 50).collect()]
    left = [tuple(r) for r in rows.filter(~held_out()).collect()]
    assert {r for r in left if r[1] != "common"} == {r for r in got if r[1] != "common"} and len({r[1] for r in left}) > 1200
    assert 20 < sum(r[1] == "common" for r in got) < 100
