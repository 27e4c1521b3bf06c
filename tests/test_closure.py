"""Closures deeper than 63 steps, cycles, and numbers of nested clades against the closure."""

import re

import numpy as np
import pytest

from lanefold.operators import taxonomy as X


def test_closure_of_a_long_chain(spark):
    got = sorted(map(tuple, X.closure(spark.createDataFrame([(i, i - 1) for i in range(1, 101)], "taxid long, parent long")).collect()))
    assert got == sorted((i, a, i - a) for i in range(1, 101) for a in range(1, i + 1))


def test_closure_raises_on_cycles(spark):
    nodes = spark.createDataFrame([(1, 1), (2, 1), (3, 5), (4, 3), (5, 4)], "taxid long, parent long")
    with pytest.raises(ValueError, match="cycle"):
        X.closure(nodes)


def _random_nodes(rng, n):
    """A forest with dangling and own parents, and a long chain."""
    out = [(k, [None, k, 10**6, int(rng.integers(1, k))][int(rng.integers(0, 4)) if k % 40 == 0 else 3] if k > 1 else None) for k in range(1, n + 1)]
    out += [(n + k, n + k - 1) for k in range(1, 90)]
    return [(k, p, ["class", "order", "family", "phylum", "species"][int(rng.integers(0, 5))], f"n{k}" if k % 7 else "") for k, p in out]


def test_labels_and_lineages_on_random_trees(spark):
    rng = np.random.default_rng(2)
    nodes = spark.createDataFrame(_random_nodes(rng, 160), "taxid long, parent long, rank string, name string").cache()
    closed = X.closure(nodes).cache()
    labels = X.tree_labels(nodes).cache()
    rows = {r["taxid"]: r for r in labels.collect()}
    n = nodes.count()
    assert len(rows) == n and sorted(r["first"] - min(x["first"] for x in rows.values()) for r in rows.values()) == list(range(n))
    below = {}
    for t, a, d in closed.collect():
        below.setdefault(a, set()).add(t)
        assert rows[t]["level"] >= d
    for k, r in rows.items():
        assert {t for t, x in rows.items() if r["first"] <= x["first"] <= r["last"]} == below[k] and r["size"] == len(below[k])
    assert {r["taxid"] for r in X.clade_members(labels, [3, 100, 5555]).collect()} == below[3] | below[100]
    assert X.clade_members(labels, []).collect() == []
    assert sorted(map(tuple, X.lineage_of(nodes).collect())) == sorted(map(tuple, X.lineage(closed, nodes).collect()))
    assert X.tree_labels(nodes.limit(0)).collect() == []


def test_labels_raise_on_cycles(spark):
    nodes = spark.createDataFrame([(1, 1), (2, 1), (3, 5), (4, 3), (5, 4)], "taxid long, parent long")
    with pytest.raises(ValueError, match="cycle"):
        X.tree_labels(nodes)


def test_equal_names_are_compared_once_and_nothing_that_grows_is_broadcast(spark):
    names = ["alpha beta", "alpha betas", "gamma 17", "gamma 18", "gamma 17", "alpha beta", None, "", "--"]
    left, right = (spark.createDataFrame([(10 * i + o, n) for i, n in enumerate(names)], "id long, name string") for o in (1, 2))
    grams = lambda n: {w[i : i + 3] for w in (f"  {x} " for x in (n or "").replace("-", " ").split()) for i in range(len(w) - 2)}
    want = {}
    for i, x in enumerate(names):
        for j, y in enumerate(names):
            a, b = grams(x), grams(y)
            if a and b and len(a & b) >= 0.5 * len(a | b):
                want[10 * i + 1, 10 * j + 2] = len(a & b) / len(a | b)
    out = X.trigram_matches(left, right, 0.5)
    got = out.collect()
    assert len(got) == len(want) and {(r["left_id"], r["right_id"]): pytest.approx(r["similarity"]) for r in got} == want
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()


def _grams(name):
    return {w[i : i + 3] for w in (f"  {x} " for x in re.split("[^a-z0-9]+", name.lower()) if x) for i in range(len(w) - 2)}


def _alike(left, right, least):
    out = {}
    for i, a in enumerate(map(_grams, left)):
        for j, b in enumerate(map(_grams, right)):
            if a and b and len(a & b) / len(a | b) >= least:
                out[i, j] = len(a & b) / len(a | b)
    return out


def _joined(plan):
    """Rows that the joins of a finished plan have made."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return _joined(plan.executedPlan())
    below = [plan.plan()] if name.endswith("QueryStage") else [plan.children().apply(k) for k in range(plan.children().size())]
    own = [plan.metrics().get("numOutputRows").get().value()] if "Join" in name else []
    return own + [n for x in below for n in _joined(x)]


@pytest.mark.parametrize("least", [0.3, 0.65, 0.8, 1.0])
def test_trigram_matches_of_names_of_all_lengths(spark, least):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcd1"), int(rng.integers(1, 9))))
    base = [[word() for _ in range(k)] for k in (1, 1, 2, 3, 5, 9, 20, 40)]
    names = [" ".join([*w[: len(w) - int(rng.integers(0, len(w) // 4 + 1))], *[word()] * int(rng.integers(0, 2))]) for w in base * 5]
    left, right = [*names[:24], "ab cd", "cd-AB", "ab  cd", *["same name"] * 70], [*names[16:], "CD ab", *["name same"] * 3, "..."]
    want = _alike(left, right, least)
    out = X.trigram_matches(*(spark.createDataFrame(list(enumerate(x)), "id long, name string") for x in (left, right)), least).collect()
    assert len(out) == len(want) and {(r["left_id"], r["right_id"]): pytest.approx(r["similarity"]) for r in out} == want


def test_frequent_trigrams_do_not_pair_all_names(spark):
    left, right = ([f"Supplier#{k:09d}" for k in range(0, n, step)] for n, step in ((1000, 10), (15000, 50)))
    out = X.trigram_matches(*(spark.createDataFrame(list(enumerate(x)), "id long, name string") for x in (left, right)))
    want = _alike(left, right, 0.65)
    assert {(r["left_id"], r["right_id"]): pytest.approx(r["similarity"]) for r in out.collect()} == want
    joined = _joined(out._jdf.queryExecution().executedPlan())
    assert joined and max(joined) <= 2 * max(len(want), len(left) + len(right)) < 0.5 * len(left) * len(right)
