"""The language model: exact counts and normalisation, gain over counts on held-out texts, defined edges."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lanefold.llm import language_model as lm
from lanefold.llm.queries import QUERIES

RNG = np.random.default_rng(5)
SCHEMA = "doc_id long, text string"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [""]


def fold(k):
    return zlib.crc32(str(k).encode()) % 5


def corpus():
    """Two vocabularies with rare words; the next word depends on the one before."""
    out = []
    for k in range(400):
        name, w = "ab"[k % 2], 0
        words = []
        for _ in range(int(RNG.integers(1, 80))):
            w = int((w * 7 + RNG.integers(0, 3)) % 40) if RNG.random() < 0.9 else int(RNG.integers(0, 100_000))
            words.append(f"{name}{w}{name}" if w % 5 else f"É{w}".upper())
        out.append(" ".join(words))
    return [*out, None, "", " \t\n ", out[0], out[0], "x" * 300 + " " + "x" * 300, "a1a " * 50_000]


ROWS = [(k - 2, t) for k, t in enumerate(corpus())] + [(7, "A1a b2b"), (7, "A1a b2b"), (None, "a1a nowhere")]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("lm"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    return d


def test_query(spark, sf):
    c = Counter(w for k, t in ROWS if k is not None and fold(k) != 1 for w in tokens(t))
    n, v = sum(c.values()), len(c)
    got = QUERIES["op12_language_model"](spark, sf).collect()

    def base(t):
        return sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))

    want = sorted((-99 if k is None else k, k is not None and fold(k) == 1, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(base(t), 4)) for k, t in ROWS)
    assert sorted((-99 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    held = [r for r in got if r["held_out"]]
    assert len(held) > 50 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.1 * sum(r["n_tokens"] for r in held)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_small_head_gives_the_same_counts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = lm.word_counts(docs.filter(lm.fold() != 1)).cache()
    all_of, some = lm.head_of(counts), lm.head_of(counts, most=20)
    assert len(some.words) <= 21 < len(all_of.words) and (some.tokens, some.distinct, some.shared.tolist()) == (all_of.tokens, all_of.distinct, all_of.shared.tolist())
    assert all(len(w) <= lm.HEAD_BYTES for w in all_of.words)
    weights = lm.LogBilinear(lm.Vocabulary(some, 9).classes).packed()
    one, two = (sorted(lm.score_texts(docs, counts, h, weights, words=9).fillna(-99).collect()) for h in (all_of, some))
    for a, b in zip(one, two, strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:], atol=1e-3)


def test_probabilities_add_up_to_one(spark, sf):
    counts = lm.word_counts(spark.read.parquet(f"{sf}/documents.parquet")).cache()
    head = lm.head_of(counts)
    v = lm.Vocabulary(head, 30)
    scorer = lm.Scorer(lm.LogBilinear(v.classes, seed=3).packed().tobytes(), v.classes)
    every = np.arange(v.classes)
    for near, far in ((3, 70), (lm.SHARED, lm.SHARED), (80, 80)):
        p = 10 ** scorer(np.full(v.classes, near), np.full(v.classes, far), every)
        assert abs(p.sum() - 1) < 1e-4
        c = {r["word"].encode(): r["c"] for r in counts.collect()}
        own = {w for w, k in zip(head.words, v.of.tolist()) if k >= lm.SHARED}
        share = np.zeros(lm.SHARED)
        for w in c.keys() - own:
            k = lm.shared_class(w)
            share[k] += 10 ** (math.log10(c[w] + 0.5) - v.log_of_shared[k])
        share += 0.5 / 10**v.log_of_shared  # one unseen word each
        assert np.allclose(share, 1)


def test_contexts_end_at_texts():
    near, far, w = lm.contexts(np.array([70, 71, lm.SHARED, lm.SHARED, 72, lm.SHARED]), np.array([3, 1, 2]))
    s = lm.SHARED
    assert near.tolist() == [s, 70, 71, s, s, 72] and far.tolist() == [s, s, 70, s, s, s]


def test_nothing_to_learn_from(spark, tmp_path):
    held = [k for k in range(40) if fold(k) == 1]
    spark.createDataFrame([(k, "some words" if k else None) for k in held], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_language_model"](spark, str(tmp_path)).collect()
    assert len(got) == len(held) and all((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0) for r in got if r["doc_id"])
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op12_language_model"](spark, f"{tmp_path}/none").collect() == []
