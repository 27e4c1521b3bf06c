"""Phrases and their scores against brute force, with tiny shards, with a bitmap that lets everything through, and at the edges."""

import re
from collections import Counter

import numpy as np
import pytest

from lanefold.llm import collocations as co

RNG = np.random.default_rng(3)
SCHEMA = "lang string, text string, f int"


def grams(rows, longest=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    return f, n


def brute(rows, least, top):
    f, n = grams(rows)
    often = {k: v for k, v in f.items() if v >= least}
    wide = Counter()
    for (lang, p), v in often.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                wide[lang, p[i : i + m]] = max(wide[lang, p[i : i + m]], v)
    out = {}
    for (lang, p), a in often.items():
        if len(p) > 1 and wide[lang, p] < a:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, r, n[lang], -s) for lang, found in out.items() for rank, (s, a, p, left, r) in enumerate(sorted(found)[:top], 1))


def rows_of(n=220):
    words = ["the", "of", "The", "é", "ÉA", "x|y", "a-b", "　", "z" * 50, "q\x1cq", *[f"w{k}" for k in range(30)]]
    p = np.array([1 / (k + 1) for k in range(len(words))])
    ends = [" ", "  ", "\t", ". ", ",", "\n", " ? ", "\r\n", "\x0b"]
    out = []
    for k in range(n):
        said = RNG.choice(words, int(RNG.integers(0, 60)), p=p / p.sum())
        out.append((("en", "de", None, "und")[k % 4], "".join(w + (" " if RNG.random() < 0.7 else str(RNG.choice(ends))) for w in said)))
    fixed = "New York city Hall. new york city hall; new york"
    return [*out, *[("en", fixed)] * 6, ("en", None), (None, ""), ("fr", ".,;"), ("de", "a a a a a a a a a"), ("de", "one two three four five six seven " * 5)]


ROWS = rows_of()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1) for r in ROWS], SCHEMA).repartition(5)


@pytest.mark.parametrize("shard", [1, 50, 1 << 20])
def test_against_brute_force(docs, shard):
    got = sorted(tuple(r) for r in co.collocations(docs, least=4, top=60, shard=shard).collect())
    assert got == brute(ROWS, 4, 60)
    assert {r[0] for r in got} == {"en", "de", "und"} and any(r[2] == "new york city hall" for r in got)


def test_bitmap_that_lets_all_through(docs, monkeypatch):
    full = co.Bitmap(15, {0: b"\xff" * 4096})
    monkeypatch.setattr(co, "bitmap", lambda *a, **k: full)
    assert sorted(tuple(r) for r in co.collocations(docs, least=4, top=60).collect()) == brute(ROWS, 4, 60)


def test_bitmap_knows_its_hashes(spark):
    h = [int(x) for x in RNG.integers(-(2**63), 2**63 - 1, 3000)]
    found = co.bitmap(spark.createDataFrame([(x,) for x in h], "h long"))
    assert all((x % 2**64) in found for x in h) and found.has(np.array(h).view(np.uint64)).all()
    others = RNG.integers(-(2**63), 2**63 - 1, 3000).view(np.uint64)
    assert found.has(others).mean() < 0.1 and [int(x) in found for x in others] == found.has(others).tolist()


def test_numbers_hash_as_spark_does(spark):
    r = spark.createDataFrame([("dé", "wörd")], "lang string, word string").select(co.word_hash("lang", "word")).head()[0]
    n = co.Numbers("dé", co.Bitmap(15, {0: b"\xff" * 4096}))
    assert n["wörd".encode()] == 1 and n.hashes[1] == r % 2**64


def test_shard_intervals():
    text = RNG.integers(0, 4, 400)
    text[-1] = 0
    want = Counter()
    for m in range(2, 6):
        for i in range(400 - m + 1):
            if (text[i : i + m] > 0).all():
                want[tuple(text[i : i + m].tolist())] += 1
    said, got, hashes = [(k,) for k in range(4)], Counter(), RNG.integers(0, 2**63, 4).astype(np.uint64)
    for whose, word, count, right, h in co.Shard(text, 5).phrases(hashes, {}):
        said = [said[a] + (b,) if right else (b,) + said[a] for a, b in zip(whose.tolist(), word.tolist(), strict=True)]
        assert len(set(said)) == len(said)
        assert h.tolist() == [sum(int(hashes[w]) * pow(co.ODD, i, 2**64) for i, w in enumerate(p)) % 2**64 for p in said]
        got.update(dict(zip(said, count.tolist(), strict=True)))
    assert got == want


def test_long_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(co, "SLICE", 64)
    assert [w for part in co.words_of(b"Ab c.\td" + b"e" * 200 + b" f" * 100) for w in part] == [b"ab", b"c", b"\xff", b"d" + b"e" * 200, *[b"f"] * 100, b"\xff"]
    assert co.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert co.collocations(spark.createDataFrame([("en", None, 1), (None, " ", 2)], SCHEMA), least=1).collect() == []
