"""Runs of words against brute force over all periods, and through the registered query."""

import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

from lanefold.llm import periodicity
from lanefold.llm.queries import QUERIES

RNG = np.random.default_rng(7)


def brute(s, least=24, times=3):
    """Every run, from the places where neighbours at a distance are equal."""
    out, n = [], len(s)
    for p in range(1, n // times + 1):
        k = 0
        while k < n - p:
            e = k
            while e < n - p and s[e] == s[e + p]:
                e += 1
            length = e - k + p
            if length >= max(least, times * p) and all(any(s[k + x] != s[k + x + q] for x in range(length - q)) for q in range(1, p)):
                out.append((k, length, p))
            k = max(e, k + 1)
    return sorted(out)


def sample(n, letters):
    s = RNG.integers(0, letters, n).tolist()
    if RNG.random() < 0.6:
        a, p = int(RNG.integers(0, n)), int(RNG.integers(1, 12))
        s = s[:a] + (s[a : a + p] * n)[: n - a]
        for _ in range(int(RNG.integers(0, 3))):
            s[int(RNG.integers(0, n))] = int(RNG.integers(0, letters))
    return s


def test_repetitions_and_stretches():
    for _ in range(150):
        s = sample(int(RNG.integers(1, 110)), int(RNG.choice([1, 2, 3, 5])))
        for least, times in ((24, 3), (2, 2), (5, 2)):
            assert sorted(map(tuple, periodicity.repetitions(np.array(s), least, times).tolist())) == brute(s, least, times)
    group = [sample(int(RNG.integers(1, 90)), 3) for _ in range(60)]
    codes, doc = np.concatenate([np.array(x) for x in group]), np.repeat(np.arange(60), [len(x) for x in group])
    at = np.cumsum([0, *map(len, group)])
    found = {d: sorted((s - at[d], n, q) for s, n, q in r.tolist()) for d, r in periodicity.runs_of(codes, doc)}
    assert found == {k: brute(x) for k, x in enumerate(group) if brute(x)}


def test_common_extensions():
    s = RNG.integers(1, 3, 300).tolist()
    tree = periodicity.SuffixTree([*s, 0], 3)
    lce = periodicity.Extensions(tree, tree.entered())
    i, j = RNG.integers(0, 300, 500), RNG.integers(0, 300, 500)
    i, j = i[i != j], j[i != j]
    for a, b, got in zip(i.tolist(), j.tolist(), lce(i, j).tolist(), strict=True):
        n = 0
        while max(a, b) + n < 300 and s[a + n] == s[b + n]:
            n += 1
        assert got == n
    order = np.argsort(tree.leaves(tree.entered()))
    assert order.tolist() == sorted(range(301), key=lambda k: [*s, 0][k:])


def expected(doc_id, text):
    words = [x for x in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    if words and h % 10 == 0:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha256(listed.encode()).hexdigest(), sha256(kept).hexdigest()


def texts():
    out = [None, "", " \t\n", "a", "x " * 24, "x " * 23, "ab cd ef " * 8, "ab cd ef " * 7 + "ab cd", "é ü " * 30 + "z " + "é ü " * 30, "a\x0bb\x0c" * 20, "a\x1cb " * 30, "A a " * 14, "A A " * 14]
    out += [" ".join(f"w{x}" for x in sample(int(RNG.integers(20, 300)), int(RNG.choice([2, 3, 40])))) for _ in range(60)]
    return [*out, out[-1], out[-1], " ".join(["lorem ipsum dolor"] * 400)]


def test_query(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate(texts(), -3)] + [(5, "y " * 40), (5, "y " * 40)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect())
    assert got == sorted((k, *expected(k, t)) for k, t in rows)
    assert any(zlib.crc32(str(k).encode()) % 10 == 0 and t for k, t in rows) and sum(r[1] > 0 for r in got) > 20


def test_clashing_columns_nulls_and_long_texts(spark):
    long = " ".join(RNG.integers(0, 9999, 150_000).astype(str)) + " one two three" * 9000
    df = spark.createDataFrame([(None, "q " * 30, 1, "z"), (1, long, 2, "z"), (None, None, 3, None)], "doc_id long, text string, N_RUNS int, start string")
    got = periodicity.find_runs(df, id="doc_id").collect()
    assert [r["n_runs"] for r in got] == [1, 1, 0] and got[0]["collapsed"] == "q" and got[1]["period"] in (3, 1 + 27000 // 3) and got[2]["collapsed"] == ""
    assert got[1]["exponent_milli"] >= 3000 and "N_RUNS" not in got[0].asDict()
    with pytest.raises(ValueError):
        periodicity.find_runs(df.withColumnRenamed("text", "collapsed"), text="collapsed")
    assert periodicity.find_runs(df.limit(0)).collect() == []
