"""The registered queries on written tables, in all contract columns, against brute force; and on empty tables."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import xxhash

from lanefold.llm import toxicity
from lanefold.llm.language import FILTERS, WIDTHS, ByteConvNet
from lanefold.llm.queries import QUERIES

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, label string"
RNG = np.random.default_rng(21)
WORDS = [f"w{chr(97 + a)}{chr(97 + b)}{'xyz'[a % 3]}" for a in range(26) for b in range(12)]


def prose(n):
    return " ".join(RNG.choice(WORDS, n))


def table():
    passage = prose(90)
    texts = [prose(int(n)) for n in RNG.integers(1, 200, 60)]
    texts += [None, "", " \t\n", "短い text", texts[3], texts[3], texts[5] + " more", prose(30) + " " + passage, passage + " " + prose(20), "é" * 500 + "😀", "12 34", "<|endoftext|> x", prose(300_000)]
    texts += [prose(40) + " badword vileness " + prose(9) for _ in range(30)] + ["badword", "vileness here"] * 4
    toxic = {k for k, t in enumerate(texts) if t and ("badword" in t or "vileness" in t)}
    return texts, toxic


TEXTS, TOXIC = table()
ITEMS = [(1, " ".join(TEXTS[7].split()[:25])), (2, "短い TEXT"), (3, None), (4, "..."), (5, prose(30)), (6, " ".join(TEXTS[3].split()[:12]))]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rows = [(k - 3, t, ("aa", "bb")[k % 2] if k % 11 else None, f"s{k % 3}" if k % 7 else None, 1, "x", "y") for k, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(k - 3, 1, int(k in TOXIC)) for k in range(len(TEXTS))], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name, schema in (("documents", DOCS), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int"), ("conversations", "conv_id long, turn int, role string, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{d}/{name}.parquet")
    return d


def result(spark, sf, name):
    rows = QUERIES[name](spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == [k - 3 for k in range(len(TEXTS))]
    return {r["doc_id"] + 3: r for r in rows}


def test_empty_tables(spark, empty):
    for name, f in QUERIES.items():
        assert len(f(spark, empty).collect()) == (1 if name == "op3_chat_format" else 0), name


def test_op1_op4(spark, sf):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = [tok.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    one, four, start = result(spark, sf, "op1_token_shards"), result(spark, sf, "op4_token_counts"), 0
    for k, x in enumerate(ids):
        assert (one[k]["start"], one[k]["n_tokens"], one[k]["ids_crc32"]) == (start, len(x) + 1, zlib.crc32(np.array(x + [0], "<u4").tobytes()))
        start += len(x) + 1
        assert (four[k]["n_bytes"], four[k]["n_tokens"], four[k]["over_limit"]) == (len((TEXTS[k] or "").encode()), len(x), len(x) > 512)


def test_op2(spark, sf):
    raws = [(t or "").encode() for t in TEXTS]
    seen = Counter(xxhash.xxh3_128_digest(r[k : k + 400]) for r in raws for k in range(len(r) - 399))
    got = result(spark, sf, "op2_suffix_dedup")
    for k, r in enumerate(raws):
        gone = np.zeros(len(r) + 1, np.int64)
        for a in range(len(r) - 399):
            if seen[xxhash.xxh3_128_digest(r[a : a + 400])] > 1:
                gone[a] += 1
                gone[a + 400] -= 1
        off = np.cumsum(gone)[:-1] > 0
        spans = int(np.count_nonzero(np.diff(np.concatenate(([0], off.astype(int)))) == 1))
        kept = sha256(np.frombuffer(r, np.uint8)[~off].tobytes()).hexdigest()
        assert (got[k]["n_bytes"], got[k]["n_removed"], got[k]["n_spans"], got[k]["kept_sha256"]) == (len(r), int(off.sum()), spans, kept)


def test_op5(spark, sf):
    got = result(spark, sf, "op5_mix")
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in TEXTS]
    taken, target = Counter(), {}
    for k, r in got.items():
        s = f"s{k % 3}" if k % 7 else None
        assert r["size"] == size[k] and r["source_size"] == sum(n for j, n in enumerate(size) if (f"s{j % 3}" if j % 7 else None) == s)
        assert r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] + 1e-6
        taken[s] += r["taken"]
        target[s] = r["target"]
    assert abs(sum(target.values()) - sum(size)) < 1e-6
    again = result(spark, sf, "op5_mix")
    assert all(again[k]["taken"] == r["taken"] for k, r in got.items())


def test_op6(spark, sf):
    got = result(spark, sf, "op6_audio")
    by_text = {}
    for k, t in enumerate(TEXTS):
        raw = (t or "").encode()
        payload = raw.ljust(max(1, -(-len(raw) // 64)) * 64, b"\0")
        r = got[k]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert by_text.setdefault(t or "", (r["media_sha256"], r["media_bytes"], r["feature"])) == (r["media_sha256"], r["media_bytes"], r["feature"])


def test_op7(spark, sf):
    fps = []
    for t in TEXTS:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = np.array([xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))] if w else [], np.uint64)
        bits = [2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h) for b in range(64)]
        fps.append(sum(1 << b for b, on in enumerate(bits) if on))
    low = list(range(len(fps)))
    for _ in range(10):
        low = [min(low[j] for j in range(len(fps)) if (fps[j] ^ fps[k]).bit_count() <= 4) for k in range(len(fps))]
    got = result(spark, sf, "op7_simhash")
    assert [(got[k]["fingerprint"], got[k]["component_id"]) for k in range(len(fps))] == [(f"{f:016x}", c - 3) for f, c in zip(fps, low, strict=True)]


def held(k):
    return zlib.crc32(str(k - 3).encode()) % 5 == 0


def test_op8(spark, sf):
    got = result(spark, sf, "op8_toxicity")
    assert all(r["held_out"] == held(k) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for k, r in got.items())
    assert {k for k, r in got.items() if r["predicted"]} == TOXIC


def test_op9(spark, sf):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in ITEMS:
        w = split(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    sizes = {len(x) for x in windows}
    got = result(spark, sf, "op9_decontaminate")
    for n, t in enumerate(TEXTS):
        w, hit, found = split(t), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if names := windows.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    found |= names
        r = got[n]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (len(w), len(hit), len(found), sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))


def test_op10(spark, sf):
    got = result(spark, sf, "op10_language")
    for k, t in enumerate(TEXTS):
        r = got[k]
        assert r["held_out"] == held(k) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, t or ""))) and r["lang_pred"] in ("aa", "bb", "und")


def test_gradients_of_the_field():
    rng = np.random.default_rng(0)
    field = toxicity.ToxicField({"a": 0, "b": 1, "c": 2})
    field.w, field.bias, field.trans, field.start = rng.normal(size=3), -0.3, rng.normal(size=(2, 2)), rng.normal(size=2)
    feats, gold = rng.integers(-1, 3, (7, 5, 3)), rng.integers(0, 2, (7, 5))
    size, weight = np.array([5, 1, 2, 3, 4, 5, 5]), np.array([1, 2, 3, 1, 1, 5, 1.0])
    for k, n in enumerate(size):
        feats[k, n:], gold[k, n:] = -1, 0
    value, g = field.gradients(feats, gold, size, weight)
    total = 0.0
    for f, y, n, c in zip(feats, gold, size, weight, strict=True):  # all paths
        emit = [field.bias + sum(field.w[e] for e in f[k] if e >= 0) for k in range(n)]
        of = lambda path, e=emit: field.start[path[0]] + sum(field.trans[a, b] for a, b in zip(path, path[1:])) + sum(x for x, s in zip(e, path, strict=True) if s)
        z = np.logaddexp.reduce([of([p >> k & 1 for k in range(n)]) for p in range(1 << n)])
        total += c * (of(list(y[:n])) - z)
    assert np.isclose(value, total / weight.sum())
    for name in ("w", "bias", "trans", "start"):
        was = np.array(getattr(field, name), float)
        for at in np.ndindex(was.shape):
            two = []
            for step in (1e-5, -1e-5):
                moved = was.copy()
                moved[at] += step
                setattr(field, name, moved)
                two.append(field.gradients(feats, gold, size, weight)[0])
            setattr(field, name, was)
            assert np.isclose((two[0] - two[1]) / 2e-5, np.asarray(g[name])[at], atol=1e-6), name


def test_short_texts_teach_the_field(spark):
    df = spark.createDataFrame([(k, f"some word{chr(97 + k % 26)} {'badword' if k % 3 == 0 else 'plain'} x{chr(97 + k % 23)}") for k in range(200)], "doc_id long, text string")
    labels = df.selectExpr("doc_id", "int(doc_id % 3 = 0) AS toxic")
    got = toxicity.score(df, toxicity.train(df, labels)).collect()
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in got)


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    net = ByteConvNet(["x", "y", "z"], 3)
    net.p = {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(0, 256, (6, 40)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 1])
    g = net._gradients(x, y)
    loss = lambda: -net._forward(x)[1][np.arange(6), y].mean()
    assert net.p["out"].shape == (len(WIDTHS) * FILTERS, 3)
    for name, v in net.p.items():
        flat, gf = v.reshape(-1), g[name].reshape(-1)
        for k in np.argsort(-np.abs(gf))[:6]:
            was, two = flat[k], []
            for step in (1e-6, -1e-6):
                flat[k] = was + step
                two.append(loss())
            flat[k] = was
            assert np.isclose((two[0] - two[1]) / 2e-6, gf[k], rtol=1e-3, atol=1e-6), name


def test_pipeline_on_hard_tables(spark, sf, empty):
    import corpus_pipeline

    got = [r["doc_id"] + 3 for r in corpus_pipeline.run(spark, sf).collect()]
    assert got and not {60, 61, 62, 70} & set(got) and not {3, 7, 64, 65} & set(got)
    assert corpus_pipeline.run(spark, empty).collect() == []
