"""Toxic spans by a linear-chain conditional random field.

Tokens are runs of letters. From a bounded sample of labelled documents, words and word beginnings
that occur far more often in toxic documents than in others are learned; a sampled token is labelled
toxic if it carries such evidence inside a toxic document, and the field (two states, transitions,
evidence weights) is fitted to these labelled tokens. Tokens without evidence all have the same
potentials, so a run of k of them is the k-th power of one matrix and a document costs forward and
backward steps only where there is evidence. The marginals of these tokens combine to the document's
score, 1 - prod(1 - p); tokens at 0.5 or more are the offending offsets.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanefold.llm._common import load, short_batches, written
from lanefold.llm._folds import held_out, labelled_sample

TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)
#: Kinds of evidence that a token can carry.
KINDS = 1 + len(PREFIXES)
CONTEXT = 5
MOST_KNOWN = 400_000


def evidence_of(token: str) -> list[str]:
    """The word itself and its beginnings."""
    low = token.lower()
    return [f"w {low}", *(f"{n} {low[:n]}" for n in PREFIXES if len(low) > n)]


class ToxicField:
    """Two-state chain; ``w`` holds evidence weights for the toxic state, ``bias`` its base, ``trans`` and ``start`` the rest."""

    def __init__(self, evidence: dict[str, int]):
        self.evidence = evidence
        self.w = np.zeros(len(evidence))
        self.bias, self.trans, self.start = -4.0, np.zeros((2, 2)), np.zeros(2)
        self.known: dict[str, int] = {}
        self.sums: list[float] = [0.0]
        self.codes: dict[tuple[int, ...], int] = {}

    # -- learning ----------------------------------------------------------------------------------

    def gradients(self, feats: np.ndarray, gold: np.ndarray, size: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log-likelihood of token windows, and its gradients.

        feats (n, length, evidence ids or -1) and gold (n, length) are filled up behind each window's ``size`` tokens; what is
        behind them doesn't count. ``weight`` says how often a window occurs.
        """
        n, length, _ = feats.shape
        on = feats >= 0
        at = np.where(on, feats, 0)
        real = np.arange(length) < size[:, None]
        emit = np.zeros((n, length, 2))
        emit[:, :, 1] = self.bias + (self.w[at] * on).sum(2)
        fwd, bwd = np.empty_like(emit), np.zeros_like(emit)
        fwd[:, 0] = self.start + emit[:, 0]
        for k in range(1, length):
            step = np.logaddexp(fwd[:, k - 1, :1] + self.trans[0], fwd[:, k - 1, 1:] + self.trans[1]) + emit[:, k]
            fwd[:, k] = np.where(real[:, k, None], step, fwd[:, k - 1])
        for k in range(length - 2, -1, -1):
            nxt = emit[:, k + 1] + bwd[:, k + 1]
            step = np.logaddexp(self.trans[:, 0] + nxt[:, :1], self.trans[:, 1] + nxt[:, 1:])
            bwd[:, k] = np.where(real[:, k + 1, None], step, bwd[:, k + 1])
        logz = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        p = np.exp(fwd + bwd - logz[:, None, None])
        share = weight / weight.sum()
        gold = gold.astype(int)
        d = (gold - p[:, :, 1]) * real * share[:, None]
        pair = fwd[:, :-1, :, None] + self.trans + (emit + bwd)[:, 1:, None, :] - logz[:, None, None, None]
        both = real[:, 1:] * share[:, None]
        expected = (np.exp(np.minimum(pair, 0)) * both[:, :, None, None]).sum((0, 1))
        seen = np.bincount((gold[:, :-1] * 2 + gold[:, 1:]).ravel(), both.ravel(), 4).reshape(2, 2)
        first = np.array([((gold[:, 0] == s) - p[:, 0, s]) @ share for s in (0, 1)])
        said = self.start[gold[:, 0]] + (np.take_along_axis(emit, gold[:, :, None], 2)[:, :, 0] * real).sum(1) + (self.trans[gold[:, :-1], gold[:, 1:]] * real[:, 1:]).sum(1)
        g = {"w": np.bincount(at[on], np.broadcast_to(d[:, :, None], at.shape)[on], len(self.w)), "bias": np.array(d.sum()), "trans": seen - expected, "start": first}
        return float((said - logz) @ share), g

    def fit(self, feats: np.ndarray, gold: np.ndarray, size: np.ndarray, rounds: int = 150, rate: float = 0.2, decay: float = 1e-3) -> None:
        """Gradient ascent (Adam) on the likelihood of the windows; equal windows are computed once."""
        rows, weight = np.unique(np.concatenate((feats.reshape(len(feats), -1), gold.astype(int), size[:, None]), 1), axis=0, return_counts=True)
        n, length = len(rows), gold.shape[1]
        feats, gold, size = rows[:, : -length - 1].reshape(n, length, -1), rows[:, -length - 1 : -1], rows[:, -1]
        m: dict[str, np.ndarray] = {}
        for t in range(1, rounds + 1):
            for name, g in self.gradients(feats, gold, size, weight)[1].items():
                g = g - decay * getattr(self, name)
                v1, v2 = m.get(name + "1", 0.0), m.get(name + "2", 0.0)
                m[name + "1"], m[name + "2"] = v1, v2 = 0.9 * v1 + 0.1 * g, 0.999 * v2 + 0.001 * g * g
                setattr(self, name, getattr(self, name) + rate * (v1 / (1 - 0.9**t)) / (np.sqrt(v2 / (1 - 0.999**t)) + 1e-8))
        self.bias = float(self.bias)

    # -- tagging -----------------------------------------------------------------------------------

    def prepare(self) -> ToxicField:
        """The power of the plain step for any number of tokens, from its eigenvectors; scaled by the larger eigenvalue."""
        step = np.exp(self.trans + np.array([0.0, self.bias]))
        values, vectors = np.linalg.eig(step)
        order = np.argsort(-values.real)
        self.ratio = float((values[order[1]] / values[order[0]]).real)
        self.vec = vectors[:, order].real
        self.inv = np.linalg.inv(self.vec)
        return self

    def _code(self, token: str) -> int:
        ids = tuple(self.evidence[e] for e in evidence_of(token) if e in self.evidence)
        code = 0
        if ids:
            code = self.codes.get(ids)
            if code is None:
                code = self.codes[ids] = len(self.sums)
                self.sums.append(float(self.w[list(ids)].sum()))
        if len(self.known) > MOST_KNOWN:
            self.known.clear()
        self.known[token] = code
        return code

    def marginals(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens with evidence and their probabilities of being toxic."""
        codes = np.fromiter(map(self.known.get, tokens, repeat(-1)), np.int64, len(tokens))
        for k in np.flatnonzero(codes < 0).tolist():
            codes[k] = self._code(tokens[k])
        at = np.flatnonzero(codes)
        if not len(at):
            return at, np.zeros(0)

        def power(k):
            return (self.vec * np.array([1.0, self.ratio**k])) @ self.inv

        gaps = np.diff(np.concatenate(([-1], at, [len(tokens)]))) - 1
        steps = [np.exp(self.trans + np.array([0.0, self.bias + self.sums[c]])) for c in codes[at].tolist()]
        fwd, bwd = [], np.ones(2)
        a = np.exp(self.start)
        for k, step in enumerate(steps):
            if k == 0 and at[0] == 0:
                a = a * step[0] / np.exp(self.trans[0])  # the first token: no transition before it
            elif k == 0:
                a = (a * np.array([1.0, np.exp(self.bias)])) @ power(gaps[0] - 1) @ step
            else:
                a = a @ power(gaps[k]) @ step
            a = np.abs(a) / np.abs(a).sum()
            fwd.append(a)
        out = np.empty(len(at))
        for k in range(len(at) - 1, -1, -1):
            bwd = power(gaps[k + 1]) @ bwd
            bwd = np.abs(bwd) / np.abs(bwd).sum()
            both = fwd[k] * bwd
            out[k] = both[1] / both.sum()
            bwd = steps[k] @ bwd
        return at, out

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}}


#: Thresholds that are compared: gains in log-likelihood and factors between rates. Parts of the sample, how many of them are
#: judged, and windows that a field is learned from for that.
GRID = ((25.0, 4.0), (25.0, 8.0), (25.0, 16.0))
PARTS, JUDGED, TRIAL_WINDOWS = 4, 2, 12_000


def evidence_counts(sample: DataFrame) -> DataFrame:
    """e, y, at and parts: the evidence in documents of each kind (text, y), the words around its first place in the text, and
    the parts of the sample that have it there, as bits.

    Documents in which the evidence first stands between the same two words count once: what only copies of a document
    have is no evidence. A text's part is a checksum of it, so copies are in one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ys, where, parts = [], [], [], []
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = ["", *TOKEN.findall(t), ""]
                first: dict[str, int] = {}
                for k in range(1, len(words) - 1):
                    if words[k] not in first:
                        first[words[k]] = k
                seen: dict[str, int] = {}
                for w, k in first.items():
                    for e in evidence_of(w):
                        seen.setdefault(e, k)
                names += seen
                ys += [y] * len(seen)
                parts += [1 << part_of(t)] * len(seen)
                where += [zlib.crc32(f"{words[k - 1]} {words[k]} {words[k + 1]}".encode("utf-8", "surrogatepass")) for k in seen.values()]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ys, pa.int32()), pa.array(where, pa.int64()), pa.array(parts, pa.int32())], names=["e", "y", "at", "parts"])

    return sample.select("text", "y").mapInArrow(run, "e string, y int, at long, parts int").groupBy("e", "y", "at").agg(F.bit_or("parts").alias("parts"))


def part_of(text: str) -> int:
    return zlib.crc32(b"part" + text.encode("utf-8", "surrogatepass")) % PARTS


def strong_evidence(sample: DataFrame) -> tuple[dict[str, list[tuple[float, float]]], list[bool]]:
    """Words and beginnings of words in more toxic documents of the sample than chance would give, by the least strict of ``GRID``.

    For each its (surprise, factor) in the whole sample and in the sample without each part that is judged, and which of these have both
    kinds. The rates of toxic and other documents differ by the factor, and twice the log-likelihood that separate rates gain
    over one rate is the surprise. Counts are summed on Spark; only what passes comes back.
    """
    bits = [0] + [1 << k for k in range(JUDGED)]  # nothing left out, or one part
    kinds = _kinds(sample)
    seen = evidence_counts(sample)
    left = lambda y, bit: F.count_if((F.col("y") == y) & (F.col("parts").bitwiseAND(((1 << PARTS) - 1) & ~bit) > 0))
    seen = seen.groupBy("e").agg(*[left(y, bit).alias(f"n{y}_{k}") for k, bit in enumerate(bits) for y in (0, 1)]).filter("n1_0 > 2")
    least_surprise, least_times = min(s for s, _ in GRID), min(t for _, t in GRID)
    strength, passes = [], F.lit(False)
    for k in range(len(bits)):
        all0, all1 = kinds[k]
        if not all0 or not all1:
            continue
        n0, n1 = F.col(f"n0_{k}"), F.col(f"n1_{k}")
        gain = lambda c, rate, n=n0 + n1: F.when(c > 0, c * F.log(c / n / F.lit(rate))).otherwise(0.0)
        share = all1 / (all0 + all1)
        surprise, times = 2 * (gain(n1, share) + gain(n0, 1 - share)), (n1 + 0.5) / (all1 + 1) / ((n0 + 0.5) / (all0 + 1))
        some = n1 > 2
        strength += [F.when(some, surprise).otherwise(0.0).alias(f"s{k}"), F.when(some, times).otherwise(0.0).alias(f"t{k}")]
        passes = passes | (some & (surprise >= least_surprise) & (times >= least_times))
    usable = [bool(a and b) for a, b in kinds]
    if not usable[0]:
        return {}, usable
    rows = seen.filter(passes).select("e", *strength).collect()
    return {r["e"]: [(r[f"s{k}"], r[f"t{k}"]) if usable[k] else (0.0, 0.0) for k in range(len(bits))] for r in sorted(rows)}, usable


def _kinds(sample: DataFrame) -> list[tuple[int, int]]:
    """Documents without and with the label, in the whole sample and without each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([part_of(t) for t in batch.column(0).to_pylist()], pa.int32())], names=["y", "part"])

    n = Counter({(r["y"], r["part"]): r["count"] for r in sample.select("text", "y").mapInArrow(run, "y int, part int").groupBy("y", "part").count().collect()})
    total = [sum(v for (y, _), v in n.items() if y == kind) for kind in (0, 1)]
    return [tuple(total), *[tuple(total[y] - n[y, k] for y in (0, 1)) for k in range(JUDGED)]]


def chosen_thresholds(sample: DataFrame, strong: dict[str, list[tuple[float, float]]], usable: list[bool], seed: int) -> tuple[float, float]:
    """The (surprise, times) of ``GRID`` by cross-validation: parts of the sample are scored by fields learned from the others.

    The share of toxic texts found less that of others called toxic is compared; the strictest of the best.
    """
    n: Counter = Counter()
    for k in range(JUDGED):
        if not usable[k + 1]:
            continue
        mine = _part(sample, k)
        for g, (surprise, times) in enumerate(GRID):
            chosen = [e for e, x in strong.items() if x[k + 1][0] >= surprise and x[k + 1][1] >= times]
            field = _fitted(_part(sample, k, rest=True), chosen, TRIAL_WINDOWS, seed)
            for r in score(mine, field).groupBy("y", (F.col("score") >= 0.5).alias("hit")).count().collect():
                n[g, r["y"], r["hit"]] += r["count"]
    rate = lambda g, y: n[g, y, True] / max(1, n[g, y, True] + n[g, y, False])
    return GRID[max(range(len(GRID)), key=lambda g: (round(rate(g, 1) - rate(g, 0), 6), GRID[g]))]


def _part(sample: DataFrame, k: int, rest: bool = False) -> DataFrame:
    """The texts of a part of the sample, or all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([(part_of(t) == k) != rest for t in batch.column(0).to_pylist()], pa.bool_()))

    return sample.select("text", "y").mapInArrow(run, "text string, y int")


def training_windows(sample: DataFrame, evidence: dict[str, int], seed: int) -> DataFrame:
    """h (a seeded hash), feats, gold and size: the tokens around each one with evidence and around two others of each text.

    A window has ``2 * CONTEXT + 1`` tokens, of texts with fewer all there are.
    """
    width = 2 * CONTEXT + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = TOKEN.findall(t)
                if not tokens:
                    continue
                has = [[evidence[e] for e in evidence_of(w) if e in evidence] for w in tokens]
                rng = np.random.default_rng([seed, zlib.crc32(t.encode("utf-8", "surrogatepass"))])
                centres = [k for k, h in enumerate(has) if h] + rng.integers(0, len(tokens), 2).tolist()
                feats, gold, size = [], [], []
                for c in centres:
                    a = max(0, min(c - CONTEXT, len(tokens) - width))
                    part = has[a : a + width]
                    size.append(len(part))
                    part += [[]] * (width - len(part))
                    feats.append([x for h in part for x in (h + [-1] * KINDS)[:KINDS]])
                    gold.append([int(bool(h) and y == 1) for h in part])
                cols = [pa.array(rng.integers(0, 1 << 62, len(size))), pa.array(feats, pa.list_(pa.int32())), pa.array(gold, pa.list_(pa.int32())), pa.array(size, pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, names=["h", "feats", "gold", "size"])

    return sample.select("text", "y").mapInArrow(run, "h long, feats array<int>, gold array<int>, size int")


def _fitted(sample: DataFrame, strong: list[str], most_windows: int, seed: int) -> ToxicField | None:
    if not strong:
        return None
    field = ToxicField({e: k for k, e in enumerate(strong)})
    rows = written(training_windows(sample, field.evidence, seed), "windows")
    share = min(1.0, most_windows / max(1, rows.count()))
    rows = rows.filter(F.col("h") < int(share * (1 << 62))).collect()
    rows.sort(key=lambda r: r["h"])
    if not rows:
        return None
    feats, gold, size = (np.array([r[c] for r in rows]) for c in ("feats", "gold", "size"))
    field.fit(feats.reshape(len(rows), 2 * CONTEXT + 1, KINDS), gold, size)
    return field.prepare()


def learn(sample: DataFrame, surprise: float | None = None, times: float | None = None, most_windows: int = 60_000, seed: int = 42) -> ToxicField | None:
    """The field from labelled texts (text, y); None without both kinds or without any evidence.

    Thresholds that aren't given are chosen by cross-validation inside the sample; evidence below all of ``GRID`` doesn't count. The
    driver gets the evidence that passed the test and about ``most_windows`` windows, those below a bound on their seeded
    hashes; texts stay in the tasks.
    """
    found, usable = strong_evidence(sample)
    if found and (surprise is None or times is None):
        best = chosen_thresholds(sample, found, usable, seed)
        surprise, times = best[0] if surprise is None else surprise, best[1] if times is None else times
    return _fitted(sample, [e for e, x in found.items() if x[0][0] >= surprise and x[0][1] >= times], most_windows, seed)


def train(docs: DataFrame, labels: DataFrame, per_label: int = 3000, id: str = "doc_id", text: str = "text", label: str = "toxic", **params) -> ToxicField | None:
    """Learns from about ``per_label`` documents of each label outside the held-out fold; labels other than 0 and 1 don't count.

    A document with several labels is toxic if any of them says so. Only the picked identifiers are broadcast, about
    2 ``per_label`` of them, so the texts of the table aren't shuffled; the picked texts are written once.
    """
    short_batches(docs.sparkSession)
    marks = labels.groupBy(F.col(id).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    picked = labelled_sample(marks.filter(F.col("y").isin(0, 1)), "y", per_label)
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    return learn(written(rows.select("text", "y"), "labelled"), **params)


def score(docs: DataFrame, field: ToxicField | None, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and spans: start, end (in characters, end exclusive) and probability of toxic tokens.

    Null, empty and letterless texts score 0 without spans, all texts if there is no model. Rows stay one
    for one, equal texts get equal results; columns with the new names are replaced.
    """
    short_batches(docs.sparkSession)
    kept = docs.drop("score", "spans")
    names = [*kept.columns, "score", "spans"]
    schema = kept.withColumns({"score": F.lit(0.0), "spans": F.array().cast("array<struct<start:int,end:int,probability:double>>")}).schema
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spans = [], []
            for t in batch.column(text).to_pylist():
                at, p = field.marginals(TOKEN.findall(t)) if field and t else ([], np.zeros(0))
                scores.append(float(np.clip(1 - np.prod(1 - p), 0, 1)))
                bad = {k: x for k, x in zip(at, p.tolist(), strict=True) if x >= 0.5}
                spans.append([{"start": m.start(), "end": m.end(), "probability": bad[k]} for k, m in enumerate(TOKEN.finditer(t)) if k in bad] if bad else [])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(spans, kind)], names=names)

    return kept.mapInArrow(run, schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = score(docs, train(docs, load(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
