"""Scores of texts by a log-bilinear language model, trained in numpy with noise-contrastive estimation.

The model predicts a class from the two classes before it: each of the most frequent words is a class of its
own, the end of a text is one, and all other words share a few, by their last bytes. The vectors of the context, each through the
matrix of its place, add up to a prediction, and its products with the vectors of all classes are the scores.
Training needs no sum over classes: a seen class is told from drawn ones. It starts on a bounded sample;
then every task goes over all its texts from the same weights and the mean of what the tasks have learned
counts. For scoring, products with all classes give the exact normaliser of each pair of classes that occurs.
A word of a shared class has the class's probability times its share of it by smoothed counts, so
probabilities over all words, and one unseen word a shared class, add up to one.

Word counts are taken over all texts. The most frequent words, at most ``HEAD``, are sent to the tasks with
their counts; all others meet their counts in a join.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lanefold.llm._common import load, short_batches, written

#: Words whose counts go to every task, and their longest length in bytes: 26 MB at most.
HEAD, HEAD_BYTES = 1 << 18, 100
#: Words that are classes, numbers of a vector, draws a step, tokens of a step, tokens of the first sample and rounds over it.
WORDS, DIM, DRAWS, STEP, FIRST_TOKENS, FIRST_ROUNDS = 1983, 16, 64, 2048, 1 << 20, 3
#: Shared classes, by a checksum of a word's last two bytes.
SHARED = 64
#: Groups of tasks whose weights are averaged, one step after the other; the last is the mean of all.
GROUPS = (4096, 256, 16, 1)
END = ""


def fold(id: str = "doc_id") -> Column:
    """crc32 of the identifier as text, modulo 5; null for a null identifier."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % 5


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word and c, its number in all texts; the end of a text is the empty word. A-Z are lower-cased; a null text is empty."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    words = docs.select(F.explode(F.split(low, "[\\x20\\x09-\\x0D]+")).alias("word")).filter(F.col("word") != END)
    ends = docs.groupBy().agg(F.count("*").alias("c")).filter("c > 0").select(F.lit(END).alias("word"), "c")
    return words.groupBy("word").agg(F.count("*").alias("c")).unionByName(ends)


@dataclass
class Head:
    """The most frequent words with their counts, the most frequent first (the end among them), and the totals over all words."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int
    distinct: int
    shared: np.ndarray  # tokens and distinct words by shared class, the end left out


def shared_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SHARED


def head_of(counts: DataFrame, most: int = HEAD) -> Head:
    """The words above the lowest step of an eighth of an octave of c that at most ``most`` words reach, and the end."""
    step = F.floor(F.log2("c") * 8)
    short = (F.octet_length("word") <= HEAD_BYTES) & (F.col("word") != END)
    last = F.when(F.col("word") != END, F.crc32(F.substring(F.col("word").cast("binary"), -2, 2)) % SHARED).otherwise(-1)
    rows = counts.groupBy(step.alias("step"), last.alias("last")).agg(F.sum("c").alias("c"), F.count("*").alias("n"), F.count_if(short).alias("short")).collect()
    reach, shared, over = Counter(), np.zeros((2, SHARED), np.int64), None
    for r in rows:
        reach[r["step"]] += r["short"]
        if r["last"] >= 0:
            shared[:, r["last"]] += (r["c"], r["n"])
    for k in sorted(reach, reverse=True):
        most -= reach[k]
        if most < 0:
            over = k
            break
    kept = counts.filter(short & (step > over) if over is not None else short).unionByName(counts.filter(F.col("word") == END))
    found = sorted(((r["c"], r["word"].encode()) for r in kept.collect()), key=lambda x: (-x[0], x[1]))
    return Head([w for _, w in found], np.array([c for c, _ in found], np.int64), sum(r["c"] for r in rows), sum(r["n"] for r in rows), shared)


class LogBilinear:
    """Weights of the model. Classes: the shared ones, the end, then words of their own."""

    NAMES = ("context", "near", "far", "target", "bias")

    def __init__(self, classes: int, dim: int = DIM, seed: int = 42):
        rng = np.random.default_rng(seed)
        shapes = {"context": (classes, dim), "near": (dim, dim), "far": (dim, dim), "target": (classes, dim), "bias": (classes,)}
        self.p = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in shapes.items()}
        for k in ("near", "far"):
            self.p[k] = (self.p[k] * 0.2 + np.eye(dim)).astype(np.float32)

    def packed(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.NAMES])

    def unpack(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for k in self.NAMES:
            n = self.p[k].size
            self.p[k] = np.array(flat[at : at + n], np.float32).reshape(self.p[k].shape)
            at += n
        return self


def _rows_added(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of ``index`` and the sums of their ``values``."""
    order = np.argsort(index, kind="stable")
    rows = index[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[first], np.add.reduceat(values[order], first, axis=0)


class Trainer:
    """Noise-contrastive estimation with steps scaled by past gradients."""

    def __init__(self, net: LogBilinear, noise: np.ndarray, seed: int, rate: float = 0.08, draws: int = DRAWS):
        self.net, self.rate, self.draws = net, rate, draws
        self.log_noise = np.log(noise).astype(np.float32)
        self.until = np.cumsum(noise)
        self.rng = np.random.default_rng(seed)
        self.past = {k: np.full(v.shape, 1e-2, np.float32) for k, v in net.p.items()}

    def _move(self, name: str, grad: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        past = self.past[name]
        past[rows] += grad * grad
        self.net.p[name][rows] -= self.rate * grad / np.sqrt(past[rows])

    def step(self, near: np.ndarray, far: np.ndarray, w: np.ndarray) -> None:
        p, n = self.net.p, len(w)
        drawn = np.minimum(np.searchsorted(self.until, self.rng.random(self.draws) * self.until[-1]), len(self.until) - 1)
        a, b, q, qn = p["context"][near], p["context"][far], p["target"][w], p["target"][drawn]
        h = a @ p["near"] + b @ p["far"]
        shift = np.float32(np.log(self.draws))
        seen = np.einsum("nd,nd->n", h, q) + p["bias"][w] - self.log_noise[w] - shift
        false = h @ qn.T + (p["bias"][drawn] - self.log_noise[drawn] - shift)
        gs = (-1 / (1 + np.exp(np.clip(seen, -30, 30))) / n).astype(np.float32)
        gf = (1 / (1 + np.exp(-np.clip(false, -30, 30))) / n).astype(np.float32)
        gh = gs[:, None] * q + gf @ qn
        ga, gb = gh @ p["near"].T, gh @ p["far"].T
        rows, grad = _rows_added(np.concatenate([w, drawn]), np.concatenate([np.column_stack([gs[:, None] * h, gs]), np.column_stack([gf.T @ h, gf.sum(0)])]))
        scale = np.float32(n)  # steps don't depend on the number of tokens in them
        self._move("near", a.T @ gh * scale)
        self._move("far", b.T @ gh * scale)
        self._move("target", grad[:, :-1] * scale, rows)
        self._move("bias", grad[:, -1] * scale, rows)
        rows, grad = _rows_added(np.concatenate([near, far]), np.concatenate([ga, gb]))
        self._move("context", grad * scale, rows)

    def learn(self, near: np.ndarray, far: np.ndarray, w: np.ndarray) -> None:
        order = self.rng.permutation(len(w))
        for k in range(0, len(w), STEP):
            at = order[k : k + STEP]
            self.step(near[at], far[at], w[at])


class _Index(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class Vocabulary:
    """What the tasks know of words: numbers of head words, their classes and counts."""

    head: Head
    words: int = WORDS

    def __post_init__(self) -> None:
        h = self.head
        self.index = _Index({w: k for k, w in enumerate(h.words)})
        self.end = self.index[END.encode()]
        own = [k for k in range(len(h.words)) if k != self.end][: self.words]
        self.classes = SHARED + 1 + len(own)
        self.of = np.zeros(len(h.words) + 1, np.int64)  # the last is for words outside the head, number -1
        self.of[:-1] = [shared_class(w) for w in h.words]
        tokens, distinct = h.shared.copy()
        np.subtract.at(tokens, self.of[own], h.counts[own])
        np.subtract.at(distinct, self.of[own], 1)
        self.of[own] = np.arange(SHARED + 1, self.classes)
        if self.end >= 0:
            self.of[self.end] = SHARED
        seen = np.zeros(self.classes)
        seen[:SHARED] = tokens
        np.add.at(seen, self.of[:-1], np.where(self.of[:-1] < SHARED, 0, h.counts))
        self.noise = (seen + 0.5) / (seen + 0.5).sum()
        self.log_of_shared = np.log10(tokens + 0.5 * (distinct + 1))
        part = self.of[:-1] < SHARED
        share = np.zeros(len(part))
        share[part] = np.log10(h.counts[part] + 0.5) - self.log_of_shared[self.of[:-1][part]]
        self.log_share = np.append(share, 0.0)
        self.log_base = np.append(np.log10(h.counts + 0.5) - np.log10(h.tokens + 0.5 * (h.distinct + 1)), 0.0)

    def read(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Head numbers and classes of all tokens, the number of tokens of each text, and the words outside the head."""
        words = [(t or b"").lower().split() for t in texts]
        sizes = np.array([len(x) + 1 for x in words], np.int64)
        numbers = np.full(sizes.sum(), self.end, np.int64)
        inside = np.ones(len(numbers), bool)
        inside[np.cumsum(sizes) - 1] = False
        flat = list(chain.from_iterable(words))
        numbers[inside] = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        classes = self.of[numbers]
        classes[~inside] = SHARED
        rare = [flat[k] for k in np.flatnonzero(numbers[inside] < 0).tolist()]
        out = inside & (numbers < 0)
        classes[out] = [shared_class(w) for w in rare]
        return numbers, classes, sizes, rare


def contexts(w: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class before each token, the one before that (ends before the start of a text), and the token's own."""
    near, far = np.roll(w, 1), np.roll(w, 2)
    first = np.cumsum(sizes) - sizes
    near[first] = far[first] = SHARED
    far[first[sizes > 1] + 1] = SHARED
    return near, far, w


def _trained(batches: Iterator[pa.RecordBatch], words: Vocabulary, start: np.ndarray | None, rounds: int, seed: int, chunk: int = 1 << 16) -> tuple[np.ndarray, int]:
    """Weights after ``rounds`` passes over the texts of a task (one pass holds a chunk, more hold all), and the tokens seen."""
    net = LogBilinear(words.classes)
    if start is None:
        net.p["bias"] = np.log(words.noise).astype(np.float32)
    else:
        net.unpack(start)
    teacher, held, n, kept, total = Trainer(net, words.noise, seed), [], 0, [], 0

    def learn() -> None:
        near, far, w = (np.concatenate(x) for x in zip(*held, strict=True))
        teacher.learn(near, far, w)
        if rounds > 1:
            kept.append((near, far, w))

    for batch in batches:
        texts = batch.column(0).cast(pa.binary()).to_pylist()
        if not texts:
            continue
        held.append(contexts(*words.read(texts)[1:3]))
        n += len(held[-1][0])
        if n >= chunk:
            learn()
            total, held, n = total + n, [], 0
    if held:
        learn()
        total += n
    for k in range(1, rounds):
        for part in kept:
            teacher.rate = 0.08 / (k + 1)
            teacher.learn(*part)
    return net.packed(), total


def train(docs: DataFrame, head: Head, text: str = "text", first_tokens: int = FIRST_TOKENS, words: int = WORDS) -> np.ndarray | None:
    """Weights learned from all of ``docs``; None if there is no token.

    The first rounds go over whole texts of about ``first_tokens`` tokens, chosen by a hash of their place, in one task.
    Then each task learns from all its texts and the weights are averaged, weighted by tokens, group by group.
    """
    if not head.tokens:
        return None
    spark = docs.sparkSession
    short_batches(spark)
    texts = docs.select(F.col(text).alias("text"))
    vocabulary = spark.sparkContext.broadcast(Vocabulary(head, words))
    schema = "part long, tokens double, weights array<double>"

    def learner(start: np.ndarray | None, rounds: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            weights, tokens = _trained(batches, vocabulary.value, start, rounds, part + 1)
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([float(tokens)]), pa.array([weights.astype(np.float64)], pa.list_(pa.float64()))], names=["part", "tokens", "weights"])

        return run

    share = min(1.0, first_tokens / head.tokens)
    picked = F.pmod(F.xxhash64(F.lit(12), F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30))
    # a bounded sample, so one task holds it; the sort makes it the same in every run
    sample = texts.filter(picked).select("text", F.xxhash64("text").alias("h")).repartition(1).sortWithinPartitions("h").select("text")
    first = sample.mapInArrow(learner(None, FIRST_ROUNDS), schema).select("weights").head()
    start = np.array(first["weights"], np.float32) if first else None
    each = texts.mapInArrow(learner(start, 1), schema)
    mean = each.select("part", "tokens", array_to_vector("weights").alias("v"))
    for groups in GROUPS:
        mean = mean.groupBy(F.pmod("part", F.lit(groups)).alias("part")).agg(Summarizer.mean(F.col("v"), F.col("tokens")).alias("v"), F.sum("tokens").alias("tokens"))
    mean = mean.select(vector_to_array("v").alias("w")).head()["w"]
    vocabulary.unpersist()
    return np.array(mean, np.float32)


class Scorer:
    """Normalised log-probabilities of classes; the normaliser of a pair of classes is found when it first occurs."""

    def __init__(self, weights: bytes, classes: int):
        p = LogBilinear(classes).unpack(np.frombuffer(weights, np.float32)).p
        self.near, self.far = p["context"] @ p["near"], p["context"] @ p["far"]
        self.target, self.bias, self.classes = p["target"], p["bias"], classes
        self.log_sum = np.full(classes * classes, np.nan, np.float32)

    def __call__(self, near: np.ndarray, far: np.ndarray, w: np.ndarray, batch: int = 1 << 16) -> np.ndarray:
        """log10 of the probability of each class ``w`` after ``far``, ``near``."""
        pair = far * self.classes + near
        missing = np.unique(pair[np.isnan(self.log_sum[pair])])
        for k in range(0, len(missing), 1024):
            at = missing[k : k + 1024]
            s = (self.near[at % self.classes] + self.far[at // self.classes]) @ self.target.T + self.bias
            top = s.max(1, keepdims=True)
            self.log_sum[at] = top[:, 0] + np.log(np.exp(s - top).sum(1))
        out = np.empty(len(w), np.float64)
        for k in range(0, len(w), batch):
            at = slice(k, k + batch)
            out[at] = np.einsum("nd,nd->n", self.near[near[at]] + self.far[far[at]], self.target[w[at]]) + self.bias[w[at]] - self.log_sum[pair[at]]
        return out / np.log(10)


@lru_cache(1)
def _scorer(weights: bytes, classes: int) -> Scorer:
    return Scorer(weights, classes)


SCORED = "n_tokens long, n_known long, base_score double, score double, rare array<binary>"


def score_texts(docs: DataFrame, counts: DataFrame, head: Head, weights: np.ndarray | None, text: str = "text", id: str = "doc_id", words: int = WORDS) -> DataFrame:
    """``id``, n_tokens, n_known (tokens that were counted), base_score by counts and score by the model, a row for each row of ``docs``.

    A text's tokens are its words and one end; a null text is empty. Without any counted token every probability is one,
    in both scores. Only the words outside the head are shuffled, with the number of their row.
    """
    short_batches(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(head, words))
    raw = weights.astype(np.float32).tobytes() if weights is not None else None
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
    made = StructType.fromDDL(SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            numbers, classes, sizes, words_out = v.read(batch.column("text").cast(pa.binary()).to_pylist())
            if not len(sizes):
                continue
            at = np.cumsum(sizes) - sizes
            base = np.add.reduceat(v.log_base[numbers], at)
            model = base
            if raw:
                share = v.log_share[numbers]
                share[numbers < 0] = -v.log_of_shared[classes[numbers < 0]]
                model = np.add.reduceat(_scorer(raw, v.classes)(*contexts(classes, sizes)) + share, at)
            known = np.add.reduceat((numbers >= 0).astype(np.int64), at)
            until = np.concatenate([[0], np.cumsum(sizes - known - (v.end < 0))])
            rare = pa.ListArray.from_arrays(pa.array(until, pa.int32()), pa.array(words_out, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), *(pa.array(x) for x in (sizes, known, base, model)), rare], names=["row", "id", *made.fieldNames()])

    part = written(rows.mapInArrow(run, StructType([*rows.select("row", "id").schema.fields, *made.fields])), "scored")
    rare = part.select("row", F.explode("rare").alias("word")).withColumn("word", F.col("word").cast("string"))
    found = rare.join(counts, "word", "left").groupBy("row").agg(F.count("c").alias("more"), F.count("*").alias("n"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"))
    of_all = float(np.log10(head.tokens + 0.5 * (head.distinct + 1)))
    late = F.coalesce("logs", F.lit(0.0))
    rest = F.coalesce("n", F.lit(0)) * of_all
    return part.drop("rare").join(found, "row", "left").select(
        F.col("id").alias(id), "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("base_score") + late - rest).alias("base_score"), (F.col("score") + late - (F.lit(0.0) if raw else rest)).alias("score"),
    )


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; what is learned comes from the folds other than 1."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    taught = docs.filter(fold() != 1)
    counts = written(word_counts(taught), "word-counts")
    head = head_of(counts)
    scored = score_texts(docs, counts, head, train(taught, head))
    return scored.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(head.tokens).cast("long").alias("train_tokens"), "base_score", "score")
