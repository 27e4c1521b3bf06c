"""Language identification by a byte convolutional network trained in numpy.

Windows of a fixed number of bytes go through byte embeddings, filters of several widths with
rectifier and max pooling over the window, and a softmax. A filter over embedded bytes is a sum of
table rows, one a byte, so for prediction the network is unrolled into tables indexed by bytes and byte
pairs. A document is scored by the mean of the log-probabilities of all its windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanefold.llm._common import load, own_columns, own_names, short_batches
from lanefold.llm._folds import held_out, labelled_sample

WINDOW, OVERLAP = 256, 3
DIM, FILTERS, WIDTHS = 8, 16, (2, 3, 4)
UNKNOWN = "und"


def windows(raw: bytes, size: int = WINDOW) -> np.ndarray:
    """(n, size) bytes covering the whole text, neighbours overlapping by the widest filter; the last is filled with zeros."""
    step = size - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // step))
    buf = np.zeros((n - 1) * step + size, np.uint8)
    buf[: len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(buf, size)[::step]


class ByteConvNet:
    """Embedding, one bank of filters a width, max pooling, softmax."""

    def __init__(self, labels: list[str], seed: int = 42):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.p = {"emb": rng.normal(0, 0.5, (256, DIM)), "out": np.zeros((len(WIDTHS) * FILTERS, len(labels))), "bias": np.zeros(len(labels))}
        for w in WIDTHS:
            self.p[f"f{w}"] = rng.normal(0, (w * DIM) ** -0.5, (w * DIM, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _forward(self, x: np.ndarray):
        n, size = x.shape
        e = self.p["emb"][x]
        pooled, where, cols = [], [], []
        for w in WIDTHS:
            c = np.concatenate([e[:, j : size - w + 1 + j] for j in range(w)], 2)
            z = c @ self.p[f"f{w}"] + self.p[f"b{w}"]
            top = z.argmax(1)
            where.append(top)
            pooled.append(np.maximum(np.take_along_axis(z, top[:, None], 1)[:, 0], 0))
            cols.append(c)
        h = np.concatenate(pooled, 1)
        s = h @ self.p["out"] + self.p["bias"]
        s = s - s.max(1, keepdims=True)
        return h, s - np.log(np.exp(s).sum(1, keepdims=True)), where, cols

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        h, logp, where, cols = self._forward(x)
        g = np.exp(logp)
        g[np.arange(len(y)), y] -= 1
        g /= len(y)
        out = {"out": h.T @ g, "bias": g.sum(0), "emb": np.zeros_like(self.p["emb"])}
        gh = (g @ self.p["out"].T) * (h > 0)
        rows = np.arange(len(x))[:, None]
        for k, w in enumerate(WIDTHS):
            gz, at = gh[:, k * FILTERS : (k + 1) * FILTERS], where[k]
            picked = cols[k][rows, at]  # (n, filters, w * dim): only the maximum passes a gradient on
            out[f"f{w}"] = np.einsum("nf,nfd->df", gz, picked)
            out[f"b{w}"] = gz.sum(0)
            ge = (gz[:, :, None] * self.p[f"f{w}"].T[None]).reshape(len(x), FILTERS, w, DIM)
            for j in range(w):
                np.add.at(out["emb"], x[rows, at + j], ge[:, :, j])
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 64, rate: float = 3e-3, seed: int = 42) -> None:
        """Adam on the cross-entropy."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for k in range(0, len(order), batch):
                at = order[k : k + batch]
                t += 1
                for name, g in self._gradients(x[at], y[at]).items():
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.999 * v[name] + 0.001 * g * g
                    self.p[name] -= (rate * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)

    def weights(self) -> bytes:
        return b"".join(self.p[k].tobytes() for k in sorted(self.p))


def load_net(labels: tuple[str, ...], raw: bytes) -> ByteConvNet:
    net, at = ByteConvNet(list(labels)), 0
    for k in sorted(net.p):
        n = net.p[k].nbytes
        net.p[k] = np.frombuffer(raw, np.float32, net.p[k].size, at).reshape(net.p[k].shape)
        at += n
    return net


class Unrolled:
    """The network as tables: a filter's response is a sum of rows picked by bytes and byte pairs."""

    def __init__(self, net: ByteConvNet):
        self.net = net
        one = {(w, j): net.p["emb"] @ net.p[f"f{w}"][j * DIM : (j + 1) * DIM] for w in WIDTHS for j in range(w)}
        pair = lambda a, b: (one[a][:, None] + one[b][None]).reshape(-1, FILTERS)
        self.parts = {w: [(j, pair((w, j), (w, j + 1))) for j in range(0, w - 1, 2)] + ([(w - 1, one[w, w - 1])] if w % 2 else []) for w in WIDTHS}

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = []
        for w in WIDTHS:
            n, z = x.shape[1] - w + 1, None
            for j, table in self.parts[w]:
                part = table.take((pairs if len(table) > 256 else x)[:, j : j + n], 0)
                z = part if z is None else np.add(z, part, out=z)
            pooled.append(np.maximum(z.max(1) + self.net.p[f"b{w}"], 0))
        s = np.concatenate(pooled, 1) @ self.net.p["out"] + self.net.p["bias"]
        s = s - s.max(1, keepdims=True)
        return s - np.log(np.exp(s).sum(1, keepdims=True))


@lru_cache(1)
def unrolled(labels: tuple[str, ...], raw: bytes) -> Unrolled:
    return Unrolled(load_net(labels, raw))


def train(docs: DataFrame, per_label: int = 500, windows_per_text: int = 4, epochs: int = 4, id: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 42) -> tuple[tuple[str, ...], bytes] | None:
    """Labels and weights learned from about ``per_label`` texts of each non-null language outside the held-out fold.

    Of a sampled text at most ``windows_per_text`` seeded random windows are learned from; they are cut in the tasks, so the
    driver gets no texts. None if nothing can be learned.
    """
    rows = labelled_sample(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")), "lang", per_label)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, label, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text")), strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                w = windows(raw)
                pick = np.random.default_rng([seed, zlib.crc32(raw)]).permutation(len(w))[:windows_per_text]
                out.append((k, label, w[pick].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*out, strict=True) if out else [[]] * 3, (*batch.columns[:2], pa.array([], pa.binary())), strict=True)], names=["doc_id", "lang", "x"])

    short_batches(docs.sparkSession)
    rows = rows.select("doc_id", "lang", "text").filter("length(text) > 0")
    found = sorted((r["doc_id"], r["lang"], bytes(r["x"])) for r in rows.mapInArrow(cut, rows.select("doc_id", "lang").withColumn("x", F.lit(b"")).schema).collect())
    labels = tuple(sorted({x[1] for x in found}))
    if not labels:
        return None
    xs = [np.frombuffer(x, np.uint8).reshape(-1, WINDOW) for _, _, x in found]
    ys = np.repeat([labels.index(label) for _, label, _ in found], [len(x) for x in xs])
    net = ByteConvNet(list(labels), seed)
    net.fit(np.concatenate(xs), ys, epochs, seed=seed)
    return labels, net.weights()


def predict(docs: DataFrame, model: tuple[tuple[str, ...], bytes] | None, text: str = "text", batch_windows: int = 1024, made: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with lang_pred and score (the mean window probability of that language, 0 for ``und``).

    Null texts and texts without a letter are ``und``, all texts if there is no model. Rows stay one for
    one and equal texts get equal results; columns with the new names (``made``) are replaced.
    """
    short_batches(docs.sparkSession)
    kept = own_columns(docs, list(made), [text])
    names = [*kept.columns, *made]
    schema = kept.withColumns({made[0]: F.lit(""), made[1]: F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = unrolled(*model) if model else None
        for batch in batches:
            texts = batch.column(text).to_pylist()
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if net:
                known = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
                group: list[tuple[int, np.ndarray]] = []
                held = 0

                def flush() -> None:
                    x = np.concatenate([w for _, w in group])
                    logp = np.concatenate([net.log_probs(x[k : k + batch_windows]) for k in range(0, len(x), batch_windows)])
                    at = 0
                    for k, w in group:
                        mine = logp[at : at + len(w)]
                        at += len(w)
                        best = int(mine.sum(0).argmax())
                        lang[k], score[k] = net.net.labels[best], float(np.exp(mine[:, best]).mean())

                for k in known:
                    w = windows(texts[k].encode("utf-8", "surrogatepass"))
                    group.append((k, w))
                    held += len(w)
                    if held >= batch_windows:
                        flush()
                        group, held = [], 0
                if group:
                    flush()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1), pa.float64())], names=names)

    return kept.mapInArrow(run, schema)


def recognised(docs: DataFrame, floor: float = 0.3, **params) -> DataFrame:
    """The documents that get a language with a score of ``floor`` or more; the network is trained on their own ``lang`` column.

    Texts without a letter go, and those of which the network is as good as undecided: of held-out documents of the test
    tables whose language it finds, none scores below 0.5. Columns stay as they are; an empty table gives an empty table.
    """
    lang, score = own_names(2)
    return predict(docs, train(docs, **params), made=(lang, score)).filter((F.col(lang) != UNKNOWN) & (F.col(score) >= floor)).drop(lang, score)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    docs = load(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang"))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
