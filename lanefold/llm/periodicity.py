"""Runs of words that repeat with a period, found through suffix trees.

A run is a longest stretch with a smallest period. Every run holds, for one of the two orders of letters, a
Lyndon word as long as its period that is the longest Lyndon word at its start; so two candidates a place
are enough. A candidate is extended to the right and to the left by longest common extensions: the depth of
the lowest common ancestor of two leaves, in the suffix tree of the text and in that of its reversal. Trees
are built by Ukkonen's algorithm; ancestors are minima over the Euler tour, answered in constant time from
a table of block minima.

Where no run can lie, no tree is needed: in a run of ``length`` words and period q, any
``length - 2 q`` words in a row recur in the same document. Stretches of such words are cut out first, and
as a run lies in one stretch with everything that could extend it, nothing is lost.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lanefold.llm._common import load, own_columns, short_batches

LEAST, TIMES = 24, 3
#: Any so many words in a row inside a run recur: length - 2 q >= length / 3 >= 8.
RECUR = LEAST - 2 * (LEAST // TIMES)
#: Words of the stretches that share one tree; a longer stretch gets a tree of its own.
TREE_WORDS = 1 << 14
BLOCK = 16


class SuffixTree:
    """Ukkonen's suffix tree of ``s``, whose last letter is the only 0.

    ``first[i]`` is the place of the leaf of suffix i in the Euler tour. Building takes about 600 bytes of memory a letter.
    """

    def __init__(self, s: list[int], letters: int):
        n = len(s)
        start, end, link, depth, suffix = [0], [0], [0], [0], [-1]
        kids: dict[int, int] = {}
        node = edge = length = rest = 0
        for i, c in enumerate(s):
            rest += 1
            last = 0
            while rest:
                if not length:
                    edge = i
                key = node * letters + s[edge]
                child = kids.get(key)
                if child is None:
                    kids[key] = len(start)
                    parent = node
                else:
                    at = start[child]
                    span = min(end[child], i + 1) - at
                    if length >= span:
                        node, edge, length = child, edge + span, length - span
                        continue
                    if s[at + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    parent = kids[key] = len(start)
                    start.append(at)
                    end.append(at + length)
                    link.append(0)
                    depth.append(rest - 1)
                    suffix.append(-1)
                    start[child] = at = at + length
                    kids[parent * letters + s[at]] = child
                    kids[parent * letters + c] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                depth.append(n - i + rest - 1)
                suffix.append(i - rest + 1)
                if last:
                    link[last] = parent
                last = parent
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        self.n, self.letters = n, letters
        self.depth = np.array(depth, np.int32)
        self.suffix = np.array(suffix, np.int64)
        self.keys = np.fromiter(kids.keys(), np.int64, len(kids))
        self.child = np.fromiter(kids.values(), np.int64, len(kids))
        self.parent = np.zeros(len(start), np.int64)
        self.parent[self.child] = self.keys // letters
        down = np.argsort(self.depth, kind="stable")[1:].tolist()  # parents come before their children
        up, size = self.parent.tolist(), [1] * len(start)
        for v in reversed(down):
            size[up[v]] += size[v]
        self._down, self._up, self._size = down, up, np.array(size, np.int64)

    def entered(self, end_last: bool = False) -> np.ndarray:
        """When the Euler tour enters each node, children in the order of their letters; ``end_last``: the end of the text is the largest letter."""
        keys = np.where(self.keys % self.letters == 0, self.keys + self.letters - 1, self.keys - 1) if end_last else self.keys
        order = np.argsort(keys)
        child = self.child[order]
        before = np.cumsum(2 * self._size[child]) - 2 * self._size[child]
        head = np.ones(len(child), bool)
        head[1:] = self.parent[child[1:]] != self.parent[child[:-1]]
        at = np.zeros(len(self.depth), np.int64)
        at[child] = 1 + before - np.maximum.accumulate(np.where(head, before, 0))
        enter, up = at.tolist(), self._up
        for v in self._down:
            enter[v] += enter[up[v]]
        return np.array(enter, np.int64)

    def leaves(self, enter: np.ndarray) -> np.ndarray:
        """``enter`` of the leaf of each suffix."""
        out = np.empty(self.n, np.int64)
        leaf = self.suffix >= 0
        out[self.suffix[leaf]] = enter[leaf]
        return out

    def tour(self, enter: np.ndarray) -> np.ndarray:
        """The depth in letters of each node that the Euler tour visits."""
        out = np.empty(2 * len(enter) - 1, np.int32)
        out[enter] = self.depth
        out[(enter + 2 * self._size - 1)[self.child]] = self.depth[self.parent[self.child]]
        return out


class Extensions:
    """Longest common extensions of suffixes: minima over the Euler tour."""

    def __init__(self, tree: SuffixTree, enter: np.ndarray):
        self.first = tree.leaves(enter)
        tour = tree.tour(enter)
        blocks = np.full(-(-len(tour) // BLOCK) * BLOCK, np.iinfo(np.int32).max, np.int32)
        blocks[: len(tour)] = tour
        self.flat, blocks = blocks, blocks.reshape(-1, BLOCK)
        self.head = np.minimum.accumulate(blocks, 1).ravel()
        self.tail = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [blocks.min(1)]
        while 2 << (len(self.table) - 1) <= len(blocks):
            low, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many letters the suffixes i and j (different ones) share."""
        a, b = self.first[i], self.first[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        left, right = a // BLOCK, b // BLOCK
        out = np.minimum(self.tail[a], self.head[b])
        same = np.flatnonzero(left == right)
        if len(same):
            place = a[same, None] + np.arange(BLOCK)
            out[same] = np.where(place <= b[same, None], self.flat[np.minimum(place, len(self.flat) - 1)], np.iinfo(np.int32).max).min(1)
        between = right - left - 1
        for k in range(len(self.table)):
            some = np.flatnonzero((between >> k) == 1)
            if len(some):
                row = self.table[k]
                out[some] = np.minimum(out[some], np.minimum(row[left[some] + 1], row[right[some] - (1 << k)]))
        return out.astype(np.int64)


def next_smaller(values: list[int]) -> np.ndarray:
    """The next place with a smaller value, the number of values where there is none."""
    out, open_ = [len(values)] * len(values), []
    for i, v in enumerate(values):
        while open_ and values[open_[-1]] > v:
            out[open_.pop()] = i
        open_.append(i)
    return np.array(out, np.int64)


def repetitions(letters: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of every run of ``letters`` that has at least ``least`` letters and ``times`` periods (2 or more)."""
    n = len(letters)
    if n < max(2, least):
        return np.empty((0, 3), np.int64)
    _, codes = np.unique(letters, return_inverse=True)
    codes, sigma = codes.reshape(-1) + 1, int(codes.max()) + 2
    back = SuffixTree([*codes[::-1].tolist(), 0], sigma)
    left = Extensions(back, back.entered())
    del back
    tree = SuffixTree([*codes.tolist(), 0], sigma)
    enter = tree.entered()
    right = Extensions(tree, enter)
    i = np.arange(n, dtype=np.int64)
    lyndon = [next_smaller(tree.leaves(enter)[:n].tolist()) - i, next_smaller((-tree.leaves(tree.entered(end_last=True))[:n]).tolist()) - i]
    del tree
    found = []
    for p in lyndon:
        at = np.flatnonzero(p * times <= n)
        q = p[at]
        behind = left(n - at, n - at - q)
        length = q + behind + right(at, at + q)
        good = length >= np.maximum(least, times * q)
        found.append(np.stack([(at - behind)[good], length[good], q[good]], 1))
    return np.unique(np.concatenate(found), axis=0)


def stretches(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """(first, end) of the stretches in which a run can lie: every ``RECUR`` words in a row recur in their document.

    ``doc`` numbers the document of each word. Grams are compared by 64-bit hashes; a collision makes a stretch longer, which does no harm.
    """
    n = len(codes) - RECUR + 1
    if n <= 0:
        return np.empty((0, 2), np.int64)
    with np.errstate(over="ignore"):
        h = doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(RECUR):
            h = (h ^ (codes[k : k + n].astype(np.uint64) + np.uint64(1))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    again &= doc[:n] == doc[RECUR - 1 :]
    # a gram of another document ends a stretch: neighbours in a stretch are of one document
    edge = np.flatnonzero(np.diff(np.concatenate([[False], again, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2] + RECUR - 1
    cuts = [(b, e) for b, e in zip(begin.tolist(), end.tolist(), strict=True) if e - b >= LEAST]
    return np.array(cuts, np.int64).reshape(-1, 2)


def runs_of(codes: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(document, its runs by place in ``codes``) of all documents that have runs; stretches share trees up to ``TREE_WORDS``."""
    group: list[tuple[int, int]] = []
    held = 0

    def solve() -> Iterator[tuple[int, np.ndarray]]:
        if not group:
            return
        own = int(codes.max()) + 1
        parts, origin, at = [], [], 0
        for k, (b, e) in enumerate(group):
            parts += [codes[b:e], np.array([own + k])]  # a letter of its own parts two stretches
            origin.append((at, b))
            at += e - b + 1
        found = repetitions(np.concatenate(parts))
        first, source = (np.array(x, np.int64) for x in zip(*origin, strict=True))
        k = np.searchsorted(first, found[:, 0], "right") - 1
        found[:, 0] += source[k] - first[k]
        whose = doc[found[:, 0]]
        for d in np.unique(whose):
            yield int(d), found[whose == d]

    for b, e in stretches(codes, doc).tolist():
        if group and held + e - b > TREE_WORDS:
            yield from solve()
            group, held = [], 0
        group.append((b, e))
        held += e - b
    yield from solve()


def _tighter(a: tuple[int, int, int], b: tuple[int, int, int]) -> int:
    """Which of two runs repeats more often, exactly; then which starts first, then the shorter period."""
    return b[1] * a[2] - a[1] * b[2] or a[0] - b[0] or a[2] - b[2]


def described(found: np.ndarray) -> dict:
    """The columns of a document's runs, (start, length, period) sorted by start and period."""
    rows = [tuple(x) for x in found.tolist()]
    start, length, period = min(rows, key=cmp_to_key(_tighter)) if rows else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(rows, key=lambda x: (x[0], x[2])))
    return {"n_runs": len(rows), "start": start, "length": length, "period": period, "exponent_milli": 1000 * length // period if rows else None, "runs_sha256": hashlib.sha256(listed.encode()).hexdigest()}


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words without the later periods of any run."""
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, found[:, 0] + found[:, 2], 1)
    np.add.at(step, found[:, 0] + found[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(step)[:-1] == 0).tolist()]


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """A tenth of the documents, chosen by the checksum of the identifier, get a periodic end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


SCHEMA = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, collapsed string"


def find_runs(docs: DataFrame, text: str = "text", id: str | None = None, group_words: int = 1 << 18) -> DataFrame:
    """``docs`` with the runs of words of each text: their number, the one that repeats most often (start, length,
    period, exponent_milli), a digest of all, the text without the later periods, and its digest.

    Words are what white space (bytes 9 to 13 and 32) parts. A null, empty or blank text has no run and an empty
    collapsed text; of runs that repeat equally often the first counts, then the shorter period. Rows stay one for one,
    whatever their number; other columns stay, those with a new name are replaced. An empty table gives an empty table.
    ``id`` names a column by whose checksum a tenth of the texts get a periodic end first (a null identifier never does).
    Nothing is shuffled. A task holds about 600 bytes a word of the longest stretch of one document that recurs in it.
    """
    short_batches(docs.sparkSession)
    made = StructType.fromDDL(SCHEMA).fieldNames()
    kept = own_columns(docs, made, needed=[text, *([id] if id else [])])
    names = [*kept.columns, *made]
    schema = StructType([*kept.schema.fields, *StructType.fromDDL(SCHEMA).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            ids = batch.column(id).to_pylist() if id else [None] * len(texts)
            done: dict[int, dict] = {}
            group: list[list[bytes]] = []
            rows: list[int] = []
            held = 0

            def solve() -> None:
                number: dict[bytes, int] = {}
                codes = np.fromiter((number.setdefault(w, len(number)) for words in group for w in words), np.int64, held)
                sizes = np.array([len(words) for words in group], np.int64)
                at = np.cumsum(sizes) - sizes
                found = dict(runs_of(codes, np.repeat(np.arange(len(group)), sizes)))
                for k, words in enumerate(group):
                    mine = found.get(k, np.empty((0, 3), np.int64)) - np.array([at[k], 0, 0])
                    left = b" ".join(collapsed(words, mine) if len(mine) else words)
                    done[rows[k]] = described(mine) | {"collapsed": left.decode("utf-8", "replace"), "collapsed_sha256": hashlib.sha256(left).hexdigest()}

            for k, raw in enumerate(texts):
                words = repeated_tail((raw or b"").split(), ids[k])
                group.append(words)
                rows.append(k)
                held += len(words)
                if held >= group_words:
                    solve()
                    group, rows, held = [], [], 0
            if group:
                solve()
            out = [pa.array([done[k][name] for k in range(len(texts))], pa.string() if name.endswith("256") or name == "collapsed" else pa.int64()) for name in made]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=names)

    return kept.mapInArrow(run, schema)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, a tenth of them with a periodic end."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(docs, id="doc_id")
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
