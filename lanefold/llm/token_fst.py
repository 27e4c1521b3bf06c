"""Token counts by a compiled finite-state tokenizer.

The byte-level BPE vocabulary is compiled into two deterministic machines:

* a *splitter* over character symbols (class, next character is a non-space, contraction length)
  that marks where pre-tokens begin. It has few states, so a chunk of text is summarised by its
  whole state map (entry state -> exit state); the maps of all chunks are composed by a parallel
  prefix scan, which gives each chunk its entry state, and all chunks are then run at once;
* a *counter* over bytes whose transitions carry the number of tokens that the count of the prefix
  changes by. A state is the set of vocabulary prefixes that end here, each with the last token
  before it and the relative token count; it is determinised on demand and interned. Every
  pre-token starts in state 0, so the state map of a pre-token is constant and composing them along
  a text is a running sum; a pre-token that was met before is looked up, not run again.

Two adjacent tokens can stand side by side in a BPE result exactly if encoding their joined bytes
gives them back; a sequence is the encoding of a text exactly if all neighbours can. This makes the
last token of every prefix unique, hence the machine deterministic.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanefold.llm._common import byte_level_spec, load, short_batches

#: Character classes of the byte-level splitting pattern.
LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)
#: The contractions that the pattern splits off.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: The white space of Unicode, as code point ranges.
WHITE = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
# Splitter states: nothing yet, in a run of letters / numbers / others, after a blank that joins the
# next run, in white space, in a contraction with two or one characters to go, closed token.
START, IN_L, IN_N, IN_O, JOIN, IN_W, TWO, ONE, CLOSED = range(9)
N_STATES, N_SYMBOLS = 9, 5 * 2 * 3 * 2
CHUNK = 256
#: The counter forgets its states beyond this number and compiles them anew: memory stays bounded.
MAX_STATES = 100_000
#: Longer pre-tokens are not remembered by hash; the memory of hashes is emptied beyond MAX_MEMO.
MEMO_BYTES, MAX_MEMO = 64, 1_000_000


@lru_cache(1)
def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
    for a, b in WHITE:
        table[a : b + 1] = SPACE
    table[0x20] = BLANK
    return table


@lru_cache(1)
def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """next[state, symbol] and begins[state, symbol] (a pre-token begins at this character)."""
    nxt = np.zeros((N_STATES, N_SYMBOLS), np.uint8)
    begins = np.zeros((N_STATES, N_SYMBOLS), bool)
    runs = {LETTER: IN_L, NUMBER: IN_N, OTHER: IN_O}
    for state in range(N_STATES):
        for sym in range(N_SYMBOLS):
            kind, rest = sym % 5, sym // 5
            solid_next, short, first = rest % 2, rest // 2 % 3, rest // 6
            s = START if first else state
            if s == TWO:
                to, new = ONE, False
            elif s == ONE:
                to, new = CLOSED, False
            elif kind in runs:
                if s in (runs[kind], JOIN):
                    to, new = runs[kind], False
                else:
                    to, new = (TWO if short == 2 else ONE) if short else runs[kind], True
            else:
                inside = s in (JOIN, IN_W)
                new = not inside or bool(solid_next)
                to = JOIN if kind == BLANK and solid_next else IN_W
            nxt[state, sym], begins[state, sym] = to, new or first
    return nxt, begins


def pretoken_starts(chars: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Mask over code points: a pre-token begins here. ``firsts`` marks the first character of each text."""
    n = len(chars)
    if not n:
        return np.zeros(0, bool)
    kind = _classes()[chars]
    after = np.zeros(n, bool)
    after[:-1] = (kind[1:] < BLANK) & ~firsts[1:]
    short = np.zeros(n, np.uint8)
    for at in [np.flatnonzero(chars[:-1] == 39)]:
        for word in CONTRACTIONS:
            ok = at[at + len(word) <= n]
            for k, ch in enumerate(word[1:], 1):
                ok = ok[(chars[ok + k] == ord(ch)) & ~firsts[ok + k]]
            ok = ok[short[ok] == 0]
            short[ok] = len(word) - 1
    sym = kind + 5 * (after + 2 * (short + 3 * firsts.astype(np.uint8)))
    nxt, begins = _splitter()
    m = -(-n // CHUNK)
    grid = np.zeros(m * CHUNK, np.uint8)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(m, CHUNK).T)
    flat = nxt.ravel()
    maps = np.tile(np.arange(N_STATES, dtype=np.intp), (m, 1))
    for row in grid:
        maps = flat[maps * N_SYMBOLS + row[:, None]].astype(np.intp)
    # Inclusive prefix scan of function composition, doubling the distance each round.
    step = 1
    while step < m:
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], 1)
        step *= 2
    state = np.concatenate(([START], maps[:-1, START])).astype(np.intp)
    out, fb = np.empty((CHUNK, m), bool), begins.ravel()
    for k, row in enumerate(grid):
        at = state * N_SYMBOLS + row
        out[k] = fb[at]
        state = flat[at].astype(np.intp)
    return out.T.ravel()[:n]


@lru_cache(1)
def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary, by rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(spare)}


class TokenCounter:
    """The counting transducer of one byte-level BPE file."""

    def __init__(self, path: str):
        spec = byte_level_spec(path)
        letter = _byte_letters()
        self.special = [t["content"] for t in spec["added_tokens"]]
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if all(c in letter for c in k)}
        self.bytes = {v: bytes(letter[c] for c in k) for k, v in vocab.items()}
        self.single = {b[0]: v for v, b in self.bytes.items() if len(b) == 1}
        self.merge, self.made = {}, {}
        self.whole = np.full(max(self.bytes) + 1, -1, np.int8)
        self.memo: dict[bytes, int] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merge[vocab[a], vocab[b]] = (rank, vocab[a + b])
            self.made.setdefault(vocab[a + b], (rank, vocab[a], vocab[b]))
        self.child: list[dict[int, int]] = [{}]
        self.token = [-1]
        for v, bs in self.bytes.items():
            node = 0
            for b in bs:
                to = self.child[node].get(b)
                if to is None:
                    to = self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = to
            self.token[node] = v
        self.fits: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.states: dict[tuple, int] = {}
        self.window: list[tuple] = []
        self.delta = np.full((4096, 256), -1, np.int32)
        self._intern(((0, -1, 0),))

    def _intern(self, window: tuple) -> int:
        at = self.states.get(window)
        if at is None:
            at = self.states[window] = len(self.window)
            self.window.append(window)
            if at >= len(self.delta):
                self.delta = np.concatenate((self.delta, np.full_like(self.delta, -1)))
        return at

    def encode(self, bs: bytes) -> list[int]:
        """Plain BPE of a few bytes; used to compile transitions only."""
        ids = [self.single[b] for b in bs]
        while len(ids) > 1:
            best = min((self.merge.get(p, (1 << 30, 0)) + (k,) for k, p in enumerate(zip(ids, ids[1:], strict=False))), default=None)
            if best[0] == 1 << 30:
                break
            pair, out, k = (ids[best[2]], ids[best[2] + 1]), [], 0
            while k < len(ids):
                if k + 1 < len(ids) and (ids[k], ids[k + 1]) == pair:
                    out.append(best[1])
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def _whole(self, t: int) -> bool:
        """The token's own bytes encode to it alone."""
        if self.whole[t] < 0:
            self.whole[t] = self.encode(self.bytes[t]) == [t]
        return self.whole[t] == 1

    def _edge(self, t: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge of ``t`` while it is built, each with the rank of the merge that ends it."""
        out, ends = [], 1 << 30
        while True:
            out.append((t, ends))
            if t not in self.made:
                return out
            ends, *halves = self.made[t]
            t = halves[side]

    def _fits(self, left: int, right: int) -> bool:
        """No merge ever crosses the border: wherever two edge tokens could merge, one is consumed before.

        Among merges of one rank the leftmost goes first, so the border yields to the left token's own.
        """
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 500_000:
                self.fits.clear()
            known = True
            for a, a_ends in self._edge(left, 1):
                for b, b_ends in self._edge(right, 0):
                    m = self.merge.get((a, b))
                    if m is not None and m[0] < a_ends and m[0] <= b_ends:
                        known = False
            self.fits[left, right] = known
        return known

    def _compile(self, state: int, byte: int) -> None:
        grown, found = [], None
        for node, last, rel in self.window[state]:
            to = self.child[node].get(byte)
            if to is None:
                continue
            if self.child[to]:
                grown.append((to, last, rel))
            t = self.token[to]
            if found is None and t >= 0 and self._whole(t) and (last < 0 or self._fits(last, t)):
                found = (t, rel + 1)
        token, count = found
        window = tuple((n, p, r - count) for n, p, r in grown) + ((0, token, 0),)
        to = self._intern(window)
        if not -32 <= count < 32 or to >= 1 << 25:
            raise OverflowError(f"a transition changes the count by {count}; six bits hold it")
        self.delta[state, byte] = to << 6 | (count + 32)

    def run(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token data[start:start+size], all stepped together."""
        if len(self.window) > MAX_STATES:
            self.forget()
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        total, state = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        live = len(size) - np.searchsorted(size[::-1], np.arange(size[0] if len(size) else 0), "right")
        for k, m in enumerate(live):
            cell = state[:m] * 256 + data[start[:m] + k]
            got = self.delta.ravel()[cell]
            if got.min() < 0:
                for c in np.unique(cell[got < 0]).tolist():
                    self._compile(c >> 8, c & 255)
                got = self.delta.ravel()[cell]
            state[:m] = got >> 6
            total[:m] += (got & 63) - 32
        out = np.empty(len(size), np.int64)
        out[order] = total
        return out

    def counts(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Tokens of every pre-token; ``start`` holds where each begins. Each different short pre-token runs once."""
        size = np.diff(np.append(start, len(data)))
        out = np.zeros(len(start), np.int64)
        short = np.flatnonzero(size <= MEMO_BYTES)
        code, keys = pd.factorize(_hashes(data, start[short], size[short]))
        first = np.empty(len(keys), np.int64)
        first[code[::-1]] = short[::-1]
        if len(self.memo) > MAX_MEMO:
            self.memo.clear()
        raw = data.tobytes()
        words = [raw[a : a + n] for a, n in zip(start[first].tolist(), size[first].tolist(), strict=True)]
        known = np.fromiter(map(self.memo.get, words, repeat(0)), np.int64, len(words))
        new = np.flatnonzero(known == 0)
        known[new] = self.run(data, start[first[new]], size[first[new]])
        self.memo.update((words[k], n) for k, n in zip(new.tolist(), known[new].tolist(), strict=True))
        out[short] = known[code]
        # what is not the very pre-token that stands for its hash runs itself, like all long ones
        rest = np.concatenate((short[_differ(raw, start[short], size[short], start[first[code]], size[first[code]])], np.flatnonzero(size > MEMO_BYTES)))
        out[rest] = self.run(data, start[rest], size[rest])
        return out


def _differ(raw: bytes, a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether slice a:a+n isn't equal to slice b:b+m, of at most ``MEMO_BYTES`` bytes each; eight bytes at a time."""
    eight = np.ndarray((len(raw) + 1,), "<u8", raw + bytes(8), strides=(1,))
    bad = n != m
    todo = np.flatnonzero(~bad & (a != b))
    k = 0
    while len(todo):
        drop = np.uint64(8) * np.maximum(8 - (n[todo] - k), 0).astype(np.uint64)  # bits beyond the end
        ok = (eight[a[todo] + k] ^ eight[b[todo] + k]) << drop == 0
        bad[todo[~ok]] = True
        k += 8
        todo = todo[ok & (n[todo] > k)]
    return bad


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each slice, from one running sum."""
    base, back = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SALT[data] * back[: len(data)], out=sums[1:])
    h = (sums[start + size] - sums[start]) * base[start]
    return h ^ (h >> np.uint64(29)) ^ (size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_SALT = np.random.default_rng(42).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        m = 1 << max(20, (n - 1).bit_length())
        _POWERS[:] = [np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(m - 1, b, np.uint64)))) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


@lru_cache(2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(texts: list[str], path: str) -> list[int]:
    """Tokens of each text, as many texts at a time as the caller gives."""
    machine = counter(path)
    parts, owner, extra = [], [], [0] * len(texts)
    for k, text in enumerate(texts):
        pieces = [text]
        for s in machine.special:  # strings of added tokens are cut out first and count one each
            pieces = [p for x in pieces for p in x.split(s)]
        extra[k] = len(pieces) - 1
        for p in pieces:
            if p:
                parts.append(p)
                owner.append(k)
    if not parts:
        return extra
    joined = "".join(parts)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
    at = np.cumsum([0] + [len(p) for p in parts])[:-1]
    firsts = np.zeros(len(chars), bool)
    firsts[at] = True
    is_start = np.flatnonzero(pretoken_starts(chars, firsts))
    lead = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each character
    starts = lead[is_start]
    # The scan of the constant state maps: running sums, taken where texts begin.
    running = np.concatenate(([0], np.cumsum(machine.counts(data, starts))))
    edge = np.append(np.searchsorted(starts, lead[at]), len(starts))
    total = np.bincount(owner, np.diff(running[edge]), len(texts)).astype(np.int64) + extra
    return total.tolist()


def with_token_counts(docs: DataFrame, tokenizer_path: str, text: str = "text", batch_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` with ``n_bytes`` and ``n_tokens`` of the whole text; every other column is kept as it is.

    A null or empty text has 0 bytes and 0 tokens; repeated rows are counted one by one; an empty
    table gives an empty table. Columns of the input named n_bytes or n_tokens are replaced. There is no
    shuffle: each task streams its texts in groups of about ``batch_bytes``.
    """
    short_batches(docs.sparkSession)
    kept = docs.drop("n_bytes", "n_tokens")
    schema = kept.withColumns({"n_bytes": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            sizes, counts, group, held = [len(t.encode("utf-8", "surrogatepass")) for t in texts], [], [], 0
            for t, n in zip(texts, sizes, strict=True):
                group.append(t)
                held += n
                if held >= batch_bytes:
                    counts += count_tokens(group, tokenizer_path)
                    group, held = [], 0
            counts += count_tokens(group, tokenizer_path)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=[*batch.schema.names, "n_bytes", "n_tokens"])

    return kept.mapInArrow(run, schema)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    import public_tokenizers

    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    counted = with_token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
