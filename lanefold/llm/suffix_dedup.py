"""Removal of repeated byte strings with suffix arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts elsewhere, in any text. Equal
strings must meet in one suffix array, whichever shard holds it, so each window of ``length`` bytes is
given to its anchor, the smallest hash among its ``GRAM``-byte substrings (leftmost of equal ones):
equal windows have equal anchors at equal places. Neighbouring windows of one anchor form a segment.

1. Segments are counted by (anchor, content). Anchors that occur once are done.
2. A segment that occurs twice is repeated in all its windows. Different segments of one anchor go, one
   copy each, to a shard by anchor. The shard's suffix array is built by induced sorting: suffixes are
   classified, leftmost-smaller substrings are sorted by a first induction, named, and sorted
   recursively; the order of all suffixes is induced from theirs in linear time. Induction is done by
   bucket with numpy. Permuted common prefixes give each window's longest match with another one.
3. An anchor whose different segments exceed ``ANCHOR_BYTES`` is too large for one array: its segments
   are cut by longer anchors (250, 325, ... bytes) and counted and searched in the same way.
4. The repeated windows are sent back to the texts that hold the segments, and bytes are cut there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanefold.llm._common import load, own_columns, own_names, short_batches, text_key, written

GRAM = 100
SHARD_BYTES = 1 << 20
#: An anchor whose different segments have more bytes is split by longer substrings.
ANCHOR_BYTES = 2 << 20
#: Symbols beyond which a reduced string is written with two digits a symbol, as induction goes bucket by bucket.
WIDE = 1024
RANGES = "array<struct<from:int,to:int>>"

# --- suffix arrays --------------------------------------------------------------------------------


class _Induction:
    """Buckets of one string, and the two induced-sorting passes over them."""

    def __init__(self, t: np.ndarray, sigma: int):
        self.sigma, n = sigma, len(t)
        self.t = t.astype(np.uint8 if sigma <= 256 else np.uint16 if sigma <= 1 << 16 else np.uint32)  # short keys sort by radix
        step = np.diff(t)
        at = np.where(step != 0, np.arange(n - 1), n)
        nearest = np.minimum.accumulate(at[::-1])[::-1]  # the next place where the symbol changes
        self.small = np.ones(n, bool)
        self.small[:-1] = step[np.minimum(nearest, n - 2)] > 0
        count = np.bincount(t, minlength=sigma)
        self.end = np.cumsum(count)
        self.start = self.end - count
        #: Whether the suffix one symbol longer is a larger, or a smaller one.
        self.after_large, self.after_small = np.zeros(n, bool), np.zeros(n, bool)
        self.after_large[1:], self.after_small[1:] = ~self.small[:-1], self.small[:-1]
        self.count = np.arange(n, dtype=np.int32)
        self.lms = (np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1).astype(np.int32)

    def _put(self, sa: np.ndarray, edge: np.ndarray, j: np.ndarray, sign: int) -> None:
        """Append suffixes to their buckets in the order given, at the front (1) or from the back (-1)."""
        key = self.t[j]
        order = key.argsort(kind="stable")
        key = key[order]
        size = np.bincount(key, minlength=self.sigma)
        first = size.cumsum()
        first -= size
        if sign > 0:
            sa[(edge - first)[key] + self.count[: len(key)]] = j[order]
            edge += size
        else:
            sa[(edge - 1 + first)[key] - self.count[: len(key)]] = j[order]
            edge -= size

    def run(self, lms: np.ndarray) -> np.ndarray:
        """The order of all suffixes induced from ``lms`` in the order given.

        A bucket is read once: what it induces in itself is appended at once, all else goes to the other buckets together.
        """
        sa = np.full(len(self.t), -1, np.int32)
        tail = self.end.copy()
        self._put(sa, tail, lms[::-1], -1)
        head = self.start.copy()
        large, small = self.after_large, self.after_small
        for c in range(self.sigma):  # larger suffixes, left to right
            done, stop, found = self.start[c], head[c], []
            while done < stop:
                part, done = sa[done:stop], stop
                j = part[large[part]] - 1
                own = self.t[j] == c
                if own.any():
                    n = np.count_nonzero(own)
                    sa[stop : stop + n] = j[own]
                    stop += n
                    j = j[~own]
                found.append(j)
            head[c] = stop
            if tail[c] < self.end[c]:
                part = sa[tail[c] : self.end[c]]
                found.append(part[large[part]] - 1)
            if found:
                j = np.concatenate(found) if len(found) > 1 else found[0]
                if len(j):
                    self._put(sa, head, j, 1)
        tail = self.end.copy()
        for c in range(self.sigma - 1, -1, -1):  # smaller suffixes, right to left
            done, stop, found = self.end[c], tail[c], []
            while done > stop:
                part, done = sa[stop:done][::-1], stop
                j = part[small[part]] - 1
                own = self.t[j] == c
                if own.any():
                    n = np.count_nonzero(own)
                    sa[stop - n : stop] = j[own][::-1]
                    stop -= n
                    j = j[~own]
                found.append(j)
            tail[c] = stop
            if self.start[c] < head[c]:
                part = sa[self.start[c] : head[c]][::-1]
                found.append(part[small[part]] - 1)
            if found:
                j = np.concatenate(found) if len(found) > 1 else found[0]
                if len(j):
                    self._put(sa, tail, j, -1)
        sa[0] = len(self.t) - 1  # the end mark is the smallest suffix
        return sa


def _digits(t: np.ndarray, sigma: int) -> tuple[np.ndarray, int, _Induction] | None:
    """Two digits a symbol, which keeps the order of suffixes; None if no base leaves fewer smaller substrings than symbols."""
    root, best = int(np.ceil(np.sqrt(sigma))), None
    for base in (root, root + root // 3, root - root // 4, root * 2, root // 2 + 1):
        digits = np.empty(2 * len(t) - 1, np.int32)
        digits[0::2], digits[1::2] = t // base + 1, (t % base + 1)[:-1]
        digits[-1] = 0
        work = _Induction(digits, max(base, -(-sigma // base)) + 2)
        if best is None or len(work.lms) < len(best[2].lms):
            best = digits, work.sigma, work
        if len(work.lms) <= 0.7 * len(t):
            break
    return best if len(best[2].lms) <= 0.92 * len(t) else None


def suffix_array(t: np.ndarray, sigma: int, work: _Induction | None = None) -> np.ndarray:
    """Suffix array of ``t``, whose last symbol 0 occurs nowhere else; symbols are below ``sigma``.

    The recursion ends where all leftmost-smaller substrings differ; every level is shorter than the one before.
    """
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    if work is None and sigma > WIDE and (split := _digits(t, sigma)):
        sa = suffix_array(*split)
        return sa[sa % 2 == 0] // 2
    work = work or _Induction(t, sigma)
    lms = work.lms
    sa = work.run(lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]  # sorted by leftmost-smaller substrings
    # Names: equal neighbours have equal length and content.
    stop = np.zeros(n, np.int32)
    stop[lms[:-1]], stop[lms[-1]] = lms[1:], n - 1
    size = stop[order] - order + 1
    new = np.concatenate(([0], np.cumsum(~_equal_neighbours(work.t, order, size))))
    if new[-1] == len(order) - 1:
        return work.run(order)
    # A name that occurs once decides every comparison that reaches it, so of a run of such names only the first is kept.
    many = np.bincount(new)[new] > 1
    name, several = np.zeros(n, np.int32), np.zeros(n, bool)
    name[order], several[order] = new, many
    several = several[lms]
    stay = several.copy()
    stay[1:] |= several[:-1]
    stay[-1] = True  # the end mark
    used = np.zeros(int(new[-1]) + 1, bool)
    kept = name[lms[stay]]
    used[kept] = True
    inner = suffix_array((np.cumsum(used) - 1)[kept].astype(np.int32), int(used.sum()))
    inner = np.flatnonzero(stay)[inner]
    order[many] = lms[inner[several[inner]]]
    return work.run(order)


def _equal_neighbours(t: np.ndarray, order: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the substring of ``size`` symbols at each place of ``order`` is the same as at the place before it; 8 bytes at a time."""
    width = t.itemsize
    step = 8 // width
    words = np.ndarray((len(t),), "<u8", np.append(t, np.zeros(step, t.dtype)).tobytes(), strides=(width,))
    same = size[1:] == size[:-1]
    todo, k = np.flatnonzero(same), 0
    while len(todo):
        left = size[todo] - k
        beyond = (np.maximum(step - left, 0) * (8 * width)).astype(np.uint64)
        ok = (words[order[todo + 1] + k] ^ words[order[todo] + k]) << beyond == 0
        same[todo[~ok]] = False
        k += step
        todo = todo[ok & (left > step)]
    return same


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        m, b = 1 << max(16, (n - 1).bit_length()), 0x5851F42D4C957F2D
        _POWERS[:] = [np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(m - 1, x, np.uint64)))) for x in (b, pow(b, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def permuted_lcp(raw: np.ndarray, sa: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place the suffix before it in order, and the length of their common prefix (``most`` at most compared).

    Only irreducible places, where the symbol before differs too, are compared; elsewhere the value is
    that of the place before less one.
    """
    n = len(raw)
    phi = np.empty(n, np.int32)
    phi[sa[1:]], phi[sa[0]] = sa[:-1], -1
    pad = np.concatenate((raw, np.zeros(most + 16, np.uint8)))
    eight = np.ndarray((n + most + 8,), "<u8", pad.tobytes(), strides=(1,))
    i = np.arange(n)
    plain = (i > 0) & (phi > 0)
    plain[plain] = raw[i[plain] - 1] == raw[phi[plain] - 1]
    todo = np.flatnonzero(~plain & (phi >= 0))
    got = np.zeros(n, np.int64)
    size = 0
    while len(todo) and size < most:
        x = eight[todo + size] ^ eight[phi[todo] + size]
        same = x == 0
        stop = ~same
        got[todo[stop]] = size + np.bitwise_count((x[stop] & (~x[stop] + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
        todo, size = todo[same], size + 8
    got[todo] = size
    return phi, np.maximum(np.maximum.accumulate(np.where(plain, 0, got + i)) - i, 0)


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part, the starts of its strings of ``length`` bytes that occur at another place of any part."""
    raw = np.frombuffer(b"\xff".join(parts), np.uint8)  # no UTF-8 text has this byte
    dense = np.cumsum(np.bincount(raw, minlength=256) > 0)  # symbols in use, from 1; 0 ends the string
    sa = suffix_array(np.append(dense[raw], 0), int(dense[-1]) + 1)[1:]
    phi, lcp = permuted_lcp(raw, sa, 4 * length)
    found = np.zeros(len(raw), bool)
    hit = np.flatnonzero(lcp >= length)
    found[hit] = True
    found[phi[hit]] = True
    out, at = [], 0
    for p in parts:
        out.append(np.flatnonzero(found[at : at + max(len(p) - length + 1, 0)]))
        at += len(p) + 1
    return out


# --- segments -------------------------------------------------------------------------------------

_SALT = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)
_LOW = np.uint64(24)


def segments(raw: bytes, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """first window, number of windows, anchor (of ``gram`` bytes) and content hash (signed) of the segments of one text."""
    n = len(raw)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    data = np.frombuffer(raw, np.uint8)
    base, back = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_SALT[data] * back[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * base[: n - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    w, m = length - gram + 1, n - length + 1
    mask = np.uint64((1 << 24) - 1)
    first, count, anchor = [], [], []
    # pieces keep places within 24 bits
    for a in range(0, m, 1 << 23):
        b = min(m, a + (1 << 23))
        part = h[a : b + w - 1]
        keys = np.full(-(-len(part) // w) * w, np.iinfo(np.uint64).max)
        keys[: len(part)] = (part & ~mask) | np.arange(len(part), dtype=np.uint64)
        grid = keys.reshape(-1, w)
        up = np.minimum.accumulate(grid, 1).ravel()
        down = np.ascontiguousarray(np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1]).ravel()
        place = (np.minimum(down[: b - a], up[w - 1 : w - 1 + b - a]) & mask).astype(np.int64)
        cut = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        first.append(cut + a)
        count.append(np.diff(np.append(cut, b - a)))
        anchor.append(part[place[cut]])
    first, count, anchor = (np.concatenate(x) for x in (first, count, anchor))
    view = memoryview(raw)
    digest = xxhash.xxh3_64_intdigest
    content = np.fromiter((digest(view[i : i + k + length - 1]) for i, k in zip(first.tolist(), count.tolist(), strict=True)), np.uint64, len(first))
    return first, count, anchor.view(np.int64), content.view(np.int64)


def _utf8(t: str | None) -> bytes:
    return (t or "").encode("utf-8", "surrogatepass")


def _batch(cols: list, kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def count_segments(docs: DataFrame, length: int, text: str) -> DataFrame:
    """t1, t2, key, seg, n, windows: how often each segment occurs in a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for t, t1, t2 in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                _, count, key, seg = segments(_utf8(t), length)
                if len(key):
                    _, at, n = np.unique(key * 31 + seg, return_index=True, return_counts=True)
                    for c, x in zip(cols, (np.full(len(at), t1), np.full(len(at), t2), key[at], seg[at], n, count[at]), strict=True):
                        c.append(x)
            if cols[0]:
                yield _batch([np.concatenate(c) for c in cols], [pa.int64()] * 6, ["t1", "t2", "key", "seg", "n", "windows"])

    return docs.select(F.col(text), *text_key(text)).mapInArrow(run, "t1 long, t2 long, key long, seg long, n long, windows long")


def fetch_segments(docs: DataFrame, wanted: DataFrame, length: int, text: str) -> DataFrame:
    """key, seg, data of the wanted (t1, t2, key, seg), one row each."""
    lists = wanted.groupBy(F.col("t1").alias("w1"), F.col("t2").alias("w2")).agg(F.collect_list(F.struct("key", "seg")).alias("want"))
    rows = docs.select(F.col(text).alias("t"), *text_key(text)).join(lists, F.expr("t1 = w1 and t2 = w2")).select("t", "t1", "t2", "want")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for batch in batches:
            out = []
            for t, t1, t2, want in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if (t1, t2) in done:
                    continue
                if len(done) < 100_000:
                    done.add((t1, t2))
                raw, need = _utf8(t), {(x["key"], x["seg"]) for x in want}
                first, count, key, seg = segments(raw, length)
                for i, k, a, s in zip(first.tolist(), count.tolist(), key.tolist(), seg.tolist(), strict=True):
                    if (a, s) in need:
                        need.discard((a, s))
                        out.append((a, s, raw[i : i + k + length - 1]))
            if out:
                yield _batch(list(zip(*out, strict=True)), [pa.int64(), pa.int64(), pa.binary()], ["key", "seg", "data"])

    return rows.mapInArrow(run, "key long, seg long, data binary").groupBy("key", "seg").agg(F.first("data").alias("data"))


def _runs(at: np.ndarray) -> list[dict]:
    cut = np.flatnonzero(np.diff(at) > 1) + 1
    return [{"from": int(p[0]), "to": int(p[-1])} for p in np.split(at, cut)] if len(at) else []


def shard_ranges(data: DataFrame, length: int) -> DataFrame:
    """key, seg, ranges (windows from-to that occur in another place) from one suffix array a shard."""
    total = data.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_BYTES))
    kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))

    def run(table: pa.Table) -> pa.Table:
        parts = table.column("data").to_pylist()
        found = [_runs(x) for x in repeated_windows(parts, length)]
        return pa.table({"key": table.column("key"), "seg": table.column("seg"), "ranges": pa.array(found, kind)})

    rows = data.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return rows.groupBy("shard").applyInArrow(run, f"key long, seg long, ranges {RANGES}").filter("size(ranges) > 0")


def _small_and_large(data: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments of anchors with at most ``ANCHOR_BYTES`` of different ones, and of the others."""
    size = data.groupBy("key").agg(F.sum(F.octet_length("data")).alias("size")).filter(F.col("size") > ANCHOR_BYTES).select("key")
    large = written(size, "large-anchors")
    return data.join(large, "key", "left_anti"), data.join(large, "key", "left_semi")


def longer_anchors(data: DataFrame, length: int, gram: int) -> DataFrame:
    """key, seg, ranges of segments whose anchor has too many for one array: each is cut into segments by anchors of
    ``gram`` bytes, which are counted and searched in the same way. Anchors of ``length`` bytes are whole windows, so
    equal ones have been counted and none is left to search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, s, d in zip(*(batch.column(c).to_pylist() for c in ("key", "seg", "data")), strict=True):
                first, count, key, seg = segments(d, length, gram)
                n = len(first)
                parts = [d[i : i + c + length - 1] for i, c in zip(first.tolist(), count.tolist(), strict=True)]
                kinds = [*[pa.int64()] * 2, pa.int32(), pa.int32(), *[pa.int64()] * 2, pa.binary()]
                yield _batch([np.full(n, k), np.full(n, s), first.astype(np.int32), count.astype(np.int32), key, seg, parts], kinds, ["of_key", "of_seg", "at", "windows", "key", "seg", "data"])

    found = written(data.select("key", "seg", "data").mapInArrow(run, "of_key long, of_seg long, at int, windows int, key long, seg long, data binary"), "inner-segments")
    by_content = written(found.groupBy("key", "seg").agg(F.count("*").alias("n")), "inner-contents")
    whole = by_content.filter("n > 1").select("key", "seg", F.lit(None).cast(RANGES).alias("ranges"))
    several = by_content.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("key")
    one = written(found.join(several, "key", "left_semi").groupBy("key", "seg").agg(F.first("data").alias("data")), "inner-data")
    single = by_content.filter("n = 1").select("key", "seg")
    inner = whole.unionByName(searched(one, length, gram).join(single, ["key", "seg"], "left_semi"))
    hit = found.drop("data").join(inner, ["key", "seg"])
    every = F.array(F.struct(F.lit(0).alias("from"), (F.col("windows") - 1).alias("to")))
    moved = F.transform(F.coalesce("ranges", every), lambda r: F.struct((r["from"] + F.col("at")).alias("from"), (r["to"] + F.col("at")).alias("to")))
    out = hit.select(F.col("of_key").alias("key"), F.col("of_seg").alias("seg"), moved.alias("ranges"))
    return out.groupBy("key", "seg").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def searched(data: DataFrame, length: int, gram: int) -> DataFrame:
    """key, seg, ranges of different segments (key, seg, data) by suffix arrays, crowded anchors by longer ones first."""
    if gram >= length:
        return shard_ranges(data.limit(0), length)
    small, large = _small_and_large(data)
    found = shard_ranges(small, length)
    if large.limit(1).count():
        found = found.unionByName(longer_anchors(large, length, gram + max(1, (length - gram + 1) // 2)))
    return found


def repeated_segments(docs: DataFrame, length: int, text: str) -> tuple[DataFrame, DataFrame]:
    """The segment counts of all texts, and (key, seg, ranges) of segments with repeated windows; null ranges: all windows."""
    seen = written(count_segments(docs, length, text), "segments")
    by_content = seen.groupBy("key", "seg").agg(F.sum("n").alias("n"), F.min(F.struct("t1", "t2")).alias("one"))
    by_content = written(by_content, "contents")
    many = by_content.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    whole = by_content.filter("n > 1").select("key", "seg", F.lit(None).cast(RANGES).alias("ranges"))
    # Segments that occur twice need no search themselves, but others are compared with them.
    wanted = by_content.join(many, "key").select("one.t1", "one.t2", "key", "seg")
    data = written(fetch_segments(docs, wanted, length, text), "segment-data")
    single = by_content.filter("n = 1").select("key", "seg")
    parts = searched(data, length, GRAM).join(single, ["key", "seg"], "left_semi")
    return seen, written(whole.unionByName(parts), "repeated")


def cut_repeats(docs: DataFrame, length: int = 400, text: str = "text") -> DataFrame:
    """``docs`` with kept_text (binary: the bytes that stay), n_bytes, n_removed and n_spans.

    Texts are UTF-8 bytes, null as empty; texts shorter than ``length`` stay whole. Copies of one text
    lose all bytes if it is long enough. What repeats is judged on the input, not on what is left.
    Rows stay one for one; columns with the new names are replaced; an empty table gives an empty table.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    short_batches(docs.sparkSession)
    seen, found = repeated_segments(docs, length, text)
    one, two, hits_of, k1, k2 = own_names(5)
    lists = seen.select("t1", "t2", "key", "seg").join(found, ["key", "seg"]).groupBy(F.col("t1").alias(one), F.col("t2").alias(two)).agg(F.collect_set(F.struct("key", "seg", "ranges")).alias(hits_of))
    new = ["kept_text", "n_bytes", "n_removed", "n_spans"]
    kept = own_columns(docs, new, [text])
    rows = kept.withColumns({k1: text_key(text)[0], k2: text_key(text)[1]})
    rows = rows.join(lists, (F.col(k1) == F.col(one)) & (F.col(k2) == F.col(two)), "left").select(*kept.columns, hits_of)
    names = [*kept.columns, *new]
    schema = kept.withColumns({"kept_text": F.lit(b"")} | {c: F.lit(0).cast("long") for c in new[1:]}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, hits in zip(batch.column(text).to_pylist(), batch.column(hits_of).to_pylist(), strict=True):
                raw = _utf8(t)
                mark = np.zeros(len(raw) + 1, np.int64)
                ranges = {(x["key"], x["seg"]): x["ranges"] for x in hits or ()}
                if ranges:
                    first, count, key, seg = segments(raw, length)
                    for i, k, a, s in zip(first.tolist(), count.tolist(), key.tolist(), seg.tolist(), strict=True):
                        if (a, s) in ranges:
                            for r in ranges[a, s] or ({"from": 0, "to": k - 1},):
                                mark[i + r["from"]] += 1
                                mark[i + r["to"] + length] -= 1
                gone = np.cumsum(mark[:-1]) > 0
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
                stay = np.frombuffer(raw, np.uint8)[~gone].tobytes() if spans else raw
                out.append((stay, len(raw), len(raw) - len(stay), spans))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(c, k) for c, k in zip(cols, [pa.binary(), *[pa.int64()] * 3], strict=True)]], names=names)

    return rows.mapInArrow(run, schema)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the hash of the kept bytes of every document."""
    found = cut_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_text", 256).alias("kept_sha256"))
