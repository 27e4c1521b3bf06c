"""SimHash near-duplicates with pigeonring filtering.

A fingerprint is cut into ``segments`` around a ring. If two fingerprints differ in at most ``radius``
bits, some segment starts a chain such that the first l segments of it differ in at most
l * radius / segments bits in sum, for every l. So the first segments of a chain (budget below one)
are equal, the next ones up to a budget below two differ once at most, those up to a budget below three
twice with them, and so on. Each of these stretches is cut in half: of the first i stretches at least i
halves are equal, for every i. Every (start, equal segments) that this allows is a key of an equi-join;
pairs that share a key then pass the whole chain, segment by segment, which ends with the Hamming check
itself. With 9 segments and radius 4, keys of one, two or three stretches have 21, 28 or 35 bits, and a
fingerprint has 18, 45 or 126 of them: how many stretches are used follows from the number of
different fingerprints, so that keys stay short at any size. Results don't depend on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanefold.llm._common import load, own_names, short_batches, text_key, written
from lanefold.llm._components import components

#: Lower-casing of A-Z and the word separators of the contract.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Fingerprints compared at once in one key; keys with more are compared block by block.
BLOCK = 16_384


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``words`` words, or of all words if there are fewer; empty without words."""
    raw = text.encode("utf-8", "surrogatepass").translate(LOWER)
    # bytes.split() parts at space and 09-0D, which is the contract's set
    got = raw.split()
    if not got:
        return np.zeros(0, np.uint64)
    line = b" ".join(got)
    if len(got) <= words:
        return np.array([xxhash.xxh64_intdigest(line, 42)], np.uint64)
    size = np.fromiter(map(len, got), np.int64, len(got))
    end = np.cumsum(size + 1) - 1
    first = (end - size)[: len(got) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], 42) for a, b in zip(first, end[words - 1 :].tolist(), strict=True)), np.uint64, len(first))


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that more than half of the hashes have; 0 for none."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        part = np.ascontiguousarray(hashes[k : k + 65_536], ">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) and ``fp``, the fingerprint as a signed 64-bit integer.

    Null, empty and blank texts have fingerprint 0. Rows are kept one for one; a column named fp is replaced.
    """
    short_batches(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c != "fp"]
    rows = docs.select(*kept, F.col(text).alias("_text"))
    schema = docs.select(*kept).withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([majority(shingle_hashes(t or "", words)) for t in batch.column("_text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], names=[*kept, "fp"])

    return rows.mapInArrow(run, schema)


def ring(radius: int, segments: int, depth: int = 1) -> tuple[list[tuple[int, int]], list[tuple[int, list[int]]]]:
    """Bit ranges (shift, width) of the segments, and (start, equal segments) of each key.

    The first ``free`` segments of a chain have a budget below one difference, so they are equal; the i-th
    stretch after them ends where the budget reaches i + 1. ``depth`` stretches are used, as many as there are.
    """
    if not 0 <= radius < segments <= 64:
        raise ValueError("radius must be below the number of segments, and that at most 64")
    edges = [64 * k // segments for k in range(segments + 1)]
    ranges = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    ends = [max(n for n in range(1, segments + 1) if n * radius < (i + 1) * segments) for i in range(min(depth, max(radius - 1, 0)) + 1)]
    stretches = []
    for a, b in zip(ends, ends[1:], strict=False):
        if b - a < 2:
            break
        half = (a + b) // 2
        stretches.append((range(a, half), range(half, b)))
    halves = [(i, h) for i, two in enumerate(stretches) for h in two]
    enough = lambda pick: all(sum(i <= k for i, _ in pick) > k for k in range(len(stretches)))
    picks = [p for p in combinations(halves, len(stretches)) if enough(p)]
    keys = []
    for s in range(segments if radius else 1):
        for pick in picks:
            keys.append((s, [(s + k) % segments for k in [*range(ends[0]), *(k for _, h in pick for k in h)]]))
    return ranges, keys


def depth_for(n: int, radius: int, segments: int) -> int:
    """The number of stretches with the least work for ``n`` fingerprints: rows of keys, and pairs that meet in them at a
    hundredth of a row each."""

    def work(depth: int) -> float:
        ranges, keys = ring(radius, segments, depth)
        return sum(1 + 0.01 * n / 2.0 ** sum(ranges[k][1] for k in at) for _, at in keys)

    return min(range(1, max(radius, 2)), key=work)


def chain_ok(diff: np.ndarray, start: np.ndarray, radius: int, ranges: list[tuple[int, int]]) -> np.ndarray:
    """Which differences stay within the budget of every chain length from their ``start``; all round the
    ring that is the Hamming check itself, so pairs are pruned segment by segment."""
    n = len(ranges)
    shift, width = (np.array(x, np.uint64) for x in zip(*ranges, strict=True))
    mask = (np.uint64(1) << width) - np.uint64(1) if n > 1 else np.array([~np.uint64(0)])
    left, total = np.arange(len(diff)), np.zeros(len(diff), np.int64)
    for k in range(n):
        seg = (start[left] + k) % n
        total = total + np.bitwise_count((diff[left] >> shift[seg]) & mask[seg])
        ok = total * n <= (k + 1) * radius
        left, total = left[ok], total[ok]
    out = np.zeros(len(diff), bool)
    out[left] = True
    return out


def spanning_links(fps: np.ndarray, linked) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of the relation ``linked`` (of differences), found breadth first.

    Each fingerprint is compared with those not reached yet, so a group of near copies costs one pass.
    """
    rest, a, b = np.arange(len(fps)), [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            k = queue.pop()
            near = linked(fps[rest] ^ fps[k])
            if near.any():
                hit = rest[near]
                a.append(np.full(len(hit), k))
                b.append(hit)
                queue += hit.tolist()
                rest = rest[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2


EDGES = "a long, b long, key long, block binary"
#: Runs up to this length are compared together for all keys, longer ones key by key; both pass the same chain.
SHORT_RUN = 24


def _links_in(key: np.ndarray, fp: np.ndarray, starts: np.ndarray, radius: int, ranges: list) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal ``key`` that pass the chain from the key's start."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, len(key)))
    a, b = [], []
    short = np.repeat(size <= SHORT_RUN, size)
    for d in range(1, min(SHORT_RUN, len(key))):
        at = np.flatnonzero((key[d:] == key[:-d]) & short[d:])
        if not len(at):
            break
        at = at[chain_ok(fp[at] ^ fp[at + d], starts[at], radius, ranges)]
        a.append(fp[at])
        b.append(fp[at + d])
    for k in np.flatnonzero(size > SHORT_RUN):
        mine, start = fp[first[k] : first[k] + size[k]], starts[first[k]]
        x, y = spanning_links(mine, lambda diff, s=start: chain_ok(diff, np.full(len(diff), s), radius, ranges))
        a.append(mine[x])
        b.append(mine[y])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.uint64),) * 2


def _edges(batches: Iterator[pa.RecordBatch], radius: int, ranges: list, start_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links of a stream that is sorted by key; of a key beyond BLOCK members, links within blocks, and the blocks."""
    kinds = len(start_of)

    def out(a, b, key=None, block=None) -> pa.RecordBatch:
        cols = [pa.array(np.asarray(x, np.uint64).view(np.int64)) for x in (a, b)] + [pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.binary())]
        if block is not None:
            cols = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([key], pa.int64()), pa.array([block], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["a", "b", "key", "block"])

    def links(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        return out(*_links_in(k, f, start_of[k % kinds], radius, ranges))

    key, fp, hot = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
    for batch in batches:
        key = np.concatenate((key, batch.column("key").to_numpy(zero_copy_only=False)))
        fp = np.concatenate((fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)))
        if len(key) < BLOCK:
            continue
        whole = np.searchsorted(key, key[-1])  # the last run may go on in the next batch
        if whole:
            if hot is not None and key[0] == hot:
                n = np.searchsorted(key, hot, "right")
                yield out([], [], int(hot), fp[:n].tobytes())
            yield links(key[:whole], fp[:whole])
            key, fp, hot = key[whole:], fp[whole:], None
        while len(key) >= BLOCK and key[0] == key[-1]:
            yield links(key[:BLOCK], fp[:BLOCK])
            yield out([], [], int(key[0]), fp[:BLOCK].tobytes())
            hot, key, fp = key[0], key[BLOCK:], fp[BLOCK:]
            if not len(key):
                break
    if len(key):
        if hot is not None and key[0] == hot:
            n = np.searchsorted(key, hot, "right")
            yield out([], [], int(hot), fp[:n].tobytes())
        yield links(key, fp)


def _keyed(rows: DataFrame, ranges: list, keys: list, starts: bool) -> DataFrame:
    """fp and key of every key of a fingerprint (of its column ``start`` only, if ``starts``)."""

    def key_of(n: int, at: list[int]) -> Column:
        """The bits of the equal segments side by side (far below 64), and the kind of key as remainder."""
        out = F.lit(0).cast("long")
        for seg in at:
            shift, width = ranges[seg]
            out = F.shiftleft(out, width).bitwiseOR(F.shiftrightunsigned(F.col("fp"), shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1)))
        return out * len(keys) + n

    every = [key_of(n, at) if not starts else F.when(F.col("start") == s, key_of(n, at)) for n, (s, at) in enumerate(keys)]
    return rows.select("fp", F.explode(F.array_compact(F.array(*every)) if starts else F.array(*every)).alias("key"))


def _hot_members(found: DataFrame, start_of: np.ndarray) -> DataFrame:
    """fp and start of the members of crowded keys."""
    kinds, starts = len(start_of), start_of.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, block in zip(batch.column("key").to_pylist(), batch.column("block").to_pylist(), strict=True):
                fp = np.frombuffer(block, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(np.full(len(fp), starts[k % kinds], np.int32))], names=["fp", "start"])

    return found.filter("block IS NOT NULL").select("key", "block").mapInArrow(run, "fp long, start int").distinct()


def hamming_links(fps: DataFrame, radius: int = 4, segments: int = 9, depth: int | None = None) -> DataFrame:
    """a and b: links that connect the distinct values of ``fp`` exactly as all pairs within ``radius`` do.

    Keys with more than ``BLOCK`` members are cut again by the keys of all stretches from their start. What is
    crowded even then (over ``BLOCK`` fingerprints that agree in more than half their bits) is compared block by
    block. Null fingerprints are left out; an empty table gives an empty one.
    """
    spark = fps.sparkSession
    rows = written(fps.select("fp").filter("fp is not null").distinct(), "distinct")
    deepest = max(radius - 1, 1)
    depth = depth_for(rows.count(), radius, segments) if depth is None else depth
    edges, starts = None, False
    while True:
        ranges, keys = ring(radius, segments, depth)
        start_of = np.array([s for s, _ in keys])
        keyed = _keyed(rows, ranges, keys, starts).repartition("key").sortWithinPartitions("key", "fp")
        found = written(keyed.mapInArrow(lambda it, r=ranges, s=start_of: _edges(it, radius, r, s), EDGES), "links")
        part = found.filter("block IS NULL").select("a", "b")
        edges = part if edges is None else edges.unionByName(part)
        if not found.filter("block IS NOT NULL").limit(1).count():
            return edges
        if depth >= deepest:
            break
        rows, starts, depth = written(_hot_members(found, start_of), "hot"), True, deepest
    blocks = found.filter("block IS NOT NULL").select("key", "block", F.xxhash64("block").alias("h"))
    pairs = blocks.alias("x").join(blocks.alias("y"), F.expr("x.key = y.key and x.h < y.h")).select(F.col("x.block").alias("x"), F.col("y.block").alias("y"))

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                fp = np.frombuffer(x + y, np.uint64)
                a, b = spanning_links(fp, lambda diff: np.bitwise_count(diff) <= radius)
                yield pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], names=["a", "b"])

    short_batches(spark)
    return edges.unionByName(written(pairs.repartition(F.xxhash64("x", "y")).mapInArrow(across, "a long, b long"), "links"))


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, segments: int = 9, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``fp`` and ``component_id`` of every row: the smallest identifier among all that links reach.

    Null, empty and blank texts have fingerprint 0 and are linked like any other. Rows that repeat get
    equal results; a null identifier counts only if a component has no other. An empty table gives an
    empty table. Copies share a fingerprint and are represented by one value, so groups of copies cost
    nothing in the search; only distinct fingerprints are compared.
    """
    marked = written(fingerprints(docs.select(id, text), words, text, [id]), "fingerprints")
    roots = components(hamming_links(marked, radius, segments))
    each = marked.groupBy("fp").agg(F.min(id).alias("low"))
    each = written(each.join(roots, each["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "classes")
    # Both sides of the joins are tables of their own, so that a large component or many blank texts can be dealt to several tasks.
    lows = written(each.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    of = written(each.join(lows, "root").select("fp", "component_id"), "components")
    return marked.join(of, "fp").select(id, "fp", "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """The documents with one of each near-duplicate group kept: the smallest identifier, of repeated ones
    the smallest hash of the text, and of rows that share both the one with the smallest hash of the whole row. Columns stay as they are."""
    found = near_duplicates(docs, id=id, text=text, **params)
    first = found.filter(F.col(id).eqNullSafe(F.col("component_id"))).select(F.col(id).alias("_id")).distinct()
    # What stays is decided on identifiers and hashes; the texts are shuffled once, for the last join.
    slim = docs.select(F.col(id).alias("_id"), F.struct(*text_key(text)).alias("_h")).groupBy("_id", "_h").agg(F.count("*").alias("_n"))
    slim = slim.join(first, slim["_id"].eqNullSafe(first["_id"]), "left_semi")
    keep = written(slim.groupBy("_id").agg(F.min(F.struct("_h", "_n")).alias("low")).select("_id", "low._h", "low._n"), "kept")
    rows = docs.join(keep, docs[id].eqNullSafe(keep["_id"]) & (F.struct(*text_key(text)) == keep["_h"]), "left_semi")
    if keep.filter("_n > 1").isEmpty():
        return rows
    (one,) = own_names(1)
    low = F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias(one)
    return rows.groupBy(F.col(id), *text_key(text)).agg(low).select(f"{one}.*")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    found = near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
