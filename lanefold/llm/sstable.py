"""Token-id output as sorted string tables.

A shard is one file: blocks of entries whose keys are prefix-compressed, a sparse index with the last
key of every block, a Bloom filter over all keys, and a footer of fixed size that says where they are.
A lookup reads the footer, index and filter once, tests the filter, finds the block by binary search
and decodes that one block. Shards are cut by a range partitioning on the key, so their key ranges
follow one another and a reader finds the shard by binary search over the manifest.

Layout, integers little-endian::

    block     zstd( entry* )      entry: shared u8, rest u8, value length u32, key rest, value
    value     width u8 (2 or 4), then the token ids in that width
    index     entry per block: key length u8, last key, offset u64, size u32, entries u32
    filter    bit array
    footer    index offset u64, index size u64, filter offset u64, filter bits u64,
              entries u64, tokens u64, hash functions u32, magic 8 bytes

A key is 9 bytes: 0 for a null identifier or 1, then the identifier as big-endian offset binary, so
that byte order is numeric order with null first. Repeated identifiers are kept as repeated keys.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanefold.llm._common import byte_level_spec, load, shared_dir, short_batches

MAGIC = b"SSTSHRD1"
FOOTER = struct.Struct("<QQQQQQI8s")
BLOCK_BYTES = 128 << 10
#: A shard ends after this many bytes, whatever the number of partitions; its keys and index are held in memory.
SHARD_BYTES = 256 << 20
READ_ROWS = 4096
BITS_PER_KEY, HASHES = 10, 7

# --- encoding -------------------------------------------------------------------------------------

#: The white space of Unicode that the byte-level splitting pattern knows.
_WS = "\t-\r \x85\xa0  -     　"
_UNITS = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_ODD = re.compile(f"[{_WS.replace(chr(32), '')}\x00]")


class UnitEncoder:
    """Encodes whole texts with the library, each different unit of text once.

    A unit is white space with the word after it. The splitting pattern of a byte-level vocabulary
    never joins white space to what stands before it, so the ids of a text are the ids of its units,
    one after another. Units that recur are looked up; the memory of them is emptied beyond a size.
    """

    def __init__(self, path: str, most_units: int = 1_200_000, most_ids: int = 8_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        byte_level_spec(path)  # units are only right for such a file
        self.tok, self.most = Tokenizer.from_file(path), (most_units, most_ids)
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {"": -2, " ": -2}
        self.start, self.size, self.pool = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)
        self.n = self.used = 0
        self._add(["\n"], True)
        self.line = self.pool[0]

    def _add(self, units: list[str], spaced: bool = False) -> None:
        """Encode new units with the library and append their ids to the pool.

        Units without line breaks go in one text, a line each: a line break between words is always a
        token of its own, so the ids of the text fall apart at that token.
        """
        if spaced:
            lists = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch(units, add_special_tokens=False)]
            ids, size = np.concatenate(lists), np.array([len(x) for x in lists])
            start = np.cumsum(size) - size
        else:
            ids = np.array(self.tok.encode("\n".join(units), add_special_tokens=False).ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == self.line), len(ids))
            start = np.concatenate(([0], ends[:-1] + 1))
            size = ends - start
        n, used = self.n + len(units), self.used + len(ids)
        while used > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        while n > len(self.start):
            self.start, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.size))
        self.pool[self.used : used] = ids
        self.start[self.n : n], self.size[self.n : n] = start + self.used, size
        self.at.update(zip(units, range(self.n, n), strict=True))
        self.n, self.used = n, used

    def _codes(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.at.get, units, repeat(-1)), np.int64, len(units))

    def encode(self, text: str) -> np.ndarray:
        """The ids of one whole text."""
        if self.n > self.most[0] or self.used > self.most[1]:
            self._clear()
        units = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
        if units[0] == "":
            del units[0]
        if units and units[-1] == "":
            del units[-1]
        codes = self._codes(units)
        missing = np.flatnonzero(codes == -1).tolist()
        if missing:
            lacking = [units[k] for k in missing]
            fresh = dict.fromkeys(lacking)
            self.at.update(dict.fromkeys((u for u in fresh if _ODD.search(u)), -2))
            plain = [u for u in fresh if u not in self.at]
            for k in range(0, len(plain), 4096):
                self._add(plain[k : k + 4096])
            codes[missing] = self._codes(lacking)
        if (codes == -2).any() or "\0" in text:  # runs of white space: the pattern decides, a little slower
            units = _UNITS.findall(text)
            codes = np.full(len(units), -1) if "\0" in text else self._codes(units)
            if (codes < 0).any():
                new = dict.fromkeys(u for u, c in zip(units, codes.tolist(), strict=True) if c < 0)
                spaced = {u: f"\x01{u}" for u in new}  # kept apart from the units of the fast way
                if later := [u for u in new if spaced[u] not in self.at]:
                    self._add(later, True)
                for u in new:
                    if spaced[u] not in self.at:
                        self.at[spaced[u]] = self.at.pop(u)
                codes = np.where(codes < 0, self._codes([spaced.get(u, u) for u in units]), codes)
        if not len(codes):
            return np.zeros(0, np.uint32)
        size = self.size[codes]
        shift = self.start[codes] - (np.cumsum(size) - size)
        return self.pool[np.repeat(shift, size) + np.arange(size.sum())]


@lru_cache(2)
def encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


# --- one shard ------------------------------------------------------------------------------------


def key_of(doc_id: int | None) -> bytes:
    return b"\0" + bytes(8) if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key[1:])[0] - (1 << 63) if key[0] else None


def _places(key: bytes, bits: int, n: int) -> list[int]:
    a, b = xxhash.xxh64_intdigest(key, 1), xxhash.xxh64_intdigest(key, 2) | 1
    return [(a + k * b) % bits for k in range(n)]


class ShardWriter:
    """Streams sorted (key, ids) entries into a binary file; holds one block, the index and 9 bytes a key."""

    def __init__(self, out):
        self.out, self.block, self.last, self.held = out, bytearray(), b"", 0
        self.index, self.keys, self.at, self.tokens = bytearray(), [], 0, 0
        self.zip = zstandard.ZstdCompressor(level=3)

    def add(self, key: bytes, ids: np.ndarray) -> None:
        shared = len(os.path.commonprefix((self.last, key))) if self.block else 0
        width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
        value = bytes([width]) + ids.astype(f"<u{width}").tobytes()
        self.block += struct.pack("<BBI", shared, len(key) - shared, len(value)) + key[shared:] + value
        self.last, self.held, self.tokens = key, self.held + 1, self.tokens + len(ids)
        self.keys.append(key)
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        packed = self.zip.compress(bytes(self.block))
        self.out.write(packed)
        self.index += struct.pack("<B", len(self.last)) + self.last + struct.pack("<QII", self.at, len(packed), self.held)
        self.at, self.held = self.at + len(packed), 0
        self.block = bytearray()

    def close(self) -> int:
        """Writes index, filter and footer; returns the file's size."""
        if self.held:
            self._flush()
        bits = max(64, -(-len(self.keys) * BITS_PER_KEY // 8) * 8)
        filt = np.zeros(bits, np.uint8)
        for key in self.keys:
            filt[_places(key, bits, HASHES)] = 1
        packed = np.packbits(filt, bitorder="little").tobytes()
        self.out.write(bytes(self.index))
        self.out.write(packed)
        self.out.write(FOOTER.pack(self.at, len(self.index), self.at + len(self.index), bits, len(self.keys), self.tokens, HASHES, MAGIC))
        return self.at + len(self.index) + len(packed) + FOOTER.size


class ShardReader:
    """Random and sequential access to one shard in a seekable binary file."""

    def __init__(self, f, size: int):
        self.f = f
        f.seek(size - FOOTER.size)
        at, n, self.filter_at, self.bits, self.entries, self.tokens, self.hashes, magic = FOOTER.unpack(f.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard of sorted string tables")
        f.seek(at)
        raw, self.lasts, self.blocks, k = f.read(n), [], [], 0
        while k < n:
            w = raw[k]
            self.lasts.append(raw[k + 1 : k + 1 + w])
            self.blocks.append(struct.unpack_from("<QII", raw, k + 1 + w))
            k += 1 + w + 16
        self.filter: np.ndarray | None = None

    def _block(self, k: int) -> Iterator[tuple[bytes, np.ndarray]]:
        at, size, n = self.blocks[k]
        self.f.seek(at)
        raw, key, i = zstandard.ZstdDecompressor().decompress(self.f.read(size)), b"", 0
        for _ in range(n):
            shared, rest, length = struct.unpack_from("<BBI", raw, i)
            key = key[:shared] + raw[i + 6 : i + 6 + rest]
            i += 6 + rest
            yield key, np.frombuffer(raw, f"<u{raw[i]}", (length - 1) // raw[i], i + 1)
            i += length

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for k in range(len(self.blocks)):
            for key, ids in self._block(k):
                yield id_of(key), ids

    def may_hold(self, key: bytes) -> bool:
        if self.filter is None:
            self.f.seek(self.filter_at)
            self.filter = np.frombuffer(self.f.read(self.bits // 8), np.uint8)
        return all(self.filter[p >> 3] >> (p & 7) & 1 for p in _places(key, self.bits, self.hashes))

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every document with this identifier; usually one, none if it isn't there."""
        key, out = key_of(doc_id), []
        if not self.may_hold(key):
            return out
        k = bisect_left(self.lasts, key)
        while k < len(self.blocks):
            found = [ids for x, ids in self._block(k) if x == key]
            out += found
            if self.lasts[k] != key:
                break
            k += 1
        return out


def open_shard(path: str) -> ShardReader:
    fs, name = pafs.FileSystem.from_uri(path)
    return ShardReader(fs.open_input_file(name), fs.get_file_info(name).size)


# --- on Spark -------------------------------------------------------------------------------------

MANIFEST = "shard long, path string, n_docs long, n_tokens long, first_id long, last_id long, bytes long"


def write_shards(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int | None = 0, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode whole texts and write them as shards in ascending key order; returns the manifest, one row a shard.

    Null identifiers come first, ties are ordered by a hash of the text and the text; repeated rows are
    all written; a null or empty text has only the end id; an empty table gives an empty manifest;
    other columns are ignored. One range shuffle carries the texts; a task streams its rows into files of about
    ``shard_bytes`` under names of its own attempt, and only the attempts that Spark commits get into the
    manifest, so lost executors leave at most unused files behind. ``shard`` orders the files: the partition, then
    the file in it.
    """
    short_batches(docs.sparkSession)
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("k"), t.alias("t"), F.xxhash64(t).alias("h"))
    order = [F.col("k").asc_nulls_first(), F.col("h"), F.col("t")]
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select("k", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, writer, part, n = encoder(tokenizer_path), None, TaskContext.get().partitionId(), 0
        end = np.zeros(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)
        fs, root = pafs.FileSystem.from_uri(out_dir)
        attempt = uuid.uuid4().hex

        def close() -> pa.RecordBatch:
            size = writer.close()
            out.close()
            row = [part << 24 | n, f"{out_dir}/{name}", len(writer.keys), writer.tokens, first, id_of(writer.last), size]
            types = [pa.int64(), pa.string(), *[pa.int64()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], x) for v, x in zip(row, types, strict=True)], names=[c.split()[0] for c in MANIFEST.split(", ")])

        for batch in batches:
            for k, text_ in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist(), strict=True):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    name = f"part-{part:06d}-{n:06d}-{attempt}.sst"
                    out, first = fs.open_output_stream(f"{root}/{name}"), k
                    writer = ShardWriter(out)
                writer.add(key_of(k), np.concatenate((enc.encode(text_), end)))
                if writer.at >= shard_bytes:
                    yield close()
                    writer, n = None, n + 1
        if writer is not None:
            yield close()

    manifest = f"{out_dir}/manifest"
    rows.mapInArrow(run, MANIFEST).write.parquet(manifest)
    return docs.sparkSession.read.schema(MANIFEST).parquet(manifest)


def _told(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and shard of every document, read back from the files.

    ``start`` is the number of ids before the document over all shards; the running sum over shards
    goes through one task and has one row a shard.
    """
    n = max(1, manifest.count())
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    rows = manifest.withColumn("before", F.coalesce(before, F.lit(0))).select("shard", "path", "before").repartition(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out, at = [], row["before"]
                for doc_id, ids in open_shard(row["path"]).scan():
                    out.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), row["shard"]))
                    at += len(ids)
                    if len(out) == READ_ROWS:
                        yield _told(out)
                        out = []
                if out:
                    yield _told(out)

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long")


def lookup(manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc_id and ids (array of int) of the documents whose identifiers are in ``keys``, by binary search in the shards.

    Unknown identifiers give no row, repeated ones are asked once; null finds the documents without an identifier.
    """
    wanted = keys.select(F.col(key).cast("long").alias("k")).distinct()
    inside = F.coalesce(F.col("k"), F.lit(-(1 << 63))).between(F.coalesce("first_id", F.lit(-(1 << 63))), F.coalesce("last_id", F.lit(-(1 << 63))))
    asked = wanted.join(manifest.select("path", "first_id", "last_id"), inside).groupBy("path").agg(F.collect_list(F.struct("k")).alias("ks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = open_shard(row["path"])
                hits = [(k["k"], ids.tolist()) for k in row["ks"] for ids in shard.get(k["k"])]
                yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in hits], pa.int64()), pa.array([h[1] for h in hits], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return asked.mapInArrow(run, "doc_id long, ids array<long>")


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids of all documents as shards and returns what reading the files back gives."""
    import public_tokenizers

    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = write_shards(docs, shared_dir(spark, "token-shards"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_shards(manifest)
