"""Sequence files: FASTQ records as a table, and lanes put together.

A line is the header of a record if it begins with ``@`` and the line after the next begins with ``+``: a line of qualities
that begins with ``@`` is followed by a header and a sequence, and no sequence begins with ``+``. So every task finds
the first record of its part of a file by itself. What lies before it and what is left after the last whole
record are fragments, two a part at most; those of one gap are put together by file.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Sample, lane and mate in a file's path; the lane may be absent.
NAME = r"([^/]+?)(?:[._]L(\d+))?[._]R?([12])(?:_\d+)?\.f(?:ast)?q(?:\.gz|\.bgzf?)?$"
#: Files of gzip members that tell their length, by name.
BLOCKS = r"\.bgzf?$"
#: Fixed values of block gzip: how a member begins, the field that tells its length, and how many bytes surround the deflated ones.
MEMBER, LENGTH, AROUND = b"\x1f\x8b\x08\x04", "\x06\x00BC\x02\x00", 26
_RECORDS, _TORN = "file string, head string, seq string, plus string, qual string", "file string, part long, side int, rest binary"
_NAMES = ["file", "head", "seq", "plus", "qual"]


def inflated(line: bytes, file: str) -> bytes:
    """The text of a block-gzip member from what stands between two length fields: its length, the deflated bytes, checksum and size, and the start of the next member."""
    size = int.from_bytes(line[:2], "little") + 1 - AROUND
    data, end = line[2 : 2 + size], line[2 + size : 10 + size]
    if size < 0 or len(end) < 8 or len(line) - size - 10 not in (0, 10):
        raise ValueError(f"{file}: a member of block gzip isn't whole; read the file with another split size or as plain gzip")
    text = zlib.decompress(data, -15)
    if zlib.crc32(text) != int.from_bytes(end[:4], "little") or len(text) != int.from_bytes(end[4:], "little"):
        raise ValueError(f"{file}: a member of block gzip is damaged")
    return text


def first_header(lines: pa.Array, since: int) -> int | None:
    """Where the first record begins among ``lines``; None if they don't tell."""
    heads, plus = (np.asarray(pc.starts_with(lines, x).fill_null(False)) for x in ("@", "+"))
    found = np.flatnonzero(heads[since:-2] & plus[since + 2 :])
    return int(found[0]) + since if len(found) else None


class Part:
    """The records of one part of a file, as its lines come, or (``torn``) its fragments; a ``whole`` file has none."""

    def __init__(self, file: str, part: int, whole: bool, torn: bool):
        self.file, self.part, self.whole, self.torn, self.lines, self.synced = file, part, whole, torn, pa.array([], pa.binary()), whole
        self.since = 0  # the first line that may be a header

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        lines = pa.concat_arrays([self.lines, lines])
        if not self.synced:
            at = first_header(lines, self.since)
            if at is None:
                self.lines = lines
                return
            self.synced = True
            if self.torn:
                yield self.fragment(0, lines[:at])
            lines = lines[at:]
        n = len(lines) // 4
        self.lines = lines[4 * n :]
        if n and not self.torn:
            four = [lines.take(pa.array(np.arange(k, 4 * n, 4))).cast(pa.string()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array([self.file] * n), *four], names=_NAMES)

    def fragment(self, side: int, lines: pa.Array, more: bytes = b"") -> pa.RecordBatch:
        """What is before the first record (0), after the last (1), or a part without any (2)."""
        raw = b"".join(x + b"\n" for x in lines.to_pylist()) + more
        return pa.RecordBatch.from_arrays([pa.array([self.file]), pa.array([self.part]), pa.array([side], pa.int32()), pa.array([raw])], names=["file", "part", "side", "rest"])

    def end(self, more: bytes = b"") -> Iterator[pa.RecordBatch]:
        if self.torn:
            yield self.fragment(1 if self.synced else 2, self.lines, more)
        elif self.whole:
            yield from self.add(pa.array([more] if more else [], pa.binary()))
            if len(self.lines):
                raise ValueError(f"{self.file}: its lines aren't whole records of four")


def _parts(start: Callable[[str, int, bool, bool], Part], feed: Callable[[Part, pa.Array], Iterator[pa.RecordBatch]], end: Callable[[Part], Iterator[pa.RecordBatch]], torn: bool):
    """A function over batches (value, file, part, whole) that gives the rows of each part in turn to ``feed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Part | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, part = batch.column(1).dictionary_encode(), np.asarray(batch.column(2))
            code = np.asarray(file.indices)
            cuts = [0, *(np.flatnonzero((np.diff(code) != 0) | (np.diff(part) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key = file.dictionary[int(code[a])].as_py(), int(part[a])
                if now is None or (now.file, now.part) != key:
                    if now is not None:
                        yield from end(now)
                    now = start(*key, batch.column(3)[a].as_py(), torn)
                yield from feed(now, batch.column(0)[a:b])
        if now is not None:
            yield from end(now)

    return run


def _of_lines(lines: DataFrame, torn: bool) -> DataFrame:
    return lines.mapInArrow(_parts(Part, lambda part, values: part.add(values), lambda part: part.end(), torn), _TORN if torn else _RECORDS)


def _of_blocks(members: DataFrame, torn: bool) -> DataFrame:
    """Records or fragments of block-gzip members; a part may begin and end inside a line."""

    def start(file: str, part: int, whole: bool, torn: bool) -> Part:
        now = Part(file, part, whole, torn)
        now.open, now.since = b"", 1 if part else 0
        return now

    def feed(now: Part, values: pa.Array) -> Iterator[pa.RecordBatch]:
        texts = []
        for raw in values.to_pylist():
            if not now.part and raw[:4] == MEMBER and len(raw) == 10:
                continue  # what stands before a file's first length field
            texts.append(inflated(raw, now.file))
        *lines, now.open = (now.open + b"".join(texts)).replace(b"\r\n", b"\n").split(b"\n")
        yield from now.add(pa.array(lines, pa.binary()))

    return members.mapInArrow(_parts(start, feed, lambda now: now.end(now.open), torn), _TORN if torn else _RECORDS)


def _mended(torn: DataFrame) -> DataFrame:
    """The records that the borders of parts cut, from all fragments."""
    along = Window.partitionBy("file").orderBy("part", "side")
    # what is before a part's first record ends a gap, what is after its last one begins the next
    gap = F.count_if(F.col("side") == 1).over(along)
    pieces = torn.withColumn("gap", gap).groupBy("file", "gap").agg(F.sort_array(F.collect_list(F.struct("part", "side", "rest"))).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for file, xs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = b"".join(x["rest"] for x in xs).replace(b"\r\n", b"\n")
                lines = raw.removesuffix(b"\n").split(b"\n") if raw else []
                if len(lines) % 4:
                    raise ValueError(f"{file}: its lines aren't whole records of four")
                out[0] += [file] * (len(lines) // 4)
                for k in range(4):
                    out[k + 1] += lines[k::4]
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *(pa.array(c, pa.binary()).cast(pa.string()) for c in out[1:])], names=["file", "head", "seq", "plus", "qual"])

    return pieces.select("file", "x").mapInArrow(run, "file string, head string, seq string, plus string, qual string")


def _lines(spark: SparkSession, paths: str | list[str], blocks: str) -> tuple[DataFrame, DataFrame]:
    """The lines of files of text, and what stands between two length fields of block gzip, each with file, part and whether that is the whole file."""
    m = lambda c: F.col(f"_metadata.{c}")
    whole = (m("file_block_start") == 0) & (m("file_block_length") == m("file_size"))
    columns = [F.col("value").cast("binary").alias("value"), m("file_path").alias("file"), m("file_block_start").alias("part"), whole.alias("whole")]
    plain = spark.read.text(paths).filter(~m("file_path").rlike(blocks)).select(*columns)
    # between two length fields lies a member without its first bytes, and the first bytes of the next one
    return plain, spark.read.option("lineSep", LENGTH).text(paths).filter(m("file_path").rlike(blocks)).select(*columns)


def _fragments(plain: DataFrame, raw: DataFrame) -> DataFrame:
    cut = ~F.col("file").rlike(r"\.gz$") & ~F.col("whole")  # files called .gz are never cut and aren't opened again
    return _of_lines(plain.filter(cut), True).unionByName(_of_blocks(raw.filter(~F.col("whole")), True))


def read_fastq(spark: SparkSession, paths: str | list[str], name: str = NAME, blocks: str = BLOCKS) -> DataFrame:
    """sample, lane, mate, read_id, seq, qual of every record of FASTQ files: plain, gzip or block gzip.

    ``name`` finds sample, lane and mate in a file's path (no match: null). The read_id is the first word of the header
    without ``@`` and a closing /1 or /2. Plain files and those of block gzip (members of 64 KB at most that tell their
    length; known by their name, ``blocks``, since Spark hands files called .gz to one task as a stream) are read in as
    many tasks as they have parts; a gzip file is one task. Records are made in one pass; those at borders are found in a second one over
    the lines of all files not called .gz, which leaves Spark only for files that are cut. The driver sees none of it, and rows don't depend on how files are cut. A record needs four lines. Records cut off at the end of a file, and those whose
    header lacks ``@``, whose third line lacks ``+`` or whose sequence and qualities differ in length, raise an
    error, as a damaged member does. Empty files give no rows.
    """
    plain, raw = _lines(spark, paths, blocks)
    t = _of_lines(plain, False).unionByName(_of_blocks(raw, False)).unionByName(_mended(_fragments(plain, raw)))
    fine = F.startswith("head", F.lit("@")) & F.startswith("plus", F.lit("+")) & (F.length("seq") == F.length("qual"))
    t = t.withColumn("head", F.when(fine, F.col("head")).otherwise(F.raise_error(F.concat(F.lit("not a FASTQ record: "), "file", F.lit(" "), "head"))))
    part = lambda k: F.nullif(F.regexp_extract("file", name, k), F.lit(""))
    read = F.regexp_replace(F.substring_index(F.substr("head", F.lit(2)), " ", 1), "/[12]$", "")
    return t.select(part(1).alias("sample"), part(2).alias("lane"), part(3).cast("int").alias("mate"), read.alias("read_id"), "seq", "qual")


def block_gzip(text: bytes, size: int = 65_280, end: bool = True) -> bytes:
    """``text`` as members of block gzip of ``size`` bytes each, closed by an empty one; any gzip program reads it."""
    out = []
    for at in [*range(0, len(text), size), *([len(text)] if end else [])]:
        part = text[at : at + size]
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        data = z.compress(part) + z.flush()
        head = MEMBER + bytes([0, 0, 0, 0, 0, 255]) + LENGTH.encode() + (len(data) + AROUND - 1).to_bytes(2, "little")
        out.append(head + data + zlib.crc32(part).to_bytes(4, "little") + len(part).to_bytes(4, "little"))
    return b"".join(out)


def merge_lanes(reads: DataFrame) -> DataFrame:
    """The reads of all lanes of a sample and mate as one set: the lane goes; rows stay one for one, a read of two lanes twice."""
    return reads.drop("lane")
