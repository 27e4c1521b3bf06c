"""Column expressions over DNA and quality strings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters that are scored at once.
LETTERS = 1 << 20


def _counted(text: Column, wanted: np.ndarray) -> Column:
    """How many bytes of each text ``wanted`` marks, for many texts at once."""

    def count(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        out, some = np.zeros(len(texts), np.int32), np.flatnonzero(np.diff(ends))
        if len(some):
            hits = wanted[np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]]
            out[some] = np.add.reduceat(hits, ends[some] - ends[0], dtype=np.int32)
        return pa.array(out, mask=np.asarray(texts.is_null()))

    return F.arrow_udf(count, "int")(text)


def count_of(seq: Column, letters: str) -> Column:
    """How many characters of ``seq`` are in ``letters``, which are ASCII."""
    wanted = np.zeros(256, np.uint8)
    wanted[list(letters.encode("ascii"))] = 1
    return _counted(seq, wanted)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTN", "TGCAN"))


def kmer_text(packed: Column, k: int) -> Column:
    """The letters of a packed k-mer, written for many at once."""

    def letters(numbers: pa.Array) -> pa.Array:
        known = numbers.drop_null()
        shifts = np.arange(2 * (k - 1), -1, -2, dtype=np.uint64)
        text = np.frombuffer(b"ACGT", np.uint8)[(known.to_numpy().view(np.uint64)[:, None] >> shifts & np.uint64(3)).astype(np.uint8)]
        ends = np.concatenate([[0], np.cumsum(np.asarray(numbers.is_valid()) * k)]).astype(np.int32)
        mask = None if not numbers.null_count else pa.array(np.asarray(numbers.is_valid())).buffers()[1]
        return pa.Array.from_buffers(pa.string(), len(numbers), [mask, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(text))])

    return F.arrow_udf(letters, "string")(packed.cast("long"))


def kmers(seq: Column, k: int) -> Column:
    """Array of canonical k-mers: the smaller of each window and its reverse complement; windows with other letters are left out."""
    windows = F.when(F.length(seq) >= k, F.transform(F.sequence(F.lit(1), F.length(seq) - k + 1), lambda i: F.substr(seq, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    plain = F.filter(windows, lambda w: ~w.rlike("[^ACGT]"))
    return F.transform(plain, lambda w: F.least(w, reverse_complement(w)))


def quality_at_least(qual: Column, q: int) -> Column:
    """How many phred+33 qualities are ``q`` or more: all characters but the printable ones below."""
    wanted = np.ones(256, np.uint8)
    wanted[33 : 33 + q] = wanted[0x80:0xC0] = 0  # a character beyond ASCII is counted by its first byte
    return _counted(qual, wanted)


def cut_tail_length(qual: Column, window: int, q: int) -> Column:
    """What remains of a read after dropping bases from the 3' end while the mean quality of the last ``window`` is below ``q``.

    Reads are scored together, some at a time, by one running sum.
    """

    def kept(quals: pa.Array) -> pa.Array:
        out, held, size = [], [], 0
        for text in quals.to_pylist():
            held.append(text or "")
            size += len(held[-1])
            if size >= LETTERS:
                out.append(_tails(held, window, q))
                held, size = [], 0
        out.append(_tails(held, window, q))
        return pa.array(np.concatenate(out), pa.int32(), mask=np.asarray(quals.is_null()))

    return F.arrow_udf(kept, "int")(qual)


def _tails(quals: list[str], window: int, q: int) -> np.ndarray:
    size = np.array([len(x) for x in quals], np.int64)
    last = np.cumsum(size)
    run = np.concatenate([[0], np.cumsum(np.frombuffer("".join(quals).encode("utf-32-le"), "<u4").astype(np.int64) - 33)])
    good = np.flatnonzero(run[window:] - run[:-window] >= q * window) + window  # where good windows end, those across two reads included
    at = np.searchsorted(good, last, "right") - 1
    inside = np.where(at >= 0, good[at] if len(good) else 0, 0) - (last - size)
    return np.where(size < window, size, np.where(inside >= window, inside, 0)).astype(np.int32)
