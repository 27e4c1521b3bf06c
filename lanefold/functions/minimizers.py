"""k-mers of many sequences at once, as numpy arrays of whole numbers of two bits a letter, and their minimizer buckets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: A, C, G and T as digits; anything else parts a sequence.
DIGITS = np.full(256, 4, np.uint8)
DIGITS[[65, 67, 71, 84]] = 0, 1, 2, 3
#: Windows of a run, so that their number is a byte; windows of a bucket from which counting it at once may pay.
RUN, MANY = 255, 1024


def packed(digits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of each window of ``k`` digits and that of its reverse complement, by doubling the span of blocks."""
    n = len(digits) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    block, mirror, span = digits.astype(np.uint64), (3 - digits).astype(np.uint64), 1
    out, back, done = np.zeros(n, np.uint64), np.zeros(n, np.uint64), 0
    while True:
        if k & span:
            out = out << np.uint64(2 * span) | block[done : done + n]
            back |= mirror[done : done + n] << np.uint64(2 * done)
            done += span
        if 2 * span > k:
            return out, back
        block, mirror = block[:-span] << np.uint64(2 * span) | block[span:], mirror[:-span] | mirror[span:] << np.uint64(2 * span)
        span *= 2


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes of whole numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def minimizer_length(k: int) -> int:
    return min(k, max(1, k // 2 + 1))


def buckets_of(digits: np.ndarray, k: int, buckets: int) -> np.ndarray:
    """The bucket of each window: that of its minimizer, the part of it or of its reverse complement with the smallest hash."""
    m = minimizer_length(k)
    least = sliding_min(mixed(np.minimum(*packed(digits, m))), k - m + 1)
    return (mixed(least) % np.uint64(buckets)).astype(np.int64)


@dataclass
class Packed:
    """Runs of windows by key (sample and bucket): the number of windows of each run as a byte and its letters, four a byte; a run's letters fill whole bytes, so packed runs of a key can be joined."""

    keys: np.ndarray
    runs: np.ndarray  # runs of each key
    sizes: np.ndarray
    bytes: np.ndarray  # bytes of the letters of each key
    letters: np.ndarray


def cut(digits: np.ndarray, owner: np.ndarray, k: int, buckets: int) -> tuple[Packed, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The windows of ``digits`` as runs of one bucket, and (key, k-mer, count) of the buckets where counts are shorter than runs.

    ``owner`` is the number of the sample of each letter; key is owner * buckets + bucket. A digit above 3 is in no window.
    """
    none = np.empty(0, np.int64)
    empty = Packed(none, none, np.empty(0, np.uint8), none, np.empty(0, np.uint8)), (none, np.empty(0, np.uint64), none)
    bad = np.concatenate([[0], np.cumsum(digits > 3)])
    if len(digits) < k:
        return empty
    clean = np.minimum(digits, 3)
    at = np.flatnonzero(bad[k:] == bad[: len(digits) - k + 1])
    if not len(at):
        return empty
    key = owner[at] * buckets + buckets_of(clean, k, buckets)[at]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(key) != 0)]))
    size = np.diff(np.append(first, len(at)))
    pieces = -(-size // RUN)  # long runs go in pieces
    piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + piece * RUN
    size = np.minimum(RUN, np.repeat(size, pieces) - piece * RUN)
    start, key = at[first], key[first]
    order = np.argsort(key, kind="stable")
    start, size, key = start[order], size[order], key[order]
    head = np.flatnonzero(np.concatenate([[True], np.diff(key) != 0]))
    windows = np.add.reduceat(size, head)
    runs = np.diff(np.append(head, len(key)))
    counted = none, np.empty(0, np.uint64), none
    many = windows >= MANY
    if many.any():
        chosen = np.repeat(many, runs)
        w = size[chosen]
        place = np.arange(w.sum()) + np.repeat(start[chosen] - (np.cumsum(w) - w), w)
        part = np.minimum(*packed(clean, k))[place]
        which = np.repeat(key[chosen], w)
        by = np.lexsort((part, which))
        part, which = part[by], which[by]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(which) != 0) | (part[1:] != part[:-1])]))
        counts = np.diff(np.append(new, len(part)))
        mine = np.searchsorted(key[head], which[new])
        short = np.bincount(mine, minlength=len(head)) * 16 < np.add.reduceat(size + k - 1, head) // 4 + runs
        told = short[mine] & many[mine]
        counted = which[new][told], part[new][told], counts[told]
        kept = ~np.repeat(short & many, runs)
        start, size, key = start[kept], size[kept], key[kept]
        if not len(key):
            return empty[0], counted
        head = np.flatnonzero(np.concatenate([[True], np.diff(key) != 0]))
        runs = np.diff(np.append(head, len(key)))
    long = size + k - 1
    padded = -(-long // 4) * 4
    source = np.arange(long.sum()) + np.repeat(start - (np.cumsum(long) - long), long)
    target = np.arange(long.sum()) + np.repeat(np.cumsum(padded) - padded - (np.cumsum(long) - long), long)
    out = np.zeros(padded.sum(), np.uint8)
    out[target] = clean[source]
    out = out.reshape(-1, 4)
    letters = out[:, 0] << 6 | out[:, 1] << 4 | out[:, 2] << 2 | out[:, 3]
    return Packed(key[head], runs, size.astype(np.uint8), np.add.reduceat(padded, head) // 4, letters), counted


def windows_of(sizes: list[bytes], letters: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The canonical k-mers of packed runs, and how many each row gave."""
    runs = np.array([len(x) for x in sizes], np.int64)
    size = np.frombuffer(b"".join(sizes), np.uint8).astype(np.int64)
    flat = np.frombuffer(b"".join(letters), np.uint8)
    digits = np.stack([flat >> 6, flat >> 4 & 3, flat >> 2 & 3, flat & 3], 1).ravel()
    long = size + k - 1
    padded = -(-long // 4) * 4
    row = np.repeat(np.arange(len(runs)), runs)
    place = np.arange(size.sum()) + np.repeat(np.cumsum(padded) - padded - (np.cumsum(size) - size), size)
    return np.minimum(*packed(digits, k))[place] if len(place) else np.empty(0, np.uint64), np.bincount(row, size, len(runs)).astype(np.int64)


def summed(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order and the sums of their counts."""
    if not len(numbers):
        return numbers, counts
    order = np.argsort(numbers)
    numbers, counts = numbers[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
    return numbers[new], np.add.reduceat(counts, new)
