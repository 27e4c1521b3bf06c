"""Bitmaps of 64-bit hashes, of a bounded size: what they hold passes, and some of the rest."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Bitmap:
    """Hashes that may be frequent."""

    def __init__(self, bits: int, buckets: dict[int, bytes]):
        self.bits = bits
        self.bytes = np.zeros(1 << (bits - 3), np.uint8)
        for k, raw in buckets.items():
            self.bytes[k * 4096 : (k + 1) * 4096] = np.frombuffer(raw, np.uint8)

    def __contains__(self, h: int) -> bool:
        h &= (1 << self.bits) - 1
        return bool(self.bytes[h >> 3] >> (h & 7) & 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = (h & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        return (self.bytes[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bitmap(hashes: DataFrame, h: str = "h", most: int = 27) -> Bitmap:
    """The bits of all ``hashes``: 64 for each, 2^15 at least and 2^``most`` at most. The driver gets a row of 4 KB for 2^15 bits."""
    bits = min(most, max(15, (hashes.count() * 64).bit_length()))
    # Spark's buckets begin at 1 with position 0, those of a value of 0 or more
    bit = F.col(h).bitwiseAND(F.lit((1 << bits) - 1)) + 1
    rows = hashes.select(F.bitmap_bucket_number(bit).alias("k"), F.bitmap_bit_position(bit).alias("p")).groupBy("k").agg(F.bitmap_construct_agg("p").alias("raw")).collect()
    return Bitmap(bits, {r["k"] - 1: bytes(r["raw"]) for r in rows})
