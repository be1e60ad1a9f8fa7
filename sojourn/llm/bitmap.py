"""Bitmaps of hashes: small enough to send to every task whatever the number of hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A bitmap never has more bits than this (16 MB); with more hashes it only drops fewer candidates.
MAX_BITS = 1 << 27
MIN_BITS = 1 << 20


def bitmap_bits(wanted: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, 1 << wanted.bit_length()))


class Bitmap:
    """A set of hashes without false negatives."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.shift = np.uint64(64 - int(len(bits) * 8).bit_length() + 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> self.shift
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap(hashes: DataFrame, bits: int) -> Bitmap:
    """``hashes`` has one long column ``h``; pages of 64 bits are or-ed in the cluster, so what reaches
    the driver is at most ``bits / 64`` rows."""
    shift = 64 - (bits.bit_length() - 1)
    at = F.shiftrightunsigned("h", shift)
    pages = (hashes.select(F.shiftrightunsigned(at, 6).alias("page"), at.bitwiseAND(63).cast("int").alias("bit"))
             .groupBy("page").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("word")))
    table = np.zeros(bits // 64, np.int64)
    for batch in pages.toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return Bitmap(table.view(np.uint8))
