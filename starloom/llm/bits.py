"""A bitmap of fixed size over 64-bit keys: says which rows need not be shuffled, never which ones match."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits of a bitmap, as a power of two: 32 MB on the driver and in each task, whatever the input. Beyond some hundred million keys
# it lets most keys through; those are then shuffled and matched like the rest, so results do not depend on it.
POWER = 28
_PART = 32768  # bits of one value of bitmap_construct_agg


def bitmap(keys: DataFrame, column: str, power: int = POWER) -> Broadcast:
    """Set the bit of every key (a long; null sets none) and send the bitmap to the tasks, for `held`."""
    place = F.col(column).bitwiseAND(F.lit((1 << power) - 1)) + 1
    places = keys.filter(F.col(column).isNotNull()).select(place.alias("place"))
    parts = places.groupBy(F.bitmap_bucket_number("place").alias("part"))
    bits = np.zeros((1 << power) // 8, dtype=np.uint8)
    for row in parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect():  # at most 2 ** power bits in all
        start = (row.part - 1) * _PART // 8
        bits[start : start + _PART // 8] = np.frombuffer(row.bits, dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)


def held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key (unsigned 64 bits) is set: always so for keys of the bitmap, seldom for others."""
    place = keys & np.uint64(8 * len(bits) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
