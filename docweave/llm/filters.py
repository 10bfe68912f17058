"""A bounded filter over 64-bit keys, to be broadcast: it lets all given keys through, and some others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the filter, whatever the number of keys; the fuller it is, the more others pass.
FILTER_BITS = 1 << 26


def bitmap(keys: DataFrame) -> np.ndarray:
    """The filter for the column ``key``, as bytes: built by Spark, FILTER_BITS / 8 bytes reach the driver."""
    bit = F.pmod("key", F.lit(FILTER_BITS)) + 1
    parts = (
        keys.select(F.bitmap_bucket_number(bit).alias("part"), F.bitmap_bit_position(bit).alias("bit"))
        .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for part in parts:
        at = (part["part"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(part["bits"], np.uint8)
    return out


def let_through(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of these signed keys pass."""
    bit = keys % FILTER_BITS
    return (bits[bit >> 3] >> (bit & 7) & 1).astype(bool)
