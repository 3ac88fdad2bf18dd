"""A filter of fixed size over hashes: what it lets through still has to meet in an exact join."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 4 MB, whatever the corpus.
BITS = 1 << 25


def bit_filter(df: DataFrame, column: str) -> bytes:
    """One bit for each value of a string or bigint column, at its hash."""
    h = F.col(column) if dict(df.dtypes)[column] == "bigint" else F.xxhash64(column)
    place = F.pmod(h, F.lit(BITS)) + 1  # Spark counts bits from 1
    parts = df.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = bytearray(BITS // 8)
    for r in parts.where("part IS NOT NULL").toLocalIterator():
        at = (r["part"] - 1) * len(r["bits"])
        out[at : at + len(r["bits"])] = r["bits"]
    return bytes(out)


def bit_of(hashes: np.ndarray) -> np.ndarray:
    """The places of bigint values."""
    return hashes & (BITS - 1)


def bit_of_word(word: str) -> int:
    """The place of a string, hashed as Spark does; the number of bits is a power of two, so the sign doesn't matter."""
    return xxhash.xxh64_intdigest(word.encode(), 42) & (BITS - 1)
