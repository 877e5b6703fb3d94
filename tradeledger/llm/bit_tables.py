"""Sets of 64-bit ids as bit tables of bounded size, for tasks to look ids up without a shuffle.

A table may say yes to an id that isn't in the set, never no to one that is. So it saves work,
and where it fills up more rows take the longer way with the same result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS = 1 << 20
MOST_BITS = 1 << 27


def wanted_bits(n: int, least: int = LEAST_BITS, most: int = MOST_BITS) -> int:
    """Eight bits an id or more, as a power of two between the bounds (128 KB and 16 MB)."""
    return min(most, max(least, 1 << (8 * n).bit_length()))


def bit_table(ids: DataFrame, bits: int) -> np.ndarray:
    """64-bit words with the bits of the column ``id`` set; ids are well mixed numbers."""
    words = bits // 64
    shift = words.bit_length() - 1
    rows = ids.groupBy(F.col("id").bitwiseAND(words - 1).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(id, {shift}) & 63 as int))")).alias("bits")
    )
    found = rows.toArrow()
    table = np.zeros(words, np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def contains(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each id whether its bit is set."""
    ids = ids.view(np.uint64)
    shift = np.uint64(len(table).bit_length() - 1)
    word = table[(ids & np.uint64(len(table) - 1)).astype(np.int64)]
    return ((word >> ((ids >> shift) & np.uint64(63))) & np.uint64(1)).astype(bool)


def filled(table: np.ndarray) -> float:
    """The share of bits that are set."""
    return float(np.bitwise_count(table).sum()) / (64 * len(table))
