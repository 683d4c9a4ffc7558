"""A bitmap filter over 64-bit hashes: built by Spark, of bounded size, used
inside tasks to leave out rows that cannot match before they are shuffled.
It never decides a match: what passes is joined exactly."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bits: at least 2**16, at most 2**26 (8 MB sent to each executor); a larger
#: table only lets more rows pass.
LEAST_BITS, MOST_BITS, BITS_PER_HASH, PROBES = 16, 26, 32, 4


def probes(h: np.ndarray, bits: int) -> list[np.ndarray]:
    step = (h >> np.uint64(32)) | np.uint64(1)
    keep = np.uint64((1 << bits) - 1)
    return [(h + np.uint64(i) * step) & keep for i in range(PROBES)]


def build(hashes: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """Bitmap (64-bit words) of a long column; collects at most 2**20 words."""
    n = hashes.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (max(n, 1) * BITS_PER_HASH - 1).bit_length()))
    keep = (1 << bits) - 1
    h = F.col(column)
    step = F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1).cast("long"))
    low = h.bitwiseAND(F.lit(keep).cast("long"))
    at = F.array(*[(low + F.lit(i).cast("long") * step).bitwiseAND(F.lit(keep).cast("long")) for i in range(PROBES)])
    rows = (hashes.select(F.explode(at).alias("bit"))
            .groupBy(F.shiftright("bit", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toPandas())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64)
    return out.view(np.uint64), bits


def passes(bitmap: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    """Index of the hashes that may be in the table."""
    at = np.arange(len(h))
    for i in range(PROBES):
        step = (h[at] >> np.uint64(32)) | np.uint64(1)
        bit = (h[at] + np.uint64(i) * step) & np.uint64((1 << bits) - 1)
        at = at[(bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1]
    return at
