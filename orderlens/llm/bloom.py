"""A Bloom filter of fixed size over 64-bit values that are hashes themselves."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.store import written

FILTER_BITS, SPOTS = 27, (0, 12, 24, 37)


def filter_bits(values: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of 64-bit values, 16 MB whatever their number; foreign values that pass only cost work."""
    spots = [F.shiftrightunsigned(column, k).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) for k in SPOTS]
    words = (
        values.select(F.explode(F.array(*spots)).alias("s"))
        .groupBy(F.shiftrightunsigned("s", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits"))
    )
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    # Written first: the plan behind a table that is collected keeps its shuffle files.
    for batch in written(words, "bloom").toArrow().to_batches():  # at most 2 million rows of 16 bytes
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy().view(np.uint64)
    return out


def passes(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    ok = np.ones(len(values), bool)
    for k in SPOTS:
        spot = (values >> np.uint64(k)) & np.uint64((1 << FILTER_BITS) - 1)
        ok &= (bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
    return ok
