"""Sums of long count vectors that tasks hold in parts.

A task emits each part of its vector once (two bytes a count, four where one is larger); parts are added on the executors in two levels, so
no group grows with the number of tasks beyond its share, and the driver gets one vector of a fixed length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.store import written

PART = 1 << 16
_SCHEMA = pa.schema([("part", pa.int32()), ("salt", pa.int32()), ("counts", pa.binary())])


def parts(vector: np.ndarray) -> Iterator[dict]:
    """Non-zero parts of a vector of counts below 2^32."""
    for i in range(0, len(vector), PART):
        some = vector[i : i + PART]
        if some.any():
            padded = np.zeros(PART, "<u2" if some.max() < 1 << 16 else "<u4")
            padded[: len(some)] = some
            yield {"part": i // PART, "counts": zlib.compress(padded.tobytes(), 1)}


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, key = np.zeros(PART, np.uint64), {}
    for batch in batches:
        for row in batch.to_pylist():
            key, raw = row, zlib.decompress(row["counts"])
            total += np.frombuffer(raw, f"<u{len(raw) // PART}").astype(np.uint64)
    if key:
        yield pa.RecordBatch.from_pylist([key | {"counts": zlib.compress(total.astype("<u8").tobytes(), 1)}], schema=_SCHEMA)


def total(rows: DataFrame, length: int, form=None, kind=np.uint64) -> np.ndarray:
    """The sum of all vectors; rows: part, counts. ``form`` is applied to each part of the sum."""
    schema, salt = "part int, salt int, counts binary", F.pmod(F.xxhash64("counts"), F.lit(64)).cast("int")
    salted = rows.select("part", salt.alias("salt"), "counts")
    summed = salted.groupBy("part", "salt").applyInArrow(_add, schema).groupBy("part").applyInArrow(_add, schema)
    out = np.zeros(-(-length // PART) * PART, kind)
    for row in written(summed, "vectors").collect():  # length / 65,536 rows
        part = np.frombuffer(zlib.decompress(bytes(row["counts"])), "<u8")
        out[row["part"] * PART : (row["part"] + 1) * PART] = form(part) if form else part
    return out[:length]
