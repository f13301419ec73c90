"""Words and hashes of many texts at once, on byte arrays.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, after A-Z became a-z. Texts are joined with a
separator between them, so one pass handles a whole Arrow batch. A hash is a sum of per-byte random values
times powers of an odd number, modulo 2**64: prefix sums give the hash of every span in constant time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MULT = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULT, -1, 1 << 64)
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BLOCK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a fixed bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(n: int, base: int = _MULT) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, built from two short tables."""
    low = np.full(_BLOCK, base, np.uint64)
    low[0] = 1
    low = np.cumprod(low, dtype=np.uint64)
    step = pow(base, _BLOCK, 1 << 64)
    rows = -(-max(n, 1) // _BLOCK)
    high = np.full(rows, step, np.uint64)
    high[0] = 1
    high = np.cumprod(high, dtype=np.uint64)
    return (high[:, None] * low[None, :]).reshape(-1)[:n]


def text_bytes(column: pa.Array, pad: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, ``pad`` separators after each text, and where each text starts (n + 1 places)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2] if n else None
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    flat = flat[offsets[0] : offsets[-1]]
    starts = offsets - offsets[0]
    out = np.insert(flat, np.repeat(starts[1:], pad), 10) if n else flat
    return out, starts + pad * np.arange(n + 1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span [start, end) of the bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.take(_TABLE, data, out=sums[1:])
        sums[1:] *= powers(len(data))
        np.cumsum(sums, out=sums)
        found = (sums[ends] - sums[starts]) * powers(len(data), _INVERSE)[starts]
        return mix(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data], [True])).view(np.int8)))
    return edges[0::2], edges[1::2]


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and the place of each text's first word (n + 1 places)."""
    data, starts = text_bytes(column)
    data = _LOWER[data]
    begin, end = word_spans(data)
    return span_hashes(data, begin, end), np.searchsorted(begin, starts)


def slices(batch: pa.RecordBatch, column: str, size: int = 3 << 20):
    """Cut a batch into runs of rows with about ``size`` bytes of text; one longer text stands alone."""
    lengths = batch.column(column)
    n = batch.num_rows
    if not n:
        return
    import pyarrow.compute as pc

    total = np.cumsum(pc.fill_null(pc.binary_length(lengths), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < n:
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
