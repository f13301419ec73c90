"""Terms of texts as hashes: runs of allowed bytes, after A-Z became a-z. All other characters are left as they are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from orderlens.llm.words import span_hashes, text_bytes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Bytes of the given ranges, ends included; as a table of 256 flags."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Letters: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]`` after lower-casing. Bytes from 0x80 belong to longer characters.
LETTERS = byte_class((0x61, 0x7A), (0x80, 0xFF))
#: Letters and digits: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


class Terms:
    """All terms of a string column: bytes, spans, hashes, and the place of each text's first term (n + 1 places)."""

    def __init__(self, column: pa.Array, allowed: np.ndarray):
        raw, starts = text_bytes(column)
        self.data = _LOWER[raw]
        inside = np.zeros(len(self.data) + 2, np.int8)
        inside[1:-1] = allowed[self.data]
        edges = np.flatnonzero(np.diff(inside))
        self.begin, self.end = edges[0::2], edges[1::2]
        self.hashes = span_hashes(self.data, self.begin, self.end)
        self.first = np.searchsorted(self.begin, starts)

    def strings(self, which: np.ndarray) -> pa.Array:
        """The chosen terms as text."""
        begin, sizes = self.begin[which], (self.end - self.begin)[which]
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        take = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], sizes)
        data = self.data[take].tobytes()
        return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))


def expand(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs [first, first + size): the number of the run and the place, of every member."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    return owner, np.arange(len(owner)) + np.repeat(first - before, sizes)
