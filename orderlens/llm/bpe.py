"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that the encoding of that prefix ends with. It is
the one candidate, among tokens that end there, that may stand after the last token of the prefix before it; two
tokens may stand together when encoding their joined bytes gives the two again. Storing that token for each
prefix gives the encoding of every prefix by walking back. Appending bytes only adds entries, and after an edit
only the entries from the edit on are computed, up to where they meet the old ones again.

A text is first cut by the vocabulary's pattern; each match is a byte string of its own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.store import get, prepare
from orderlens.llm.vocab import Pieces
from orderlens.llm.words import slices

PAIRS = 250_000
_WORKERS: dict[tuple[str, str], BpePieces] = {}


class Prefixes:
    """The last token of every prefix of a byte string."""

    def __init__(self, bpe: Bpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, data, []
        bpe.extend(data, self.last, 0)

    def tokens(self, end: int | None = None) -> list[int]:
        """Encoding of the first ``end`` bytes."""
        return self.bpe.walk(self.last, len(self.data) if end is None else end)

    def append(self, data: bytes) -> None:
        self.data += data
        self.bpe.extend(self.data, self.last, len(self.last))

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Exchange bytes [start, end); entries after the edit are kept once enough of them in a row are equal."""
        old, after = self.last, self.data[end:]
        self.data = self.data[:start] + new + after
        self.last = old[:start]
        self.bpe.extend(self.data, self.last, start, old[end:], start + len(new))


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.bytes = ranks, {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.made: dict[int, tuple[int, int] | None] = {}

    @staticmethod
    def load(path: str, pattern: str) -> Bpe:
        data = get(path) if "://" in path else open(path, "rb").read()
        return Bpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}, pattern)

    def merged(self, data: bytes, below: int | None = None) -> list[int]:
        """The encoding by definition: join the pair of lowest rank until none (below a rank) is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best) and (below is None or rank < below):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a single byte."""
        if token not in self.made:
            data = self.bytes[token]
            parts = self.merged(data, token) if len(data) > 1 else ()
            self.made[token] = tuple(parts) if len(parts) == 2 else None
        return self.made[token]

    def fits(self, a: int, b: int) -> bool:
        """Whether token b may follow token a.

        Merges are taken back one at a time, the latest first, on either side of the seam. A merge across the
        seam of rank below everything taken back so far would have come first, so the two could not stand.
        """
        found = self.pairs.get((a, b))
        if found is not None:
            return found
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        left, right, limit, found = a, b, None, True
        while True:
            across = self.ranks.get(self.bytes[left] + self.bytes[right])
            if across is not None and (limit is None or across < limit):
                found = False
                break
            l, r = self.halves(left), self.halves(right)
            if l is None and r is None:
                break
            # Of equal tokens the left one is merged first, so the right one is taken back first and a merge
            # across of the same rank would have come before it.
            if r is None or (l is not None and left > right):
                limit, left = left, l[1]
            else:
                limit, right = right + 1, r[0]
        self.pairs[a, b] = found
        return found

    def extend(self, data: bytes, last: list[int], start: int, old: list[int] | None = None, base: int = 0) -> None:
        """Fill ``last`` for the prefixes that end after ``start``.

        old: the entries that a former string had from the place that is now ``base``. An entry depends on at
        most ``longest`` bytes and entries before it, so after as many equal ones the rest is equal too.
        """
        ranks, fits, equal = self.ranks, self.fits, 0
        for end in range(start + 1, len(data) + 1):
            for begin in range(max(0, end - self.longest), end):
                token = ranks.get(data[begin:end])
                if token is not None and (not begin or fits(last[begin - 1], token)):
                    last.append(token)
                    break
            if old is not None and end > base:
                equal = equal + 1 if old[end - 1 - base] == last[-1] else 0
                if equal >= self.longest:
                    last.extend(old[end - base :])
                    return

    def walk(self, last: list[int], end: int) -> list[int]:
        out = []
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes[out[-1]])
        return out[::-1]

    def match(self, text: str) -> list[int]:
        """Encoding of one match of the pattern."""
        data = text.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(data, last, 0)
        return self.walk(last, len(data))

    def encode(self, text: str) -> list[int]:
        """Ids of a text: each match of the pattern by itself."""
        out: list[int] = []
        for m in self.pattern.findall(text):
            out += self.match(m)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class BpePieces(Pieces):
    """Pieces between spaces, where the pattern cuts in any case; short ones are remembered."""

    limit = 800_000

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe = bpe

    def alone(self, text: str) -> bytes:
        return np.array(self.bpe.encode(text), "<u4").tobytes()


def worker(path: str, pattern: str) -> BpePieces:
    if (path, pattern) not in _WORKERS:
        _WORKERS[path, pattern] = BpePieces(Bpe.load(path, pattern))
    return _WORKERS[path, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and ids (array<int>). Null text counts as empty; each row is encoded by itself, so nulls and repeats
    in doc_id do not matter; further columns are ignored."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = worker(ranks, pattern)
        for whole in batches:
            for batch in slices(whole, "text"):
                found = tool.encode(batch.column("text").to_pylist())
                offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found])))
                flat = np.frombuffer(b"".join(found), "<i4")
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], schema=schema)

    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, ids and the bytes they stand for; null ids give empty bytes."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker(ranks, pattern).bpe
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                decoded = pa.array([bpe.decode(x.tolist()) for x in _lists(batch.column("ids"))], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids").cast(schema.field("ids").type), decoded], schema=schema)

    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, decoded binary")


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield flat[a:b]
