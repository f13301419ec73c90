"""A positional inverted index of training text and the search of test texts in it.

**Index.** Documents are dealt into segments of about a million terms; a segment keeps, for each of its terms, the
sorted list of places where it occurs. Places count through the documents of a segment with one free place after
each, so a phrase never runs from one document into the next. The index is a Parquet table with one row per
segment, written by the tasks that read the text: building it moves no text between machines, and a lost executor
costs the segments of its tasks. It can be searched any number of times.

**Search.** Test texts become windows of ``size`` consecutive terms (a shorter text, but not an empty one, is one
window). Windows are grouped in blocks in the shared folder, copies of a text next to each other, and each window
is looked for once per block. In each segment a window starts from its rarest term there: the list of that term,
moved back by the term's offset, is intersected with the lists of the others from rare to common. What is left
are exact phrases. Proximity matches come from the same lists: all different terms of a window within ``width``
consecutive terms of a document, in any order. Blocks, and windows within a block, are taken in turn, so a task
holds one segment and one block. Nothing but the addresses of the blocks reaches the driver.

**Terms** are 64-bit hashes of runs of letters, digits and characters beyond ASCII, A-Z in lower case. Two terms
that share a hash count as one; among a billion terms and a million test terms that is expected once in twenty
thousand corpora, and a window needs all its terms at their places.

**Odd input.** Null texts have no terms: such documents are never hit, such items never occur. Every row counts as
a document of its own, whether its id is repeated or null. Rows of ``items`` that share an id are one item; a null
id is written as an empty string. An empty table of documents gives no rows, an empty one of items gives every
document without a hit. Very long texts are searched whole; a text beyond a segment's size is a segment alone. Only the
named columns are read, so further columns of any name do no harm and are not returned.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.store import fresh, get, prepare, put, written
from orderlens.llm.terms import ALPHANUMERIC, Terms, expand
from orderlens.llm.words import slices

SEGMENT_TERMS = 1 << 20
BLOCK_WINDOWS = 1 << 15
CANDIDATES = 1 << 20
_SEGMENT = "n_docs int, ids binary, known binary, sizes binary, terms binary, counts binary, gaps binary"
_MATCHES = (
    "doc_id bigint, n_words bigint, n_hit bigint, spans array<struct<start:bigint,length:bigint>>, "
    "items array<string>, near_items array<string>"
)


# ---- index --------------------------------------------------------------------------------------------------


def _segment_row(hashes: np.ndarray, sizes: np.ndarray, ids: pa.Array) -> dict:
    """The lists of one segment. ``hashes``: its terms in order; ``sizes``: terms per document."""
    places = np.arange(len(hashes), dtype=np.uint64) + np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, bool)
    term = np.cumsum(new).astype(np.uint64) - np.uint64(1)
    keys = np.sort((term << np.uint64(32)) | places[order])
    place = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    gaps = np.diff(place, prepend=0)
    starts = np.flatnonzero(new)
    gaps[starts] = place[starts]
    return {
        "n_docs": len(sizes),
        "ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
        "known": np.packbits(ids.is_valid().to_numpy(zero_copy_only=False)).tobytes(),
        "sizes": sizes.astype("<u4").tobytes(),
        "terms": ordered[starts].astype("<u8").tobytes(),
        "counts": np.diff(starts, append=len(ordered)).astype("<u4").tobytes(),
        "gaps": gaps.astype("<u4").tobytes(),
    }


def _indexed(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    hashes: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    ids: list[pa.Array] = []
    held = docs = 0

    def flush() -> pa.RecordBatch:
        row = _segment_row(np.concatenate(hashes), np.concatenate(sizes), pa.concat_arrays(ids))
        return pa.RecordBatch.from_pylist([row], schema=_SEGMENT_ARROW)

    for whole in batches:
        for batch in slices(whole, "text"):
            terms = Terms(batch.column("text"), ALPHANUMERIC)
            hashes.append(terms.hashes)
            sizes.append(np.diff(terms.first))
            ids.append(batch.column("doc_id"))
            held, docs = held + len(terms.hashes), docs + batch.num_rows
            if held >= limit or docs >= limit:
                yield flush()
                hashes, sizes, ids, held, docs = [], [], [], 0, 0
    if ids:
        yield flush()


_SEGMENT_ARROW = pa.schema(
    [("n_docs", pa.int32())]
    + [(c, pa.binary()) for c in ("ids", "known", "sizes", "terms", "counts", "gaps")]
)


def build(docs: DataFrame, limit: int = SEGMENT_TERMS) -> DataFrame:
    """The index of ``docs`` (doc_id, text): one row per segment of about ``limit`` terms."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(lambda batches: _indexed(batches, limit), _SEGMENT), "postings")


class Segment:
    """One segment opened for search. ``keys`` holds term number and place of every posting, ascending."""

    def __init__(self, row: dict):
        self.ids = pa.array(
            np.frombuffer(row["ids"], "<i8"),
            mask=np.unpackbits(np.frombuffer(row["known"], np.uint8), count=row["n_docs"]) == 0,
        )
        self.sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes + 1)))
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        sums = np.cumsum(np.frombuffer(row["gaps"], "<u4").astype(np.int64))
        before = np.where(self.first > 0, sums[self.first - 1], 0) if len(sums) else sums
        self.places = sums - np.repeat(before, self.counts)
        self.keys = (np.repeat(np.arange(len(self.counts)), self.counts) << 32) | self.places

    def at_or_after(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The first place of the term that is not before ``place``; a huge number where there is none."""
        found = np.searchsorted(self.keys, (term << 32) | np.maximum(place, 0))
        found_keys = self.keys[np.minimum(found, len(self.keys) - 1)]
        there = (found < len(self.keys)) & (found_keys >> 32 == term)
        return np.where(there, found_keys & 0xFFFFFFFF, 1 << 40)

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, side="right") - 1


# ---- test texts ---------------------------------------------------------------------------------------------


@dataclass
class Block:
    """Different windows (terms padded with zeros, lengths) and the groups of items that hold each of them."""

    terms: np.ndarray
    lengths: np.ndarray
    holder_first: np.ndarray
    holders: np.ndarray
    items: list[list[str]]

    @staticmethod
    def of(texts: list[np.ndarray], items: list[list[str]], size: int) -> Block:
        """``texts``: the hashed terms of each group of items with equal text."""
        rows, lengths, owners = [], [], []
        for number, own in enumerate(texts):
            span = min(size, len(own))
            windows = np.lib.stride_tricks.sliding_window_view(own, span)
            rows.append(np.pad(windows, ((0, 0), (0, size - span))))
            lengths.append(np.full(len(windows), span))
            owners.append(np.full(len(windows), number))
        terms, length, owner = np.concatenate(rows), np.concatenate(lengths), np.concatenate(owners)
        tagged = np.column_stack((terms, length.astype(np.uint64)))
        different, inverse = np.unique(tagged, axis=0, return_inverse=True)
        pairs = np.unique((inverse.reshape(-1).astype(np.int64) << 32) | owner)
        first = np.searchsorted(pairs >> 32, np.arange(len(different) + 1))
        return Block(different[:, :size], different[:, size].astype(np.int64), first, pairs & 0xFFFFFFFF, items)

    def pack(self) -> bytes:
        out = io.BytesIO()
        sizes = np.array([len(x) for x in self.items])
        names = pa.array([i for x in self.items for i in x], pa.string())
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("i", pa.string())])) as stream:
            stream.write_batch(pa.record_batch([names], names=["i"]))
        np.savez(
            out, terms=self.terms, lengths=self.lengths, first=self.holder_first, holders=self.holders, sizes=sizes,
            names=np.frombuffer(sink.getvalue(), np.uint8),
        )
        return out.getvalue()

    @staticmethod
    def unpack(raw: bytes) -> Block:
        x = np.load(io.BytesIO(raw))
        names = pa.ipc.open_stream(x["names"].tobytes()).read_all().column(0).to_pylist()
        ends = np.cumsum(x["sizes"])
        items = [names[e - n : e] for e, n in zip(ends, x["sizes"], strict=True)]
        return Block(x["terms"], x["lengths"], x["first"], x["holders"], items)


def windows(items: DataFrame, size: int, limit: int = BLOCK_WINDOWS) -> list[str]:
    """Blocks of the windows of ``items`` (item_id, text) in the shared folder; their addresses.

    The driver gets one address per ``limit`` windows. Equal texts are read one after another and are one group.
    """
    spark = items.sparkSession
    prepare(spark)
    folder = fresh(spark, "windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[np.ndarray] = []
        groups: list[list[str]] = []
        held, last = 0, None

        def flush() -> pa.RecordBatch:
            address = put(folder, "block", Block.of(texts, groups, size).pack())
            return pa.RecordBatch.from_pylist([{"address": address}], schema=pa.schema([("address", pa.string())]))

        for whole in batches:
            for batch in slices(whole, "text"):
                terms = Terms(batch.column("text"), ALPHANUMERIC)
                for i, (item, text) in enumerate(zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                    own = terms.hashes[terms.first[i] : terms.first[i + 1]]
                    if not len(own):
                        continue
                    if text == last and groups:
                        groups[-1].append(item)
                    else:
                        if held >= limit:
                            yield flush()
                            texts, groups, held = [], [], 0
                        texts.append(own)
                        groups.append([item])
                        held += max(1, len(own) - size + 1)
                    last = text
        if groups:
            yield flush()

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    dealt = named.where("text IS NOT NULL").repartition("text").sortWithinPartitions("text", "item")
    return sorted(r["address"] for r in written(dealt.mapInArrow(run, "address string"), "windows").collect())


# ---- search -------------------------------------------------------------------------------------------------


class _Query:
    """The windows of a block that a segment can hold: all their terms occur in it."""

    def __init__(self, segment: Segment, block: Block):
        self.segment = segment
        n, size = block.terms.shape
        flat, inverse = np.unique(block.terms, return_inverse=True)
        spot = np.minimum(np.searchsorted(segment.terms, flat), max(len(segment.terms) - 1, 0))
        known = segment.terms[spot] == flat if len(segment.terms) else np.zeros(len(flat), bool)
        inverse = inverse.reshape(n, size)
        used = np.arange(size)[None, :] < block.lengths[:, None]
        self.window = np.flatnonzero((known[inverse] | ~used).all(axis=1))
        self.term = spot[inverse[self.window]]
        self.length = block.lengths[self.window]
        counts = np.where(used[self.window], segment.counts[self.term] if len(segment.counts) else 0, 1 << 60)
        self.order = np.argsort(counts, axis=1, kind="stable")  # rare first, unused places last
        self.rarest = np.take_along_axis(counts, self.order[:, :1], axis=1)[:, 0]

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers with the places of their rarest term, about CANDIDATES at a time."""
        ends = np.cumsum(self.rarest)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + CANDIDATES, side="right")))
            rows = np.arange(start, stop)
            rare = self.term[rows, self.order[rows, 0]]
            owner, at = expand(self.segment.first[rare], self.rarest[rows])
            yield rows[owner], self.segment.places[at]
            start = stop

    def phrases(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers and start places of exact occurrences."""
        for rows, places in self.runs():
            start = places - self.order[rows, 0]
            rows, start = rows[start >= 0], start[start >= 0]
            for j in range(1, self.order.shape[1]):
                offset = self.order[rows, j]
                there = self.segment.at_or_after(self.term[rows, offset], start + offset) == start + offset
                keep = there | (j >= self.length[rows])
                rows, start = rows[keep], start[keep]
            yield rows, start

    def near(self, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers and documents that hold all terms of the window within ``width`` terms."""
        for rows, places in self.runs():
            rows, places = np.unique(np.column_stack((rows, places)), axis=0).T
            for j in range(1, self.order.shape[1]):  # each other term somewhere around the rarest
                term = self.term[rows, self.order[rows, j]]
                there = self.segment.at_or_after(term, places - width + 1) < places + width
                keep = there | (j >= self.length[rows])
                rows, places = rows[keep], places[keep]
            starts = []  # a shortest stretch starts with one of the terms, at or before the rarest
            for j in range(self.order.shape[1]):
                some, place = rows[j < self.length[rows]], places[j < self.length[rows]]
                term = self.term[some, self.order[some, j]]
                low = np.searchsorted(self.segment.keys, (term << 32) | np.maximum(place - width + 1, 0))
                high = np.searchsorted(self.segment.keys, (term << 32) | place, side="right")
                owner, at = expand(low, high - low)
                starts.append(np.column_stack((some[owner], self.segment.places[at])))
            some, start = np.unique(np.concatenate(starts), axis=0).T
            last = start
            for j in range(self.order.shape[1]):
                found = self.segment.at_or_after(self.term[some, self.order[some, j]], start)
                found = np.where(j < self.length[some], found, start)
                keep = found < start + width
                some, start, last = some[keep], start[keep], np.maximum(last, found)[keep]
            own = self.segment.document(start)
            same = own == self.segment.document(last)
            yield some[same], own[same]


def _holders(block: Block, windows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Different pairs of document and group of items, packed into one number."""
    pairs = np.unique((docs.astype(np.int64) << 32) | windows)
    docs, windows = pairs >> 32, pairs & 0xFFFFFFFF
    first = block.holder_first[windows]
    owner, at = expand(first, block.holder_first[windows + 1] - first)
    return np.unique((docs[owner] << 32) | block.holders[at])


def _names(pairs: list[np.ndarray], blocks: list[list[list[str]]], docs: int) -> pa.Array:
    """Sorted different items per document; documents with the same groups share the work."""
    own: list[tuple] = [()] * docs
    for number, some in enumerate(pairs):
        doc, group = some >> 32, some & 0xFFFFFFFF
        edges = np.flatnonzero(np.diff(doc, prepend=-1, append=docs))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own[doc[a]] += tuple((number, int(g)) for g in group[a:b])
    known: dict[tuple, list[str]] = {}
    out = []
    for key in own:
        if key not in known:
            known[key] = sorted({i for number, g in key for i in blocks[number][g]})
        out.append(known[key])
    return pa.array(out, pa.list_(pa.string()))


def _searched(row: dict, addresses: list[str], width: int | None) -> Iterator[pa.RecordBatch]:
    segment = Segment(row)
    n, end = len(segment.sizes), int(segment.starts[-1])
    change = np.zeros(end + 1, np.int64)
    exact, close, names = [], [], []
    for address in addresses:
        block = Block.unpack(get(address))
        query = _Query(segment, block)
        for found, out in ((query.phrases(), exact), (query.near(width) if width else (), close)):
            hits = []
            for rows, where in found:
                docs = where
                if out is exact:
                    np.add.at(change, where, 1)
                    np.add.at(change, where + query.length[rows], -1)
                    docs = segment.document(where)
                hits.append(_holders(block, query.window[rows], docs))
            out.append(np.unique(np.concatenate(hits)) if hits else np.empty(0, np.int64))
        names.append(block.items)
    hit = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).view(np.int8)))
    begin, stop = edges[0::2], edges[1::2]
    owner = segment.document(begin)
    n_hit = np.bincount(owner, weights=stop - begin, minlength=n).astype(np.int64)
    first = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    spans = pa.StructArray.from_arrays(
        [pa.array(begin - segment.starts[owner]), pa.array(stop - begin)], names=["start", "length"]
    )
    whole = pa.RecordBatch.from_arrays(
        [
            segment.ids, pa.array(segment.sizes), pa.array(n_hit), pa.ListArray.from_arrays(first, spans),
            _names(exact, names, n), _names(close, names, n),
        ],
        names=["doc_id", "n_words", "n_hit", "spans", "items", "near_items"],
    )
    for i in range(0, n, 4096):
        yield whole.slice(i, 4096)


def search(index: DataFrame, items: DataFrame, size: int = 10, width: int | None = None) -> DataFrame:
    """Every document with what it shares with the test texts ``items`` (item_id, text).

    Returned: doc_id, n_words, n_hit (words inside an exact occurrence of a window), spans (hit stretches, in words
    from the start of the text), items (sorted ids of items with an exact occurrence) and near_items (of items with a
    window whose words lie within ``width`` consecutive words; empty where ``width`` is None).
    """
    prepare(index.sparkSession)
    addresses = windows(items, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _searched(batch.slice(i, 1).to_pylist()[0], addresses, width)

    return index.mapInArrow(run, _MATCHES)
