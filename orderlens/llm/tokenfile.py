"""Files of token ids with keyed access through a minimal perfect hash.

A shard is two files. ``ids`` holds the raw ids of its documents one after another, in ascending key order, two
bytes each where the vocabulary allows it and four otherwise. ``index`` holds the keys, each document's offset,
and a minimal perfect hash of the distinct keys: a cascade of bit arrays in which a key owns the bit that no
other key of its level hits; the rank of that bit is its slot. A slot stores the first document of its key and a
32-bit fingerprint, so a key that is not in the shard is refused without reading the keys. A lookup takes
constant time. A manifest, a Parquet table with one row per shard, is what readers start from.

Null text counts as empty (the end id alone). Rows are ordered by key, null keys first, then by text; rows that
share a key stay next to each other, and a lookup returns all of them. An empty table gives a manifest without
rows. Further columns of the input are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm import vocab
from orderlens.llm.store import fresh, get, mapped, prepare, put, written
from orderlens.llm.words import mix, slices

GAMMA, SHARD_IDS = 2.0, 16 << 20
MANIFEST = (
    "part int, file int, first_key bigint, last_key bigint, n_docs bigint, n_ids bigint, "
    "width int, ids string, index string"
)


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(keys.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64)))


class PerfectHash:
    """Maps n distinct 64-bit keys onto 0..n-1."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, ranks: np.ndarray):
        self.sizes, self.words, self.ranks = sizes, words, ranks

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        sizes, parts, left = [], [], np.asarray(keys, np.int64)
        while len(left):
            size = -(-int(GAMMA * len(left) + 1) // 64) * 64
            at = (_hash(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        words = np.concatenate(parts) if parts else np.empty(0, "<u8")
        counts = np.bitwise_count(words).astype(np.int64)
        return PerfectHash(np.array(sizes, np.int64), words, np.cumsum(counts) - counts)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; some slot or -1 for a key that was not built in."""
        out, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = (_hash(keys[open_], level) % np.uint64(size)).astype(np.int64)
            word, bit = base + at // 64, (at % 64).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (self.ranks[word] + np.bitwise_count(below))[hit]
            open_, base = open_[~hit], base + int(size) // 64
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 255) >> np.uint64(32)).astype(np.uint32)


def _index(keys: np.ndarray, nulls: int, lengths: np.ndarray) -> bytes:
    """keys: of the documents after the first ``nulls``, which have none."""
    own, first = np.unique(keys, return_index=True)
    table = PerfectHash.build(own)
    slots = table.slots(own)
    start, prints = np.empty(len(own), np.int64), np.empty(len(own), np.uint32)
    start[slots], prints[slots] = first + nulls, fingerprints(own)
    out = io.BytesIO()
    np.savez(
        out, keys=keys, nulls=np.array([nulls]), offsets=np.concatenate(([0], np.cumsum(lengths))), start=start,
        prints=prints, sizes=table.sizes, words=table.words, ranks=table.ranks,
    )
    return out.getvalue()


class Shard:
    """One shard opened for reading."""

    def __init__(self, ids: str, index: str, width: int):
        x = np.load(io.BytesIO(get(index)))
        self.keys, self.nulls, self.offsets = x["keys"], int(x["nulls"][0]), x["offsets"]
        self.start, self.prints = x["start"], x["prints"]
        self.table = PerfectHash(x["sizes"], x["words"], x["ranks"])
        self.ids = mapped(ids, f"<u{width}")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of the first document of each key, -1 where the shard has none."""
        slots = self.table.slots(keys)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == fingerprints(keys[known])
        first = np.full(len(keys), -1, np.int64)
        first[known] = self.start[slots[known]]
        # A foreign key may share a fingerprint; its own key settles that.
        known[known] = self.keys[first[known] - self.nulls] == keys[known]
        first[~known] = -1
        return first

    def payload(self, doc: int) -> bytes:
        return self.ids[self.offsets[doc] : self.offsets[doc + 1]].astype("<u4").tobytes()


def write(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Encode, write the shards in key order and return the manifest."""
    spark = docs.sparkSession
    prepare(spark)
    folder = fresh(spark, "tokenfile")
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, tool = TaskContext.get().partitionId(), vocab.encoder(vocabulary)
        width = 2 if tool.tokenizer.get_vocab_size() <= 1 << 16 else 4
        keys: list[int | None] = []
        texts: list[bytes] = []
        held = number = 0

        def flush() -> pa.RecordBatch:
            known = np.array([k for k in keys if k is not None], np.int64)
            nulls, lengths = len(keys) - len(known), np.array([len(t) // 4 for t in texts], np.int64)
            ids = np.frombuffer(b"".join(texts), "<u4").astype(f"<u{width}")
            row = {
                "part": part, "file": number, "first_key": keys[0], "last_key": keys[-1], "n_docs": len(keys),
                "n_ids": int(lengths.sum()), "width": width, "ids": put(folder, f"{part}-{number}.ids", ids.tobytes()),
                "index": put(folder, f"{part}-{number}.index", _index(known, nulls, lengths)),
            }
            return pa.RecordBatch.from_pylist([row], schema=_MANIFEST_ARROW)

        for whole in batches:
            for batch in slices(whole, "text"):
                encoded = tool.encode(batch.column("text").to_pylist())
                keys.extend(batch.column("doc_id").to_pylist())
                texts.extend(raw + tail for raw in encoded)
                held += sum(map(len, encoded)) // 4 + len(encoded)
                if held > SHARD_IDS:
                    yield flush()
                    keys, texts, held, number = [], [], 0, number + 1
        if keys:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(run, MANIFEST), "manifest")


_MANIFEST_ARROW = pa.schema(
    [("part", pa.int32()), ("file", pa.int32()), ("first_key", pa.int64()), ("last_key", pa.int64())]
    + [("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("ids", pa.string()), ("index", pa.string())]
)
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
_ROWS_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _placed(manifest: DataFrame) -> DataFrame:
    """Each shard with the number of ids before it; one row per shard."""
    earlier = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0).cast("bigint")))


def read(manifest: DataFrame) -> DataFrame:
    """All documents from the files: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["ids"], row["index"], row["width"])
                # Keyed access: the slot gives the first document of a key, repeats follow it.
                first = shard.find(shard.keys)
                repeat = np.arange(len(first)) - (np.searchsorted(shard.keys, shard.keys) if len(first) else 0)
                docs = np.concatenate((np.arange(shard.nulls), first + repeat))
                names = [None] * shard.nulls + shard.keys.tolist()
                for i in range(0, len(docs), 512):
                    some = docs[i : i + 512]
                    starts = shard.offsets[some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[i : i + 512], pa.int64()),
                            pa.array(row["base"] + starts, pa.int64()),
                            pa.array(shard.offsets[some + 1] - starts, pa.int64()),
                            pa.array([shard.payload(int(d)) for d in some], pa.binary()),
                        ],
                        schema=_ROWS_ARROW,
                    )

    prepare(manifest.sparkSession)
    shards = max(1, manifest.count())
    spread = _placed(manifest).repartition(2 * shards, "part", "file")
    return spread.mapInArrow(run, ROWS)


def lookup(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the asked keys (column ``doc_id``). Keys meet the shards whose key range holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, Shard] = {}
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["ids"] not in opened:
                    opened.clear()
                    opened[row["ids"]] = Shard(row["ids"], row["index"], row["width"])
                shard = opened[row["ids"]]
                doc = int(shard.find(np.array([row["asked"]], np.int64))[0])
                while 0 <= doc < len(shard.offsets) - 1 and shard.keys[doc - shard.nulls] == row["asked"]:
                    at = int(shard.offsets[doc])
                    rows.append((row["asked"], row["base"] + at, int(shard.offsets[doc + 1]) - at, shard.payload(doc)))
                    doc += 1
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS_ARROW, strict=True)], schema=_ROWS_ARROW)

    prepare(manifest.sparkSession)
    asked = keys.select(F.col("doc_id").cast("bigint").alias("asked")).where("asked IS NOT NULL").distinct()
    places = _placed(manifest)  # one row of some 300 bytes per shard of up to 16 million ids
    met = asked.join(places, (F.col("asked") >= F.coalesce("first_key", F.lit(-(1 << 63)))) & (F.col("asked") <= F.col("last_key")))
    return met.repartition("ids").sortWithinPartitions("ids").mapInArrow(run, ROWS)
