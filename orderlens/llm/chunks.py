"""Repeated passages by content-defined chunks.

A gear hash rolls over the bytes (16 bits, so it depends on the last 16 bytes); a place where it is the largest
within 16 bytes to either side ends a chunk. Chunks have some 33 bytes, and an insertion moves only the chunks
it touches. A chunk is known by a 64-bit digest. A chunk repeats if its digest occurs in a document of smaller id
or earlier in its own; a run of neighbouring repeated chunks of at least ``min_bytes`` is removed, so each passage
stays in the document of the smallest id. Only whole chunks are compared: up to a chunk at either edge of a
repeated passage may stay.

Pass one counts digests (the first and last document of each, combined on the map side, so a chunk of a third of
all documents is a few rows). Pass two meets only chunks that a Bloom filter of fixed size lets through, in
documents where they form a long enough run; all other documents go by without a shuffle.

Null text counts as empty and comes out empty. Rows that share a doc_id are one document here: what repeats
between them is kept in each. A null doc_id counts as an id of its own, made from the text, before all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.bloom import filter_bits, passes
from orderlens.llm.store import prepare, written
from orderlens.llm.words import slices, span_hashes, text_bytes

REACH, PAD = 16, 64
_GEAR = np.random.default_rng(997).integers(0, 1 << 16, 256, dtype=np.uint16)


def cut_places(data: np.ndarray) -> np.ndarray:
    """Where chunks end: after each byte whose gear hash is the largest within reach."""
    with np.errstate(over="ignore"):
        h = _GEAR[data]
        for k in (1, 2, 4, 8):
            older = np.zeros_like(h)
            older[k:] = h[:-k] if k < len(h) else 0
            h = h + (older << np.uint16(k))
    top = np.concatenate((np.zeros(REACH, np.uint16), h, np.zeros(2 * REACH, np.uint16)))
    for k in (1, 2, 4, 8):
        top = np.maximum(top[: len(top) - k], top[k:])
    n = len(h)
    before, after = top[:n], top[REACH + 1 : REACH + 1 + n]
    return np.flatnonzero((h > before) & (h >= after)) + 1


def chunked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all chunks in bytes of their text, digests, and each text's first chunk (n + 1 places)."""
    data, starts = text_bytes(column, PAD)
    ends = starts[1:] - PAD
    begin = starts[:-1]
    # Separators stand before the first text too, so its chunks do not depend on where it stands in a batch.
    cuts = cut_places(np.concatenate((np.full(PAD, 10, np.uint8), data))) - PAD
    owner = np.searchsorted(begin, cuts, side="right") - 1
    cuts = cuts[(owner >= 0) & (cuts > begin[owner]) & (cuts < ends[owner])] if len(begin) else cuts[:0]
    full = begin[ends > begin]
    a = np.sort(np.concatenate((full, cuts)))
    b = np.sort(np.concatenate((cuts, ends[ends > begin])))
    first = np.searchsorted(a, starts)
    own = np.searchsorted(begin, a, side="right") - 1
    return a - begin[own], b - begin[own], span_hashes(data, a, b), first


def _runs(flag: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Chunk ranges [i, j) of flagged neighbours that cover at least so many bytes."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flag, [False])).view(np.int8)))
    return [(i, j) for i, j in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True) if b[j - 1] - a[i] >= least]


def _again(digests: np.ndarray) -> np.ndarray:
    """Whether each chunk stood earlier in the same text."""
    out = np.ones(len(digests), bool)
    out[np.unique(digests, return_index=True)[1]] = False
    return out


def removed(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[dict]]:
    """The text without byte spans, drawn in to whole characters, and those spans in characters."""
    raw, out, where, at, chars = text.encode(), [], [], 0, 0
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        kept, gone = raw[at:a].decode(), raw[a:b].decode()
        out.append(kept)
        where.append({"start": chars + len(kept), "length": len(gone)})
        chars += len(kept) + len(gone)
        at = b
    return "".join(out) + raw[at:].decode(), where


def _field(name: str, kind: str | T.DataType) -> T.StructField:
    # A type built from its parts: written as text, it would not take every column name.
    return T.StructField(name, T.DataType.fromDDL(kind) if isinstance(kind, str) else kind)


def without_repeats(docs: DataFrame, min_bytes: int = 100) -> DataFrame:
    """The input's columns with ``text`` cleaned, and ``spans`` (start, length in characters of the old text).

    A column of the input that is called ``spans`` (in any case) gives way to the result, as in ``withColumn``.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("bigint"), -1 - F.shiftrightunsigned(F.xxhash64(text), 1))
    rows = docs.select(key.alias("key"), text.alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("digest", pa.int64()), ("key", pa.int64())])
        for whole in batches:
            for batch in slices(whole, "text"):
                _, _, d, first = chunked(batch.column("text"))
                keys = np.repeat(batch.column("key").to_numpy(), np.diff(first))
                order = np.lexsort((keys, d))
                d, keys = d[order], keys[order]
                if not len(d):
                    continue
                head = np.concatenate(([True], d[1:] != d[:-1]))
                tail = np.concatenate((head[1:], [True]))
                use = head | (tail & ~head & (keys != keys[np.maximum.accumulate(np.where(head, np.arange(len(d)), 0))]))
                yield pa.RecordBatch.from_arrays([pa.array(d[use].view(np.int64)), pa.array(keys[use])], schema=schema)

    counted = rows.mapInArrow(count, "digest bigint, key bigint").groupBy("digest")
    several = written(
        counted.agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last").select("digest", "first"),
        "chunks-several",
    )
    bits = spark.sparkContext.broadcast(filter_bits(several, "digest"))

    fields = [("a", pa.int32()), ("b", pa.int32()), ("d", pa.int64()), ("again", pa.bool_())]
    chunk_type = pa.list_(pa.struct(fields))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = bits.value
        for whole in batches:
            for batch in slices(whole, "text"):
                a, b, d, first = chunked(batch.column("text"))
                maybe = passes(shared, d)
                found = []
                for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    again = _again(d[i:j])
                    runs = _runs(maybe[i:j] | again, a[i:j], b[i:j], min_bytes)
                    found.append(
                        [
                            {"a": int(a[i + k]), "b": int(b[i + k]), "d": int(d[i + k].view(np.int64)), "again": bool(again[k])}
                            for x, y in runs
                            for k in range(x, y)
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, chunk_type)],
                    schema=pa.schema([*batch.schema, ("chunks", chunk_type)]),
                )

    whole = docs.select(F.struct("*").alias("row"), key.alias("key"), text.alias("text"))
    chunk = T.StructType([_field("a", "int"), _field("b", "int"), _field("d", "bigint"), _field("again", "boolean")])
    found = T.StructType([*[_field(f.name, f.dataType) for f in whole.schema], _field("chunks", T.ArrayType(chunk))])
    marked = written(
        whole.mapInArrow(suspects, found).withColumn("id", F.monotonically_increasing_id()),
        "chunks-marked",
        codec="zstd",
    )
    bits.destroy()
    some = marked.where(F.size("chunks") > 0)
    each = some.select("id", "key", F.explode("chunks").alias("c")).select("id", "key", "c.*")
    hit = each.join(several, each["d"] == several["digest"], "left").where(F.col("again") | (F.col("first") < F.col("key")))
    gone = hit.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("gone"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text_, gone_ in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                joined: list[list[int]] = []
                for x in gone_:
                    if joined and joined[-1][1] == x["a"]:
                        joined[-1][1] = x["b"]
                    else:
                        joined.append([x["a"], x["b"]])
                t, s = removed(text_, [(x, y) for x, y in joined if y - x >= min_bytes])
                texts.append(t)
                spans.append(s)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(spans, kind)], names=["row", "cleaned", "spans"]
            )

    span_type = T.ArrayType(T.StructType([_field("start", "int"), _field("length", "int")]))
    cleaned = T.StructType([_field("row", whole.schema["row"].dataType), _field("cleaned", "string"), _field("spans", span_type)])
    changed = (
        some.join(gone, "id", "left")
        .select("row", "text", F.coalesce("gone", F.array().cast("array<struct<a:int,b:int>>")).alias("gone"))
        .mapInArrow(clean, cleaned)
    )
    same = marked.where(F.size("chunks") == 0).select(
        "row", F.col("text").alias("cleaned"), F.array().cast(span_type).alias("spans")
    )
    every = same.unionAll(changed)
    columns = [F.col("cleaned").alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() != "spans"]
    return every.select(*columns, "spans")
