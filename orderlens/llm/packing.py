"""Packing by concatenating and cutting.

All documents form one stream of token ids, each followed by an end id. Pass one encodes every partition and
notes for each row how many ids precede it there; a prefix sum over the partitions' totals (one row each) turns
that into a global place. Pass two cuts the stream at multiples of the window. A row of the result is a boundary
record: which ids of which document lie where in which sequence. Only the last sequence is not full.

Null text counts as empty (the end id alone); a null or repeated ``doc_id`` is a document like any other; an
empty table gives no rows; further columns of the input are ignored. Very long documents are stored in rows of
at most ``CHUNK`` ids, so a piece may also end there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm import vocab
from orderlens.llm.store import prepare, written
from orderlens.llm.words import slices

CHUNK = 1 << 15
BROADCAST_PARTS = 1_000_000
TOKENS = "doc_id bigint, part int, before bigint, first bigint, length int, doc_tokens bigint, ids binary"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("before", pa.int64()), ("first", pa.int64())]
    + [("length", pa.int32()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
)


def encode_partitions(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Rows of at most CHUNK ids (little-endian unsigned 32-bit) with their place in their partition."""
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, tool = TaskContext.get().partitionId(), 0, vocab.encoder(vocabulary)
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = []
                encoded = tool.encode(batch.column("text").to_pylist())
                for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                    raw += tail
                    n = len(raw) // 4
                    for first in range(0, n, CHUNK):
                        cut = raw[4 * first : 4 * (first + CHUNK)]
                        rows.append((doc_id, part, before + first, first, len(cut) // 4, n, cut))
                    before += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW
                )

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, TOKENS)


def pack(docs: DataFrame, vocabulary: str, window: int = 4096, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    tokens = written(encode_partitions(docs, vocabulary, end_id), "packing", codec="zstd")
    totals = tokens.groupBy("part").agg(F.sum("length").alias("total"))
    # One row per partition of the input: small, and ordered by partition number.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    # 16 bytes per partition of the input; beyond a million partitions the join shuffles instead.
    small = F.broadcast(base) if totals.count() <= BROADCAST_PARTS else base
    placed = tokens.join(small, "part").withColumn("at", F.col("base") + F.col("before"))

    def piece(number):
        begin = F.greatest(number * window, F.col("at"))
        length = F.least((number + 1) * window, F.col("at") + F.col("length")) - begin
        inner = (begin - F.col("at")).cast("int")
        return F.struct(
            (F.col("first") + inner).alias("start"),
            length.alias("length"),
            F.substring(F.col("ids"), inner * 4 + 1, (length * 4).cast("int")).alias("ids"),
            number.alias("sequence_id"),
            (begin - number * window).alias("offset"),
        )

    first = F.floor(F.col("at") / window).cast("bigint")
    last = F.floor((F.col("at") + F.col("length") - 1) / window).cast("bigint")
    return placed.select(
        "doc_id", "doc_tokens", F.explode(F.transform(F.sequence(first, last), piece)).alias("p")
    ).select("doc_id", "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: ids in order and the pieces they hold. A group has at most one window of ids."""
    entry = F.struct("offset", "doc_id", "start", "length", "ids")
    return (
        pieces.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(entry)).alias("p"))
        .select(
            "sequence_id",
            F.aggregate("p", F.lit(0).cast("bigint"), lambda n, x: n + x["length"]).alias("n_tokens"),
            F.transform("p", lambda x: F.struct(x["doc_id"], x["start"], x["offset"], x["length"])).alias("pieces"),
            F.aggregate("p", F.lit(b""), lambda out, x: F.concat(out, x["ids"])).alias("ids"),
        )
    )
