"""A Merkle manifest of a table whose leaf coordinates come from bitmap ranks.

**Coordinates.** The ids of each group are kept as bitmaps: containers of 4,096 neighbouring ids, each a sorted list
of 16-bit numbers while that is shorter, else a bit array with a directory of population counts per 64 bits. Tasks
build containers of their own rows; containers of the same place are merged by or. A trie of population counts gives
the ids before a container; no node has more than 16,384 children, so no prefix sum runs over more rows than that.
The place of a leaf in its group is the rank of its id. Rows are never sorted by id.

**Levels.** Nodes are dealt into slot arrays of ``arity ** depth`` consecutive places, keyed by group and block. A
task fills the array of one block and reduces up to ``depth`` levels; the tops of the blocks are the nodes of the next
round, ``arity ** depth`` times fewer. The tops of the groups, in order of the groups, form the upper tree the same way.
Proofs are read downwards: blocks of the upper rounds pass the path from their top to the root to the nodes below, so
siblings of a leaf are computed again from its block and never stored.

**Odd input.** Any field may be null; it enters the digest as ``-``. A null group comes before all others and a null
id before all ids of its group. Rows that share group and id follow each other in order of their digests; equal rows
take neighbouring places. A group whose ids repeat more often than a container holds, up to a third of all rows with one id, is
spread over tasks: containers are copied to as many pieces as their rows need, and repeated ids are ordered by a
distributed ranking. Only these rows are sorted. An empty table gives an empty manifest. Very long texts only pass through the digest. Only
named fields are read and the result has columns of its own, so further columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.store import prepare, written
from orderlens.operators.ranking import global_rank

ARITY, DEPTH = 3, 7
BITS = 12
CONTAINER = 1 << BITS
LISTED = CONTAINER // 16  # longer lists of 16-bit numbers take more room than the bit array
TRIE = (40, 28, 14, 0)  # the bits of a container's number that each level of the trie leaves out
NULL_CHUNK = -(1 << (63 - BITS)) - 1  # before the container of every 64-bit id


def field_text(value: Column) -> Column:
    """A field as it enters the digest: its UTF-8 byte count, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*fields: Column) -> Column:
    """The leaf digest of the fields, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(f) for f in fields]), 256))


def combined(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- bitmaps ------------------------------------------------------------------------------------------------


def pack_container(low: np.ndarray) -> bytes:
    """Sorted different numbers below CONTAINER: two bytes each, or a bit array where that is shorter."""
    if len(low) < LISTED:
        return low.astype("<u2").tobytes()
    bits = np.zeros(CONTAINER, bool)
    bits[low] = True
    return np.packbits(bits, bitorder="little").tobytes()


def members(raw: bytes) -> np.ndarray:
    if len(raw) < CONTAINER // 8:
        return np.frombuffer(raw, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little"))


class Ranks:
    """Rank queries on one container: ids by population counts, repeated ids by prefix sums of their rows."""

    def __init__(self, bits: bytes, repeated: bytes, rows: bytes):
        self.listed = len(bits) < CONTAINER // 8
        if self.listed:
            self.low = np.frombuffer(bits, "<u2")
        else:
            self.words = np.frombuffer(bits, "<u8")
            counts = np.bitwise_count(self.words).astype(np.int64)
            self.directory = np.cumsum(counts) - counts
        self.repeated = members(repeated)
        self.extra = np.concatenate(([0], np.cumsum(np.frombuffer(rows, "<i8") - 1)))

    def below(self, low: np.ndarray) -> np.ndarray:
        """How many rows have a smaller id."""
        if self.listed:
            ids = np.searchsorted(self.low, low.astype(np.uint16)).astype(np.int64)
        else:
            word, bit = low >> 6, (low & 63).astype(np.uint64)
            ids = self.directory[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
        return ids + self.extra[np.searchsorted(self.repeated, low)]

    def is_repeated(self, low: np.ndarray) -> np.ndarray:
        return np.isin(low, self.repeated)


_CONTAINER = "grp string, chunk bigint, bits binary, repeated binary, repeats binary, n_rows bigint"
_CONTAINER_ARROW = pa.schema(
    [("grp", pa.string()), ("chunk", pa.int64()), ("bits", pa.binary()), ("repeated", pa.binary())]
    + [("repeats", pa.binary()), ("n_rows", pa.int64())]
)


def _container(grp: str, chunk: int, low: np.ndarray, rows: np.ndarray) -> dict:
    """``rows`` of each of the sorted different ids ``low``."""
    twice = rows > 1
    return {
        "grp": grp, "chunk": int(chunk), "bits": pack_container(low), "repeated": pack_container(low[twice]),
        "repeats": rows[twice].astype("<i8").tobytes(), "n_rows": int(rows.sum()),
    }


def _local_containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of the rows of one task, at most a million rows at a time."""

    def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        names = rows.column("grp").combine_chunks().dictionary_encode()
        keys = np.column_stack((names.indices.to_numpy(), rows.column("chunk").to_numpy(), rows.column("low").to_numpy()))
        different, n = np.unique(keys, axis=0, return_counts=True)
        edges = np.flatnonzero((np.diff(different[:, :2], axis=0, prepend=different[:1, :2] - 1) != 0).any(axis=1))
        groups, out = names.dictionary.to_pylist(), []
        for a, b in zip(edges, [*edges[1:], len(n)], strict=True):
            out.append(_container(groups[different[a, 0]], different[a, 1], different[a:b, 2], n[a:b]))
            if len(out) == 1024:
                yield pa.RecordBatch.from_pylist(out, schema=_CONTAINER_ARROW)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=_CONTAINER_ARROW)

    parts, held = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
            held += batch.num_rows
        if held >= 1 << 20:
            yield from flush(parts)
            parts, held = [], 0
    if parts:
        yield from flush(parts)


def _merged_containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of one place, next to each other in the input, become one."""
    key, lows, counts, held = None, [], [], 0

    def merge() -> tuple[np.ndarray, np.ndarray]:
        low, where = np.unique(np.concatenate(lows), return_inverse=True)
        rows = np.zeros(len(low), np.int64)
        np.add.at(rows, where, np.concatenate(counts))
        return low, rows

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if (row["grp"], row["chunk"]) != key:
                if key is not None:
                    out.append(_container(*key, *merge()))
                key, lows, counts, held = (row["grp"], row["chunk"]), [], [], 0
            low = members(row["bits"])
            rows = np.ones(len(low), np.int64)
            rows[np.searchsorted(low, members(row["repeated"]))] = np.frombuffer(row["repeats"], "<i8")
            lows.append(low)
            counts.append(rows)
            held += len(low)
            if held > 16 * CONTAINER:  # one container per task: merged as they come
                low, rows = merge()
                lows, counts, held = [low], [rows], len(low)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_CONTAINER_ARROW)
    if key is not None:
        yield pa.RecordBatch.from_pylist([_container(*key, *merge())], schema=_CONTAINER_ARROW)


def bitmaps(leaves: DataFrame) -> DataFrame:
    """One row per group and container of ``leaves`` (grp, chunk, low): its ids, those that repeat, and its rows."""
    local = leaves.select("grp", "chunk", "low").mapInArrow(_local_containers, _CONTAINER)
    placed = local.repartition("grp", "chunk").sortWithinPartitions("grp", "chunk")
    return written(placed.mapInArrow(_merged_containers, _CONTAINER), "containers")


def directory(containers: DataFrame) -> DataFrame:
    """Containers with ``before``, the rows of their group in smaller containers, and ``n``, all rows of the group.

    Counts are summed level by level in a trie: no sum runs over more than 16,384 rows.
    """
    totals = containers.groupBy("grp").agg(F.sum("n_rows").alias("n"))
    out, before = containers.join(totals, "grp"), F.lit(0).cast("bigint")
    for up, bits in zip((None, *TRIE), TRIE, strict=False):
        node, above = F.shiftright("chunk", bits), F.lit(0) if up is None else F.shiftright("chunk", up)
        sums = containers.groupBy("grp", above.alias("above"), node.alias("node")).agg(F.sum("n_rows").alias("rows"))
        earlier = Window.partitionBy("grp", "above").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("grp", "node", F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("bigint")).alias(f"before{bits}"))
        out = out.withColumn("node", node).join(sums, ["grp", "node"]).drop("node")
        before = before + F.col(f"before{bits}")
    return out.select(*containers.columns, before.alias("before"), "n")


# ---- coordinates --------------------------------------------------------------------------------------------


_PLACED = "grp string, n bigint, pos bigint, number bigint, doc_id bigint, leaf binary, claim binary, again boolean"
_PLACED_ARROW = pa.schema(
    [("grp", pa.string()), ("n", pa.int64()), ("pos", pa.int64()), ("number", pa.int64()), ("doc_id", pa.int64())]
    + [("leaf", pa.binary()), ("claim", pa.binary()), ("again", pa.bool_())]
)


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each container is followed by its leaves; their ranks."""
    ranks, before, n = None, 0, 0
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        low = batch.column("low").fill_null(0).to_numpy(zero_copy_only=False)
        pos, size = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
        again = np.zeros(len(kind), bool)
        heads = np.flatnonzero(kind == 0)
        for a, b in zip([-1, *heads], [*heads, len(kind)], strict=True):
            if a >= 0:
                row = batch.slice(a, 1).select(["bits", "repeated", "repeats", "before", "n"]).to_pylist()[0]
                ranks, before, n = Ranks(row["bits"], row["repeated"], row["repeats"]), row["before"], row["n"]
            if b > a + 1:
                some = slice(a + 1, b)
                pos[some], size[some], again[some] = before + ranks.below(low[some]), n, ranks.is_repeated(low[some])
        columns = {c: batch.column(c) for c in ("grp", "number", "doc_id", "leaf", "claim")}
        columns |= {"n": pa.array(size), "pos": pa.array(pos), "again": pa.array(again)}
        out = pa.RecordBatch.from_arrays([columns[f.name] for f in _PLACED_ARROW], schema=_PLACED_ARROW)
        yield out.filter(pa.array(kind == 1))


def coordinates(leaves: DataFrame) -> DataFrame:
    """Leaves with their place ``pos`` among the ``n`` of their group."""
    containers = written(directory(bitmaps(leaves)), "directory")
    pieces = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("n_rows") / CONTAINER))
    crowded = containers.where(F.col("n_rows") > CONTAINER).select("grp", "chunk", pieces.alias("pieces"))
    # Only repeated ids crowd a container. Where there are none, leaves need not be looked at for pieces.
    if crowded.isEmpty():
        rows = leaves.withColumn("piece", F.lit(0).cast("bigint"))
    else:
        rows = leaves.join(crowded, ["grp", "chunk"], "left")
        rows = rows.withColumn("piece", F.pmod(F.xxhash64("number"), F.coalesce("pieces", F.lit(1).cast("bigint"))))
    heads = containers.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)))
    both = heads.withColumn("kind", F.lit(0)).unionByName(
        rows.drop("pieces").withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    names = ["grp", "kind", "low", "number", "doc_id", "leaf", "claim", "bits", "repeated", "repeats", "before", "n"]
    dealt = both.repartition("grp", "chunk", "piece").sortWithinPartitions("grp", "chunk", "piece", "kind")
    placed = dealt.select(*names).mapInArrow(_ranked, _PLACED)
    if containers.where(F.length("repeated") > 0).isEmpty():
        return placed.drop("again")
    placed = written(placed, "ranked")
    again = global_rank(placed.where("again"), ["grp", "pos", "leaf", "number"], "rank")
    first = again.groupBy("grp", "pos").agg(F.min("rank").alias("first"))
    tied = again.join(first, ["grp", "pos"]).withColumn("pos", F.col("pos") + F.col("rank") - F.col("first"))
    return placed.where(~F.col("again")).drop("again").unionByName(tied.select(*placed.drop("again").columns))


# ---- levels -------------------------------------------------------------------------------------------------


_BLOCK = "grp string, block bigint, n bigint, slots binary, ids binary, known binary, claims binary, claimed binary, top string"
_BLOCK_ARROW = pa.schema(
    [("grp", pa.string()), ("block", pa.int64()), ("n", pa.int64())]
    + [(c, pa.binary()) for c in ("slots", "ids", "known", "claims", "claimed")]
    + [("top", pa.string())]
)


@dataclass(frozen=True)
class Shape:
    """How nodes are combined: ``arity`` at a time, ``depth`` levels within a block."""

    arity: int = ARITY
    depth: int = DEPTH

    @property
    def block(self) -> int:
        return self.arity**self.depth

    def levels(self, n: int) -> int:
        """Levels that a block of a tree of ``n`` nodes is reduced by."""
        out = 0
        while n > 1 and out < self.depth:
            n, out = -(-n // self.arity), out + 1
        return out

    def reduced(self, nodes: list[str], n: int) -> list[list[str]]:
        """The slot array and all levels above it."""
        out = [nodes]
        for _ in range(self.levels(n)):
            out.append([combined(out[-1][i : i + self.arity]) for i in range(0, len(out[-1]), self.arity)])
        return out

    def path(self, levels: list[list[str]], slot: int) -> list[tuple[int, list[str]]]:
        """Own place in the run and siblings, level by level."""
        out = []
        for nodes in levels[:-1]:
            start = slot - slot % self.arity
            run = nodes[start : start + self.arity]
            out.append((slot - start, run[: slot - start] + run[slot - start + 1 :]))
            slot //= self.arity
        return out


def _hex(raw: bytes) -> list[str]:
    text = raw.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _fill(shape: Shape):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos").combine_chunks()
        n, block = table.column("n")[0].as_py(), table.column("pos")[0].as_py() // shape.block
        leaf, claim, ids = (table.column(c).combine_chunks() for c in ("leaf", "claim", "doc_id"))
        slots = b"".join(leaf.to_pylist())
        row = {
            "grp": table.column("grp")[0].as_py(), "block": block, "n": n, "slots": slots,
            "ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
            "known": np.packbits(ids.is_valid().to_numpy(zero_copy_only=False)).tobytes(),
            "claims": b"".join(claim.drop_null().to_pylist()),
            "claimed": np.packbits(claim.is_valid().to_numpy(zero_copy_only=False)).tobytes(),
            "top": shape.reduced(_hex(slots), n)[-1][0],
        }
        return pa.Table.from_pylist([row], schema=_BLOCK_ARROW)

    return run


def _rounds(nodes: DataFrame, shape: Shape) -> list[DataFrame]:
    """Blocks of ``nodes`` (grp, n, pos, doc_id, leaf, claim), then of their tops, until each group has one top."""
    out = []
    while True:
        block = F.floor(F.col("pos") / shape.block)
        dealt = nodes.select("grp", "n", "pos", "doc_id", "leaf", "claim", block.alias("at"))
        blocks = written(dealt.groupBy("grp", "at").applyInArrow(_fill(shape), _BLOCK), "blocks")
        out.append(blocks)
        tops = blocks.where(F.col("n") > shape.block)
        if tops.isEmpty():
            return out
        left = F.ceil(F.col("n") / shape.block).cast("bigint")
        nodes = tops.select(
            "grp", left.alias("n"), F.col("block").alias("pos"), F.lit(None).cast("bigint").alias("doc_id"),
            F.unhex("top").alias("leaf"), F.lit(None).cast("binary").alias("claim"),
        )


def _whole(blocks: DataFrame, shape: Shape) -> DataFrame:
    """Blocks whose top is the root of their group."""
    return blocks.where(F.col("n") <= shape.block)


_PATH = "grp string, at bigint, subroot string, root string, path string"
_PATH_ARROW = pa.schema(
    [("grp", pa.string()), ("at", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("path", pa.string())]
)


def _path_text(path: list[tuple[int, list[str]]]) -> str:
    return "".join(f"{slot}{len(siblings)}{''.join(siblings)}" for slot, siblings in path)


def _path_of(text: str) -> list[tuple[int, list[str]]]:
    out, at = [], 0
    while at < len(text):
        slot, n = int(text[at]), int(text[at + 1])
        out.append((slot, [text[at + 2 + 64 * k : at + 66 + 64 * k] for k in range(n)]))
        at += 2 + 64 * n
    return out


def _descended(blocks: DataFrame, above: DataFrame, shape: Shape) -> DataFrame:
    """The path of every node of the blocks, from the paths of the blocks' tops."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels = shape.reduced(_hex(row["slots"]), row["n"])
                start = row["block"] * shape.block
                for a in range(0, len(levels[0]), 1024):
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "grp": row["grp"], "at": start + slot, "subroot": row["subroot"], "root": row["root"],
                                "path": _path_text(shape.path(levels, slot)) + row["path"],
                            }
                            for slot in range(a, min(a + 1024, len(levels[0])))
                        ],
                        schema=_PATH_ARROW,
                    )

    return _with_paths(blocks, above).mapInArrow(run, _PATH)


def _with_paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    paths = above.withColumnRenamed("at", "block")
    return blocks.drop("top").join(paths, ["grp", "block"])


def fold(digest: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a digest and its siblings lead to."""
    for slot, siblings in path:
        digest = combined([*siblings[:slot], digest, *siblings[slot:]])
    return digest


@dataclass(frozen=True)
class Manifest:
    """Blocks of all rounds below the roots of the groups, and of the tree above them.

    ``order`` gives each group (grp) its place and its root. ``root`` is None for an empty table.
    """

    shape: Shape
    rounds: list[DataFrame]
    order: DataFrame
    upper: list[DataFrame]
    root: str | None

    def paths(self) -> list[DataFrame]:
        """For each round, the path from the tops of its blocks to the root."""
        spark = self.order.sparkSession
        above = spark.createDataFrame([("", 0, "", self.root, "")] if self.root else [], _PATH)
        for blocks in reversed(self.upper):
            above = _descended(blocks, above, self.shape)
        tops = self.order.join(above.select(F.col("at").alias("pos"), "root", "path"), "pos")
        tops = written(tops.select("grp", F.lit(0).cast("bigint").alias("at"), F.col("top").alias("subroot"), "root", "path"), "paths")
        out: list[DataFrame] = []
        for blocks in reversed(self.rounds):
            own = tops.join(_whole(blocks, self.shape).select("grp"), "grp")
            if out:
                own = own.unionByName(written(_descended(following, out[-1], self.shape), "paths"))
            out.append(own)
            following = blocks
        return out[::-1]


def build(leaves: DataFrame, shape: Shape = Shape()) -> Manifest:
    """The manifest of ``leaves``: grp (see ``group_key``), doc_id, leaf (32 bytes) and claim (32 bytes or null).

    A claim is the digest under which somebody presents the row; ``proofs`` folds it with the true siblings.
    """
    spark = leaves.sparkSession
    prepare(spark)
    known = F.col("doc_id").isNotNull()
    chunk = F.when(known, F.shiftright("doc_id", BITS)).otherwise(F.lit(NULL_CHUNK)).alias("chunk")
    low = F.when(known, F.col("doc_id").bitwiseAND(F.lit(CONTAINER - 1))).otherwise(F.lit(0)).cast("bigint").alias("low")
    number = F.monotonically_increasing_id().alias("number")
    rows = written(leaves.select("grp", F.col("doc_id").cast("bigint").alias("doc_id"), "leaf", "claim").select("*", chunk, low, number), "leaves")
    rounds = _rounds(coordinates(rows), shape)
    roots = reduce(DataFrame.unionByName, [_whole(b, shape).select("grp", "top") for b in rounds])
    order = written(global_rank(roots, ["grp"], "pos"), "groups")
    n = order.count()
    none = F.lit(None)
    nodes = order.select(
        F.lit("").alias("grp"), F.lit(n).cast("bigint").alias("n"), "pos", none.cast("bigint").alias("doc_id"),
        F.unhex("top").alias("leaf"), none.cast("binary").alias("claim"),
    )
    upper = _rounds(nodes, shape) if n else []
    return Manifest(shape, rounds, order, upper, upper[-1].first()["top"] if n else None)


def group_key(group: Column) -> Column:
    """A group's name without nulls and in the order of the groups: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


_PROOF = (
    "grp string, pos bigint, doc_id bigint, leaf string, subroot string, root string, siblings array<string>, "
    "proof_sha256 string, folded_root string, verified boolean"
)


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf with its coordinate, its siblings up to the root, and what its claim (else itself) folds to."""
    shape = manifest.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels = shape.reduced(_hex(row["slots"]), row["n"])
                n, above = len(levels[0]), _path_of(row["path"])
                ids = np.frombuffer(row["ids"], "<i8").tolist()
                known = np.unpackbits(np.frombuffer(row["known"], np.uint8), count=n)
                claimed = np.unpackbits(np.frombuffer(row["claimed"], np.uint8), count=n)
                claims = iter(_hex(row["claims"]))
                beyond = [s for _, siblings in above for s in siblings]
                out = []
                for slot, leaf in enumerate(levels[0]):
                    path = shape.path(levels, slot)
                    siblings = [s for _, own in path for s in own] + beyond
                    folded = fold(next(claims) if claimed[slot] else leaf, path + above)
                    out.append(
                        {
                            "grp": row["grp"], "pos": row["block"] * shape.block + slot,
                            "doc_id": ids[slot] if known[slot] else None, "leaf": leaf, "subroot": row["subroot"],
                            "root": row["root"], "siblings": siblings, "proof_sha256": combined(siblings),
                            "folded_root": folded, "verified": folded == row["root"],
                        }
                    )
                    if len(out) == 512:
                        yield pa.RecordBatch.from_pylist(out, schema=_PROOF_ARROW)
                        out = []
                yield pa.RecordBatch.from_pylist(out, schema=_PROOF_ARROW)

    return _with_paths(manifest.rounds[0], manifest.paths()[0]).mapInArrow(run, _PROOF)


_PROOF_ARROW = pa.schema(
    [("grp", pa.string()), ("pos", pa.int64()), ("doc_id", pa.int64())]
    + [(c, pa.string()) for c in ("leaf", "subroot", "root")]
    + [("siblings", pa.list_(pa.string())), ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())]
)
