"""Similarity join of documents on word shingles, as a blocked sparse matrix product.

The matrix has a row for each distinct shingle set and a column for each shingle. Two sets with Jaccard at least
t share at least ``ceil(t * n)`` columns of either, so for any fixed order of the columns they share at least k
within the first ``n - ceil(t * n) + k`` columns of each: this bound, from the size alone, selects the part of the
matrix that is multiplied first. k is one in ``SHARE`` of the columns that a link needs (one at least), so a row that
meets others in a few columns by chance, as ever more rows do in a larger table, goes no further. Columns are ordered rare first, by a sketch of fixed size that counts all rows, then by
hash; frequent passages thus stand behind and hardly any unrelated rows meet. Products are needed only where
they can matter: a pair of rows whose sizes alone rule a link out is dropped, the others' full overlap is added
up over blocks of columns, and a pair is dropped once the columns left cannot reach the bound.

Links are wanted up to connectivity, so a group of g near copies must not become g * g pairs. Rounds of few
columns (the smallest hashes of a row's shared columns, as in MinHash) link each row to one leader per column;
verified links are merged. Then all shared columns whose rows still belong to different components give all
pairs across components, and these are verified; of the smaller row only the first part of its prefix takes part,
``n - ceil(2 t n / (1 + t)) + 1`` columns, which is enough for a link to a row that is not smaller. A pair within one component changes nothing; so the components
are those of all links. Sets that are equal are one row from the start, whatever the number of documents.

Words are runs other than space and \\t \\n \\v \\f \\r with A-Z in lower case; a text of fewer words than a shingle
has its whole sequence as its only one; without words (or text) a document has an empty set and no links. Shingles
and sets are known by 64- and 128-bit hashes. Null or repeated ``doc_id``: rows are documents of their own; null
is never the smallest id of a component that holds another. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.bloom import filter_bits, passes
from orderlens.llm.components import components
from orderlens.llm.store import prepare, temporary, written
from orderlens.llm.vectors import parts, total
from orderlens.llm.words import hashed_words, mix, slices

SKETCH_BITS = 23
LEADERS, ROUNDS = 4, 2
SHARE = 20
#: Columns are met in so many blocks (a power of two); a task holds so many columns at a time.
BLOCK_BITS, HELD = 11, 2_000_000
_PACKED = pa.schema([("block", pa.int32()), ("places", pa.binary()), ("owners", pa.binary())])


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, first = hashed_words(column)
    with np.errstate(over="ignore"):
        grams = np.zeros(max(0, len(h) - size + 1), np.uint64)
        for k in range(size):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(grams)]
        grams = mix(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= size:
                yield np.unique(grams[a : b - size + 1])
            elif b > a:
                whole = np.uint64(b - a)
                for x in h[a:b]:
                    whole = whole * np.uint64(0xD6E8FEB86659FD93) + x
                yield mix(np.array([whole], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def _bound(n: int, percent: int) -> int:
    """Shared columns that a link needs at least."""
    return -(-n * percent // 100)


def _least(n: int, percent: int) -> int:
    """Columns of a row's prefix that others must have too; what a link needs beyond them never falls as n grows.

    So the smaller row's prefix holds at least as many of the first shared columns as the larger row must show.
    """
    return max(1, _bound(n, percent) // SHARE)


def _texts(docs: DataFrame, row: str | None = None) -> DataFrame:
    number = F.col(row) if row else F.monotonically_increasing_id()
    return docs.select(
        number.cast("bigint").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )


def _profile(docs: DataFrame, size: int, row: str | None) -> DataFrame:
    """Per document: row, doc_id, n, digest. Besides, from each task, parts of its column counts (``part`` is not null)."""
    names = ["row", "doc_id", "n", "digest", "part", "counts"]
    schema = pa.schema(zip(names, [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary()], strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint16)
        seen: set[bytes] = set()
        for whole in batches:
            for batch in slices(whole, "text"):
                n, digest, new = [], [], []
                for s in shingle_sets(batch.column("text"), size):
                    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    n.append(len(s))
                    digest.append(d)
                    if d not in seen and len(s):  # copies within a task count once
                        if len(seen) < 500_000:
                            seen.add(d)
                        new.append(s)
                if new:
                    at, times = np.unique(np.concatenate(new) >> np.uint64(64 - SKETCH_BITS), return_counts=True)
                    at = at.astype(np.int64)
                    sketch[at] = np.minimum(65535, sketch[at] + times)
                none = pa.nulls(len(n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(digest, pa.binary()),
                     none.cast(pa.int32()), none.cast(pa.binary())], schema=schema)
        for row in parts(sketch):
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    return _texts(docs, row).mapInArrow(run, "row bigint, doc_id bigint, n int, digest binary, part int, counts binary")


def _sketch(profile: DataFrame) -> np.ndarray:
    """Logarithms of the column counts of all rows, 8 MB whatever the input."""

    def classes(counts: np.ndarray) -> np.ndarray:
        return np.minimum(255, np.round(2 * np.log2(counts + 1.0))).astype(np.uint8)

    return total(profile.where("part IS NOT NULL").select("part", "counts"), 1 << SKETCH_BITS, classes, np.uint8)


def _prefix(s: np.ndarray, sketch: np.ndarray, percent: int) -> np.ndarray:
    """The columns within which a link must meet ``_least`` times, rare ones first."""
    order = np.argsort(sketch[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
    return s[order[: len(s) - _bound(len(s), percent) + _least(len(s), percent)]]


def _coarse(columns: np.ndarray) -> np.ndarray:
    """The columns' block and place, scrambled: columns that fall together only cost work."""
    return mix(columns >> np.uint64(64 - BLOCK_BITS - 32))


def _packed(columns: np.ndarray, owners: np.ndarray | None) -> pa.RecordBatch:
    """A row per block of columns: their places there, 32 bits each, and their rows' digests, if these are told apart."""
    order = np.argsort(columns)
    columns, owners = columns[order], owners if owners is None else owners[order]
    places = (columns >> np.uint64(64 - BLOCK_BITS - 32)).astype("<u4")
    cuts = np.searchsorted(columns >> np.uint64(64 - BLOCK_BITS), np.arange((1 << BLOCK_BITS) + 1, dtype=np.uint64))
    blocks = np.flatnonzero(np.diff(cuts))
    spans = list(zip(cuts[blocks].tolist(), cuts[blocks + 1].tolist(), strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks.astype(np.int32)), pa.array([places[i:j].tobytes() for i, j in spans], pa.binary()),
         pa.array([owners is not None and owners[i:j].tobytes() or None for i, j in spans], pa.binary())],
        schema=_PACKED)


def _prefix_columns(docs: DataFrame, size: int, percent: int, sketch, repeated) -> DataFrame:
    """The part multiplied first, in blocks of columns. Rows whose set others may have too go with its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, copied, seen = sketch.value, repeated.value, set()
        alone: list[np.ndarray] = []
        others: list[tuple[np.ndarray, np.ndarray]] = []
        for whole in batches:
            for batch in slices(whole, "text"):
                for s in shingle_sets(batch.column("text"), size):
                    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    if not len(s) or d in seen:
                        continue
                    if len(seen) < 500_000:
                        seen.add(d)
                    p, own = _prefix(s, counts, percent), np.frombuffer(d[:8], ">u8").astype(np.uint64)
                    if passes(copied, own)[0]:
                        others.append((p, np.repeat(own, len(p))))
                    else:
                        alone.append(p)
                if sum(map(len, alone)) > HELD:
                    yield _packed(np.concatenate(alone), None)
                    alone = []
                if sum(len(p) for p, _ in others) > HELD:
                    yield _packed(*map(np.concatenate, zip(*others, strict=True)))
                    others = []
        if alone:
            yield _packed(np.concatenate(alone), None)
        if others:
            yield _packed(*map(np.concatenate, zip(*others, strict=True)))

    return _texts(docs).mapInArrow(run, "block int, places binary, owners binary")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of a block that different sets have. Without digests, each place is of another set."""
    alone, copied, owners, block = [], [np.empty(0, "<u4")], [np.empty(0, np.uint64)], 0
    for batch in batches:
        for b, places, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            block = b
            if own is None:
                alone.append(np.frombuffer(places, "<u4"))
            else:
                copied.append(np.frombuffer(places, "<u4"))
                owners.append(np.frombuffer(own, np.uint64))
    c, own = np.concatenate(copied), np.concatenate(owners)
    order = np.lexsort((own, c))
    c, own = c[order], own[order]
    new = np.ones(len(c), bool)
    new[1:] = (c[1:] != c[:-1]) | (own[1:] != own[:-1])
    places, times = np.unique(np.concatenate([*alone, c[new]]), return_counts=True)
    found = mix((np.uint64(block) << np.uint64(32)) + places[times > 1].astype(np.uint64))
    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["col"])


def _shared_columns(docs: DataFrame, profile: DataFrame, size: int, percent: int, sketch) -> np.ndarray:
    """A filter of the columns that different sets share in the part multiplied first, as ``_coarse`` gives them."""
    several = profile.where("n > 0").groupBy("digest").agg(F.count("*").alias("c")).where("c > 1")
    low = several.select(F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("bigint").alias("d"))
    repeated = docs.sparkSession.sparkContext.broadcast(filter_bits(low, "d"))
    columns = _prefix_columns(docs, size, percent, sketch, repeated)
    shared = filter_bits(columns.groupBy("block").applyInArrow(_met, "col bigint"), "col")
    repeated.destroy()
    return shared


def _candidates(docs: DataFrame, size: int, percent: int, sketch, bits) -> DataFrame:
    """Rows that share as many columns of their prefix with others as a link needs there.

    digest, n, cols (its columns that others have too) and places (theirs in the order of all columns of the set),
    central (their share in 1/1000), keys (for the leader rounds), text, which is smaller than the set and gives it
    again, id, a number of its own.
    """
    names = ["digest", "n", "cols", "places", "central", "keys", "text"]
    longs = pa.list_(pa.int64())
    kinds = [pa.binary(), pa.int32(), longs, pa.list_(pa.int32()), pa.int32(), longs, pa.string()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shared, seen = sketch.value, bits.value, set()
        for whole in batches:
            for batch in slices(whole, "text"):
                rows, texts = [], batch.column("text")
                for i, s in enumerate(shingle_sets(texts, size)):
                    if not len(s):
                        continue
                    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    if d in seen:
                        continue
                    if len(seen) < 500_000:
                        seen.add(d)
                    whole_p = _prefix(s, counts, percent)
                    ok = passes(shared, _coarse(whole_p))
                    p = whole_p[ok]
                    if len(p) >= _least(len(s), percent):
                        # Near copies agree in most of their first columns, and in most minima of a hash.
                        with np.errstate(over="ignore"):
                            least = [p[np.argmin(mix(p + np.uint64(7919 * (k + 1))))] for k in range(LEADERS)]
                        rare = [p[min(k, len(p) - 1)] for k in range(LEADERS)]
                        keys = [int(x.view(np.int64)) for pair in zip(rare, least, strict=True) for x in pair]
                        central = 1000 * len(p) // len(whole_p)
                        places = np.flatnonzero(ok).astype(np.int32)
                        rows.append((d, len(s), p.view(np.int64), places, central, keys, texts[i].as_py()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
                    )

    kind = "digest binary, n int, cols array<bigint>, places array<int>, central int, keys array<bigint>, text string"
    return _texts(docs).mapInArrow(run, kind).dropDuplicates(["digest"]).withColumn("id", F.monotonically_increasing_id())


def _whole(n: str, percent: int) -> Column:
    """The length of the prefix of a row of n columns, as in ``_prefix``."""
    bound = f"(({n} * {percent}L + 99) div 100)"
    return F.expr(f"{n} - {bound} + greatest(1L, {bound} div {SHARE})")


def _front(n: str, percent: int) -> Column:
    """The length of its first part, enough for a link to a row that is not smaller."""
    return F.expr(f"{n} - ({n} * {2 * percent}L + {99 + percent}) div {100 + percent} + 1")


def _possible(c: Column, na: str, pa_: Column, nb: str, pb: Column, percent: int) -> Column:
    """Whether two rows that share c columns of their prefixes may link: what lies behind a prefix may all be shared."""
    need = F.ceil((F.col(na) + F.col(nb)) * percent / (100 + percent))
    sizes = F.least(na, nb).cast("bigint") * 100 >= F.greatest(na, nb).cast("bigint") * percent
    return sizes & (c + F.greatest(F.col(na) - pa_, F.col(nb) - pb) >= need)


def _overlap(a: np.ndarray, b: np.ndarray, percent: int, blocks: int = 8) -> bool:
    """Whether two sets link; overlap is added up block by block of the columns while a link is still possible."""
    need = -(-(len(a) + len(b)) * percent // (100 + percent))
    if min(len(a), len(b)) < need:
        return False
    step = (1 << 64) // blocks
    cuts = np.array([k * step for k in range(1, blocks)], np.uint64)
    ia, ib = (np.concatenate(([0], np.searchsorted(x, cuts), [len(x)])) for x in (a, b))
    shared = 0
    for k in range(blocks):
        x, y = a[ia[k] : ia[k + 1]], b[ib[k] : ib[k + 1]]
        if len(x) and len(y):
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            shared += int(np.count_nonzero(y[at] == x))
        if shared + min(len(a) - ia[k + 1], len(b) - ib[k + 1]) < need:
            return False
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _bounded(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs that the prefixes do not rule out."""
    side = rows.select("id", "n", "cols")
    met = pairs.join(side.alias("x"), F.col("x.id") == F.col("a")).join(side.alias("y"), F.col("y.id") == F.col("b"))
    shared = F.size(F.array_intersect("x.cols", "y.cols"))
    return met.where(_possible(shared, "x.n", _whole("x.n", percent), "y.n", _whole("y.n", percent), percent)).select("a", "b")


def _verified(pairs: DataFrame, rows: DataFrame, size: int, percent: int, label: str) -> DataFrame:
    """The pairs (a, b) of numbers of rows that link, written."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "y", 4 << 20):
                texts = dict(zip(batch.column("a").to_pylist(), batch.column("x").to_pylist(), strict=True))
                texts |= zip(batch.column("b").to_pylist(), batch.column("y").to_pylist(), strict=True)
                sets = dict(zip(texts, shingle_sets(pa.array(texts.values(), pa.string()), size), strict=True))
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                keep = [_overlap(sets[i], sets[j], percent) for i, j in zip(a, b, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=schema).filter(
                    pa.array(keep, pa.bool_())
                )

    # Only texts that are compared travel, by a filter of fixed size that lets few others through. Both joins read one
    # exchange of them; the second sides' texts travel once more.
    asked = pairs.select(F.explode(F.array("a", "b")).alias("d")).select(F.xxhash64("d").alias("h"))
    bits = rows.sparkSession.sparkContext.broadcast(filter_bits(asked, "h"))

    def compared(h: pa.Array) -> pa.Array:
        return pa.array(passes(bits.value, h.to_numpy(zero_copy_only=False).view(np.uint64)))

    texts = rows.where(F.arrow_udf(compared, "boolean")(F.xxhash64("id"))).select("id", "text")
    firsts = texts.alias("l").join(pairs.select("a").distinct(), F.col("l.id") == F.col("a"), "left_semi")
    left = pairs.join(texts.alias("s"), F.col("s.id") == F.col("b")).select(
        F.col("a").alias("lead"), "b", F.col("s.text").alias("y")
    )
    both = left.join(firsts.alias("l"), F.col("l.id") == F.col("lead")).select(
        F.col("lead").alias("a"), "b", F.col("l.text").alias("x"), "y"
    )
    found = written(both.mapInArrow(run, "a bigint, b bigint"), label)
    bits.destroy()
    return found


def _leader_pairs(rows: DataFrame, root: DataFrame, number: int) -> DataFrame:
    """For each row at most one pair: with the best leader of its columns of this round, where roots differ.

    The leader of a column is the row with the largest share of columns that others have: the one that copies
    were made from rather than one of its copies, which differ from each other more than from it.
    """
    keyed = rows.select("id", "central", F.explode(F.slice("keys", number * LEADERS + 1, LEADERS)).alias("k"))
    named = keyed.join(root, keyed["id"] == root["node"], "left").select(
        "id", "central", "k", F.coalesce("root", "id").alias("root")
    )
    best = F.max(F.struct("central", F.col("id").alias("a"))).alias("best")
    lead = named.groupBy("k").agg(best, F.min("root").alias("lo"), F.max("root").alias("hi"))
    met = named.join(lead.where("lo <> hi"), "k").where("id <> best.a")
    return met.groupBy(F.col("id").alias("b")).agg(F.max("best")["a"].alias("a")).select("a", "b")


def linked_documents(docs: DataFrame, size: int = 5, percent: int = 75, row: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), row, kept.

    row: a column that numbers the rows, passed on; ``kept`` marks one row of each component, that of the smallest
    doc_id (and then row).
    """
    spark = docs.sparkSession
    prepare(spark)
    with temporary(spark):
        return written(_linked(docs, size, percent, row), "jaccard-linked", keep=True)


def _linked(docs: DataFrame, size: int, percent: int, row: str | None) -> DataFrame:
    spark = docs.sparkSession
    profile = written(_profile(docs, size, row), "jaccard-profile")
    own = profile.where("part IS NULL").select("row", "doc_id", "n", "digest")
    sketch = spark.sparkContext.broadcast(_sketch(profile))
    bits = spark.sparkContext.broadcast(_shared_columns(docs, own, size, percent, sketch))
    rows = written(_candidates(docs, size, percent, sketch, bits), "jaccard-rows", codec="zstd")
    sketch.destroy()
    bits.destroy()

    root = spark.createDataFrame([], "node bigint, root bigint")
    links = spark.createDataFrame([], "a bigint, b bigint")
    for number in range(ROUNDS):
        pairs = written(_bounded(_leader_pairs(rows, root, number), rows, percent), "jaccard-pairs")
        links = links.unionAll(_verified(pairs, rows, size, percent, "jaccard-links"))
        # Between rounds a row's leader will do for its root; before all pairs roots must be final.
        one_step = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        root = one_step if number + 1 < ROUNDS else components(links, "jaccard-roots")
    # One entry per open column: it travels, so it holds numbers only; what a row's size gives is not in it.
    held = rows.join(root, rows["id"] == root["node"], "left").select(
        "id", "n", F.coalesce("root", "id").alias("root"), F.posexplode(F.arrays_zip("cols", "places")).alias("i", "at")
    ).select("id", "n", "root", "i", F.col("at.cols").alias("col"), (F.col("n") - F.col("at.places")).alias("rest"))
    mixed = held.groupBy("col").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("col")
    open_ = written(held.join(mixed, "col"), "jaccard-open", codec="zstd")
    # The product itself: the first part of the smaller row's prefix against the prefix of the larger. The first
    # column that a linked pair shares lies in both. Shared columns are counted, pairs below the bound dropped. Where
    # two rows meet, what they share is at most the open columns that both have passed and the columns that both have left.
    x, y = (open_.select("col", *[F.col(c).alias(f"{c}{s}") for c in ("id", "n", "root", "i", "rest")]) for s in "ab")
    reach = (F.least("ia", "ib") + F.least("resta", "restb")).cast("bigint")
    across = (
        x.where(F.col("na") - F.col("resta") < _front("na", percent))
        .join(y, "col")
        .where((F.col("roota") != F.col("rootb")) & (F.struct("na", "ida") < F.struct("nb", "idb")))
        .where(F.col("na").cast("bigint") * 100 >= F.col("nb").cast("bigint") * percent)
        .where(reach * (100 + percent) >= (F.col("na").cast("bigint") + F.col("nb")) * percent)
        .groupBy(F.col("ida").alias("a"), F.col("idb").alias("b"), "na", "nb")
        .agg(F.count("*").alias("c"))
        .where(_possible(F.col("c"), "na", _front("na", percent), "nb", _whole("nb", percent), percent))
        .select("a", "b")
    )
    # One column in a first part is little in a large group of rows that share a passage: the whole prefixes tell more.
    left = written(_bounded(written(across, "jaccard-across"), rows, percent), "jaccard-pairs")
    more = _verified(left, rows, size, percent, "jaccard-last")
    if more.limit(1).count():
        root = components(links.unionAll(more), "jaccard-roots")

    # Null ids come last, so a component has a null id only if it has no other.
    first = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")
    classes = own.where("n > 0").groupBy("digest").agg(F.min(first).alias("least"))
    # A set that went no further than its prefix has no number; it is a component of its own.
    ends = rows.select("digest", "id").join(root, F.col("id") == F.col("node"), "left").select("digest", F.coalesce("root", "id").alias("end"))
    merged = classes.join(ends, "digest", "left").select(
        "digest", "least", F.struct("end", F.when(F.col("end").isNull(), F.col("digest")).alias("only")).alias("root")
    )
    least = merged.groupBy("root").agg(F.min("least").alias("first"))
    named = merged.join(least, "root").select("digest", "first")
    return own.join(named, "digest", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        "row", ((F.col("n") == 0) | (F.col("first.row") == F.col("row"))).alias("kept"),
    )
