"""An interpolated modified Kneser-Ney bigram model over words.

Words are runs other than space and \\t \\n \\v \\f \\r, A-Z in lower case, then one end token per text; a start mark
stands before the first word. The model is counted by Spark and kept as sorted arrays in the shared folder:

* vocabulary shards: sorted 64-bit word hashes and token counts; a word's number is its place;
* bigram blocks, one per range of context numbers: sorted (context, word) keys, counts, and for each context the
  sum of its counts and how many of them are 1, 2 and more;
* continuation blocks: for each word, how many different contexts it has.

Workers map these files and look up whole batches by binary search. Discounts follow from the counts of counts of
either level, and the lower level interpolates with a uniform share over the vocabulary and one unknown word.

Tasks add up what they have before they shuffle it, so a frequent word or pair is a few rows. Null text counts as
empty (the end token alone); rows are scored one by one, so null or repeated ids do not matter; an empty training
set gives the uniform share over the unknown word alone. Counts have 64 bits; more distinct words than 32 bits can
number are refused with an error. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.store import fresh, mapped, prepare, put, written
from orderlens.llm.words import hashed_words, slices

END = np.uint64(0x0123456789ABCDEF)
WORDS_PER_SHARD, PAIRS_PER_BLOCK, HELD = 1 << 15, 1 << 20, 1 << 21
MOST_WORDS = (1 << 32) - 1  # and the start mark
_OPENED: dict[str, np.ndarray] = {}


def _file(address: str, kind: str) -> np.ndarray:
    if address not in _OPENED:
        if len(_OPENED) > 4096:
            _OPENED.clear()
        _OPENED[address] = mapped(address, kind)
    return _OPENED[address]


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end token included, and where each text starts (n + 1 places)."""
    h, first = hashed_words(column)
    n = len(first) - 1
    return np.insert(h, first[1:], END), first + np.arange(n + 1)


class Vocabulary:
    """shards: (first number, address of hashes, address of counts) in order; a shard holds one hash range."""

    def __init__(self, shards: list[tuple[int, str, str]], size: int, total: int):
        self.shards, self.size, self.total = shards, size, total

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: unknown) and count of each of the ascending hashes."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        step = (1 << 64) // max(1, len(self.shards))
        edges = np.array([i * step for i in range(len(self.shards))], np.uint64)
        cut = np.append(np.searchsorted(hashes, edges), len(hashes))
        for (base, own, counts), a, b in zip(self.shards, cut[:-1], cut[1:], strict=True):
            if a < b and own:
                table = _file(own, "<u8")
                at = np.minimum(np.searchsorted(table, hashes[a:b]), len(table) - 1)
                hit = table[at] == hashes[a:b]
                number[a:b] = np.where(hit, at + base, -1)
                count[a:b] = np.where(hit, _file(counts, "<i8")[at], 0)
        return number, count


def _power(n: int) -> int:
    return 1 << max(0, int(n - 1).bit_length())


def build_vocabulary(texts: DataFrame, folder: str) -> Vocabulary:
    spark = texts.sparkSession
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, c = np.empty(0, np.uint64), np.empty(0, np.int64)

        def merged(keys, values):
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
            head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return keys[head], np.add.reduceat(values, head)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], schema=schema)

        for whole in batches:
            for batch in slices(whole, "text"):
                own, times = np.unique(tokens(batch.column("text"))[0], return_counts=True)
                h, c = merged(np.concatenate((h, own)), np.concatenate((c, times)))
                if len(h) > HELD:
                    yield rows()
                    h, c = h[:0], c[:0]
        if len(h):
            yield rows()

    counts = written(texts.mapInArrow(count, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")), "lm-words")
    size, total = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    shards = _power(-(-size // WORDS_PER_SHARD))
    bits = shards.bit_length() - 1
    shard = F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)
    listed = pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("own", pa.string()), ("counts", pa.string())])

    def store(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        h, c = group["h"].to_numpy().view(np.uint64), group["c"].to_numpy()
        order = np.argsort(h)
        number = key[0].as_py()
        row = {"shard": number, "n": len(h), "own": put(folder, f"words-{number}", h[order].astype("<u8").tobytes()),
               "counts": put(folder, f"counts-{number}", c[order].astype("<i8").tobytes())}
        return pa.Table.from_pylist([row], schema=listed)

    kind = "shard int, n bigint, own string, counts string"
    manifest = written(counts.withColumn("shard", shard).groupBy("shard").applyInArrow(store, kind), "lm-shards").collect()
    by, out, base = {r["shard"]: r for r in manifest}, [], 0
    for i in range(shards if size else 0):
        r = by.get(i)
        out.append((base, r["own"], r["counts"]) if r else (base, "", ""))
        base += r["n"] if r else 0
    return Vocabulary(out, size, total)


def _numbers(vocabulary: Vocabulary, column: pa.Array):
    """Numbers and counts of all tokens, contexts (the start mark is the number after the last), text starts."""
    h, first = tokens(column)
    own, place = np.unique(h, return_inverse=True)
    number, count = vocabulary.find(own)
    word, times = number[place], count[place]
    context = np.empty_like(word)
    if len(word):
        context[1:] = word[:-1]
        context[first[:-1]] = vocabulary.size
    return word, times, context, first


class Model:
    """blocks: per range of context numbers the addresses of keys, counts and context sums; lower: of words."""

    def __init__(self, vocabulary: Vocabulary, blocks: dict, lower: dict, width: int, discounts, lower_discounts, lower_sums):
        self.vocabulary, self.blocks, self.lower, self.width = vocabulary, blocks, lower, width
        self.discounts, self.lower_discounts, self.lower_sums = discounts, lower_discounts, lower_sums

    def _ranged(self, files: dict, number: np.ndarray) -> Iterator[tuple[int, np.ndarray, tuple]]:
        """For ascending numbers: block, the places that fall in it, its files."""
        block = number // self.width
        edge = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(block) else np.empty(0, np.int64)
        for a, b in zip(edge, np.append(edge[1:], len(block)), strict=True):
            k = int(block[a])
            if k in files:
                yield k, np.arange(a, b), files[k]

    def word_share(self, word: np.ndarray) -> np.ndarray:
        """Lower-level probability of each of the ascending words (-1: unknown)."""
        total, n1, n2, n3 = self.lower_sums
        d1, d2, d3 = self.lower_discounts
        uniform = 1.0 / (self.vocabulary.size + 1)
        if not total:
            return np.full(len(word), uniform)
        count = np.zeros(len(word))
        start = int(np.searchsorted(word, 0))
        for k, at, (address,) in self._ranged(self.lower, word[start:]):
            count[start + at] = _file(address, "<i8")[word[start + at] - k * self.width]
        cut = np.choose(np.minimum(count, 3).astype(int), [0.0, d1, d2, d3])
        return (count - cut) / total + (d1 * n1 + d2 * n2 + d3 * n3) / total * uniform

    def log10(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """log10 probability of each word after its context."""
        own, place = np.unique(word, return_inverse=True)
        lower = self.word_share(own)[place]
        order = np.lexsort((word, context))
        c, w = context[order], word[order]
        count, sums = np.zeros(len(c)), np.zeros((len(c), 4))
        start = int(np.searchsorted(c, 0))
        for k, at, (keys, counts, stats) in self._ranged(self.blocks, c[start:]):
            at = at + start
            sums[at] = _file(stats, "<i8").reshape(-1, 4)[c[at] - k * self.width]
            table, known = _file(keys, "<u8"), at[w[at] >= 0]
            key = (c[known].astype(np.uint64) << np.uint64(32)) | w[known].astype(np.uint64)
            if len(table) and len(key):
                found = np.minimum(np.searchsorted(table, key), len(table) - 1)
                count[known] = np.where(table[found] == key, _file(counts, "<i8")[found], 0)
        d1, d2, d3 = self.discounts
        total = sums[:, 0]
        cut = np.choose(np.minimum(count, 3).astype(int), [0.0, d1, d2, d3])
        left = d1 * sums[:, 1] + d2 * sums[:, 2] + d3 * sums[:, 3]
        safe = np.maximum(total, 1)
        share = np.where(total > 0, (count - cut) / safe + left / safe * lower[order], lower[order])
        out = np.empty(len(word))
        out[order] = np.log10(share)
        return out


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many entries have counts of 1, 2, 3 and 4."""
    n1, n2, n3, n4 = (max(x, 0) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
        d = k - (k + 1) * y * b / a if a else y * k
        found.append(min(max(d, 0.05), k - 0.05))
    return tuple(found)


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted (context, word) keys and counts: contexts and their number of words, words, counts above 1."""
    context, word = (keys >> np.uint64(32)).astype("<u4"), keys.astype("<u4")
    own, times = np.unique(context, return_counts=True)
    many = np.flatnonzero(counts > 1)
    head = np.array([len(own), len(word), len(many)], "<u4")
    return b"".join(x.astype("<u4").tobytes() for x in (head, own, times, word, many, counts[many]))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(data, "<u4")
    a, b, c = (int(v) for v in x[:3])
    own, times, word, many, more = np.split(x[3:], np.cumsum([a, a, b, c]))
    counts = np.ones(b, np.uint32)
    counts[many] = more
    return (np.repeat(own, times).astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64), counts


def train(texts: DataFrame) -> Model:
    """Count a model over the column ``text`` of all rows."""
    spark = texts.sparkSession
    prepare(spark)
    folder = fresh(spark, "lm")
    vocabulary = build_vocabulary(texts, folder)
    if vocabulary.size >= MOST_WORDS:
        raise ValueError(f"{vocabulary.size} distinct words: a key holds two word numbers of 32 bits")
    blocks = _power(-(-vocabulary.total // PAIRS_PER_BLOCK))
    width = -(-(vocabulary.size + 1) // blocks)
    shared = spark.sparkContext.broadcast(vocabulary)
    sent = pa.schema([("block", pa.int32()), ("data", pa.binary())])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def rows() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            edges = np.arange(1, blocks, dtype=np.uint64) * np.uint64(width) << np.uint64(32)
            cut = np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))
            for k in np.flatnonzero(np.diff(cut)).tolist():
                part = slice(cut[k], cut[k + 1])
                yield pa.RecordBatch.from_pylist([{"block": k, "data": _packed(keys[part], counts[part])}], schema=sent)
            held.clear()

        for whole in batches:
            for batch in slices(whole, "text"):
                word, _, context, _ = _numbers(shared.value, batch.column("text"))
                held.append((context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64))
                if sum(map(len, held)) > HELD:
                    yield from rows()
        if held:
            yield from rows()

    names = ["block", "keys", "counts", "stats", "of", "data", "n"]
    longs = pa.list_(pa.int64())
    kinds = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.binary(), longs]
    made = pa.schema(list(zip(names, kinds, strict=True)))

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, keys, counts = key[0].as_py(), np.empty(0, np.uint64), np.empty(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def fold():
            nonlocal keys, counts
            a = np.concatenate([keys, *(x for x, _ in waiting)])
            b = np.concatenate([counts, *(y for _, y in waiting)]).astype(np.int64)
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            head = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
            keys, counts = a[head], np.add.reduceat(b, head)
            waiting.clear()

        for batch in batches:
            waiting.extend(_unpacked(x) for x in batch.column("data").to_pylist())
            if sum(len(x) for x, _ in waiting) > HELD:
                fold()
        fold()
        row = (keys >> np.uint64(32)).astype(np.int64) - k * width
        stats = np.zeros((width, 4), np.int64)
        np.add.at(stats[:, 0], row, counts)
        for column, use in enumerate((counts == 1, counts == 2, counts > 2), start=1):
            stats[:, column] = np.bincount(row[use], minlength=width)
        head = {
            "block": k, "n": [int((counts == i).sum()) for i in (1, 2, 3, 4)],
            "keys": put(folder, f"pairs-{k}", keys.astype("<u8").tobytes()),
            "counts": put(folder, f"pair-counts-{k}", counts.astype("<i8").tobytes()),
            "stats": put(folder, f"contexts-{k}", stats.astype("<i8").tobytes()),
        }
        yield pa.RecordBatch.from_pylist([head], schema=made)
        # How many contexts of this block each word has, cut by the words' own blocks.
        word, times = np.unique(keys & np.uint64(0xFFFFFFFF), return_counts=True)
        block = (word // np.uint64(width)).astype(np.int64)
        for j in np.unique(block).tolist():
            use = block == j
            data = np.concatenate((word[use], times[use].astype(np.uint64))).astype("<u4").tobytes()
            yield pa.RecordBatch.from_pylist([{"block": k, "of": j, "data": data}], schema=made)

    kind = "block int, keys string, counts string, stats string, of int, data binary, n array<bigint>"
    merged = written(texts.mapInArrow(pairs, "block int, data binary").groupBy("block").applyInArrow(merge, kind), "lm-blocks")
    heads = merged.where("of IS NULL").select("block", "keys", "counts", "stats", "n").collect()
    listed = pa.schema([("of", pa.int32()), ("address", pa.string()), ("n", longs)])

    def lower(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        j, sums = key[0].as_py(), np.zeros(width, np.int64)
        for batch in batches:
            for data in batch.column("data").to_pylist():
                word, times = np.split(np.frombuffer(data, "<u4").astype(np.int64), 2)
                sums[word - j * width] += times
        n = [int((sums == i).sum()) for i in (1, 2, 3, 4)] + [int(sums.sum()), int((sums > 2).sum())]
        row = {"of": j, "n": n, "address": put(folder, f"lower-{j}", sums.astype("<i8").tobytes())}
        yield pa.RecordBatch.from_pylist([row], schema=listed)

    below = merged.where("of IS NOT NULL").select("of", "data").groupBy("of").applyInArrow(lower, "of int, address string, n array<bigint>")
    lows = written(below, "lm-lower").collect()
    pair_n = [sum(r["n"][i] for r in heads) for i in range(4)]
    low_n = [sum(r["n"][i] for r in lows) for i in range(6)]
    return Model(
        vocabulary,
        {r["block"]: (r["keys"], r["counts"], r["stats"]) for r in heads},
        {r["of"]: (r["address"],) for r in lows},
        width,
        discounts(pair_n),
        discounts(low_n[:4]),
        (low_n[4], low_n[0], low_n[1], low_n[5]),
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, unigram (add-0.1 log10 probability), score (the model's)."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "n_tokens", "n_known", "unigram", "score"]
    schema = pa.schema(list(zip(names, [pa.int64()] * 3 + [pa.float64()] * 2, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        v, n = own.vocabulary.size, own.vocabulary.total
        for whole in batches:
            for batch in slices(whole, "text"):
                word, times, context, first = _numbers(own.vocabulary, batch.column("text"))
                k = batch.num_rows
                text = np.repeat(np.arange(k), np.diff(first))
                base = np.log10((times + 0.1) / (n + 0.1 * (v + 1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.diff(first)), pa.array(np.bincount(text, times > 0, k).astype(np.int64)),
                     pa.array(np.bincount(text, base, k)), pa.array(np.bincount(text, own.log10(word, context), k))],
                    schema=schema,
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, unigram double, score double")


def perplexity(scored: DataFrame) -> Column:
    """Perplexity of a scored text."""
    return F.pow(F.lit(10.0), -scored["score"] / scored["n_tokens"])
