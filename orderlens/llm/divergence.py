"""Divergence between sources of one language, from term counts in hash-consed segment trees.

**Counts.** Tasks count terms on byte arrays and emit each distinct term once per group and million distinct terms; sums
are exact 64-bit numbers. A language keeps the terms that at least ``min_docs`` of its documents hold. Kept terms are
numbered by falling document frequency, so that rare terms, whose counts are mostly 0, 1 or 2, are neighbours.

**Trees.** The numbers of a language are cut in blocks of ``2 ** LEVELS`` terms. For a block, every group (and the language
itself) has a segment tree whose leaves are counts; nodes are hash-consed: two subtrees with the same counts, at whatever place
and of whichever group, are one node. Two groups are compared by a simultaneous walk from the roots that keeps a memo: an equal
pair of nodes is followed once, with the number of times it was met, and an equal pair of counts is priced once. Pairs of
groups are dealt in tiles of ``TILE`` sources, so a task holds one block of two tiles whatever the number of sources.

**Prices.** For count c of a group with N occurrences of V kept terms, p = 1 + floor(SCALE * (c + 2) / (N + 2 V)); a term is priced
f = floor((p - q)**2 / (p + q)). All arithmetic is on integers and does not overflow below 9 * 10**15 occurrences.

**Odd input.** Null text, lang and source are read as empty strings. A group without terms takes part with counts of zero.
A language that keeps no term gives its pairs the value 0 and has no term rows. Rows are documents, repeated or not. An empty table gives
no rows. Very long texts are counted whole. Only named columns are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.store import prepare, written
from orderlens.llm.terms import LETTERS, Terms
from orderlens.llm.words import slices
from orderlens.operators.ranking import global_rank

SCALE, LEVELS, TILE, HELD = 1_000_000_000, 12, 64, 1 << 20
_COUNTED = "lang string, source string, term string, n bigint, docs bigint"
_COUNTED_ARROW = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


# ---- counts -------------------------------------------------------------------------------------------------


class _Tally:
    """Occurrences and documents of (group, term); terms are known by hash, their text is kept once."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.texts: list[tuple[np.ndarray, pa.Array]] = []
        self.held = 0

    def add(self, batch: pa.RecordBatch) -> None:
        terms = Terms(batch.column("text"), LETTERS)
        names = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        group = np.array([self.groups.setdefault(k, len(self.groups)) for k in names], np.int64)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(terms.first))
        known, first, term = np.unique(terms.hashes, return_index=True, return_inverse=True)
        # Occurrences per document and term, then per group and term.
        pairs, n = np.unique((doc << 32) | term, return_counts=True)
        keys = (group[pairs >> 32] << 32) | (pairs & 0xFFFFFFFF)
        own, where = np.unique(keys, return_inverse=True)
        occurrences = np.bincount(where, weights=n, minlength=len(own)).astype(np.int64)
        docs = np.bincount(where, minlength=len(own)).astype(np.int64)
        self.parts.append((own >> 32, known[own & 0xFFFFFFFF], occurrences, docs))
        self.texts.append((known, terms.strings(first)))
        self.held += len(own)
        if len(self.parts) > 16 and self.held > HELD // 2:
            self.merge()

    def merge(self) -> None:
        """Equal keys of all parts become one."""
        group, term, n, docs = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((term, group))
        group, term = group[order], term[order]
        new = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (term[1:] != term[:-1])))) if len(order) else order
        n, docs = (np.add.reduceat(x[order], new) if len(new) else x for x in (n, docs))
        self.parts = [(group[new], term[new], n, docs)]
        hashes = np.concatenate([h for h, _ in self.texts])
        known, first = np.unique(hashes, return_index=True)
        self.texts = [(known, pa.concat_arrays([t for _, t in self.texts]).take(pa.array(first)))]
        self.held = len(new)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All sums, and one row without a term per group."""
        self.merge()
        (group, term, n, docs), (known, texts) = self.parts[0], self.texts[0]
        names = list(self.groups)
        lang, source = (pa.array([k[i] for k in names], pa.string()) for i in (0, 1))
        for a in range(0, len(group), 1 << 16):
            some = slice(a, a + (1 << 16))
            own = pa.array(group[some])
            yield pa.RecordBatch.from_arrays(
                [
                    lang.take(own), source.take(own), texts.take(pa.array(np.searchsorted(known, term[some]))).cast(pa.string()),
                    pa.array(n[some]), pa.array(docs[some]),
                ],
                schema=_COUNTED_ARROW,
            )
        zero = pa.array(np.zeros(len(names), np.int64))
        yield pa.RecordBatch.from_arrays([lang, source, pa.nulls(len(names), pa.string()), zero, zero], schema=_COUNTED_ARROW)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = _Tally()
    for whole in batches:
        for batch in slices(whole, "text"):
            tally.add(batch)
            if tally.held >= HELD or len(tally.groups) >= HELD:
                tally.merge()
                if tally.held >= HELD // 2 or len(tally.groups) >= HELD:
                    yield from tally.rows()
                    tally = _Tally()
    if tally.parts:
        yield from tally.rows()


@dataclass(frozen=True)
class Counts:
    """``groups``: lang, source, num (its number in the language), total, terms. ``terms``: the kept ones with lang, id (from
    0 in each language), term, lang_n. ``counts``: lang, source, id, n. ``langs``: lang, terms (kept), total, sources."""

    groups: DataFrame
    terms: DataFrame
    counts: DataFrame
    langs: DataFrame


def count_terms(docs: DataFrame, min_docs: int = 10) -> Counts:
    """Counts of the kept terms of ``docs`` (text, lang, source)."""
    prepare(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    sums = rows.mapInArrow(_counted, _COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    sums = written(sums, "terms")
    kept = sums.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = kept.where(F.col("docs") >= min_docs).withColumn("rare", -F.col("docs"))
    ranked = global_rank(kept, ["lang", "rare", "term"], "place")
    known = written(ranked.groupBy("lang").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("total")), "langs")
    numbered = ranked.join(known.select("lang", "start"), "lang")
    terms = written(numbered.select("lang", (F.col("place") - F.col("start")).alias("id"), "term", "lang_n"), "terms")
    counts = sums.where("term IS NOT NULL").join(terms, ["lang", "term"]).select("lang", "source", "id", "n")
    counts = written(counts, "counts")

    none = F.lit(0).cast("bigint")
    groups = global_rank(sums.where("term IS NULL").select("lang", "source"), ["lang", "source"], "place")
    per_lang = groups.groupBy("lang").agg(F.min("place").alias("from"), F.count(F.lit(1)).alias("sources"))
    langs = per_lang.join(known.drop("start"), "lang", "left").select(
        "lang", "from", "sources", F.coalesce("terms", none).alias("terms"), F.coalesce("total", none).alias("total")
    )
    langs = written(langs, "langs")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(langs.select("lang", "from", "terms"), "lang").join(totals, ["lang", "source"], "left").select(
        "lang", "source", (F.col("place") - F.col("from")).alias("num"), F.coalesce("total", none).alias("total"), "terms"
    )
    return Counts(written(groups, "groups"), terms, counts, langs.drop("from"))


# ---- prices -------------------------------------------------------------------------------------------------


def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """p of each count, exact: SCALE = 1000**3 is multiplied in step by step, so that nothing overflows."""
    below = np.asarray(total, np.int64) + 2 * terms
    left = np.asarray(count, np.int64) + 2
    out, left = left // below, left % below
    for _ in range(3):
        left = left * 1000
        out, left = out * 1000 + left // below, left % below
    return out + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f: below (10**9 + 1)**2 all steps fit in 64 bits."""
    return (p - q) ** 2 // (p + q)


class Forest:
    """Segment trees over the counts of one block, hash-consed level by level.

    ``roots`` holds the root of each row; ``children[k]`` the two nodes of every node of level k + 1; nodes of level 0 are
    ``values``, the different counts. Places beyond the last term hold -1, which costs nothing.
    """

    def __init__(self, counts: np.ndarray):
        width = 1 << max(int(counts.shape[1] - 1).bit_length(), 0)
        padded = np.full((len(counts), width), -1, np.int64)
        padded[:, : counts.shape[1]] = counts
        self.values, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(padded.shape)
        self.children: list[np.ndarray] = []
        while nodes.shape[1] > 1:
            pairs, found = np.unique((nodes[:, 0::2] << 32) | nodes[:, 1::2], return_inverse=True)
            self.children.append(np.column_stack((pairs >> 32, pairs & 0xFFFFFFFF)))
            nodes = found.reshape(len(counts), -1)
        self.roots = nodes[:, 0]

    def meetings(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Walk the trees of rows ``left`` and ``right`` at once: different pairs of counts that meet, as (number of
        the row pair, count, count, how often). An equal pair of nodes of one row pair is followed once."""
        which, times = np.arange(len(left)), np.ones(len(left), np.int64)
        a, b = self.roots[left], self.roots[right]
        for children in reversed(self.children):
            which, times = np.repeat(which, 2), np.repeat(times, 2)
            a, b = children[a].reshape(-1), children[b].reshape(-1)
            # Two tiles and the language: below 2**20 nodes a level.
            keys = (which << 40) | (a << 20) | b
            order = np.argsort(keys)
            keys = keys[order]
            at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            keys, times = keys[at], np.add.reduceat(times[order], at)
            which, a, b = keys >> 40, (keys >> 20) & 0xFFFFF, keys & 0xFFFFF
        return which, self.values[a], self.values[b], times


_PRICED = "lang string, num int, other int, term string, value bigint"
_PRICED_ARROW = pa.schema(
    [("lang", pa.string()), ("num", pa.int32()), ("other", pa.int32()), ("term", pa.string()), ("value", pa.int64())]
)


def _best(forest: Forest, counts: np.ndarray, lang: np.ndarray, totals: np.ndarray, terms: int, names: list[str], top: int):
    """Per row its ``top`` terms that are above the language's share, by price, then by the bytes of the term.

    Prices come from the walk of the group's tree beside the language's (the last row of the forest): one per pair of counts.
    """
    rows = np.arange(len(counts))
    which, a, b, _ = forest.meetings(rows, np.full(len(rows), len(rows)))
    edges = np.searchsorted(which, np.arange(len(rows) + 1))
    place = np.empty(len(names), np.int64)
    place[sorted(range(len(names)), key=lambda i: names[i].encode())] = np.arange(len(names))
    for row in rows:
        a_own, b_own = a[edges[row] : edges[row + 1]], b[edges[row] : edges[row + 1]]
        used = (a_own > 0) & (b_own > 0)
        a_own, b_own = a_own[used], b_own[used]
        p, q = shares(a_own, totals[row], terms), shares(b_own, totals[-1], terms)
        value = np.where(p > q, price(p, q), -1)
        at = np.flatnonzero(counts[row])
        # Each term finds the price of its pair of counts.
        met = {pair: v for pair, v in zip(zip(a_own.tolist(), b_own.tolist(), strict=True), value.tolist(), strict=True)}
        prices = np.array([met[pair] for pair in zip(counts[row][at].tolist(), lang[at].tolist(), strict=True)], np.int64)
        good = prices >= 0
        at, prices = at[good], prices[good]
        chosen = np.lexsort((place[at], -prices))[:top]
        yield row, at[chosen], prices[chosen]


def _priced(top: int):
    def run(counts: pa.Table, groups: pa.Table) -> pa.Table:
        if not counts.num_rows:
            return _PRICED_ARROW.empty_table()
        lang = groups.column("lang")[0].as_py()
        x, y = groups.column("x")[0].as_py(), groups.column("y")[0].as_py()
        groups = groups.sort_by("num")
        nums, totals = groups.column("num").to_numpy(), groups.column("total").to_numpy()
        terms, lang_total = groups.column("terms")[0].as_py(), groups.column("lang_total")[0].as_py()
        is_term = pc.is_valid(counts.column("term"))
        known, counts = counts.filter(is_term).sort_by("id"), counts.filter(pc.invert(is_term))
        ids, in_lang = known.column("id").to_numpy(), known.column("lang_n").to_numpy()
        names = known.column("term").to_pylist()
        own = np.zeros((len(nums), len(ids)), np.int64)
        rows = np.searchsorted(nums, counts.column("num").to_numpy())
        own[rows, np.searchsorted(ids, counts.column("id").to_numpy())] = counts.column("n").to_numpy()
        forest = Forest(np.vstack((own, in_lang)))
        out = []
        left, right = np.triu_indices(len(nums), 1)
        if x != y:  # two different tiles: pairs across them only
            across = nums[left] // TILE != nums[right] // TILE
            left, right = left[across], right[across]
        for a in range(0, len(left), 256):
            l, r = left[a : a + 256], right[a : a + 256]
            which, m, n, times = forest.meetings(l, r)
            real = m >= 0
            which, m, n, times = which[real], m[real], n[real], times[real]
            f = price(shares(m, totals[l][which], terms), shares(n, totals[r][which], terms)) * times
            sums = np.zeros(len(l), np.int64)
            np.add.at(sums, which, f)
            for p, q in ((l, r), (r, l)):
                out.append(
                    pa.table(
                        [pa.array([lang] * len(l)), pa.array(nums[p], pa.int32()), pa.array(nums[q], pa.int32()),
                         pa.nulls(len(l), pa.string()), pa.array(sums)],
                        schema=_PRICED_ARROW,
                    )
                )
        if x == y:
            for row, at, value in _best(forest, own, in_lang, np.append(totals, lang_total), terms, names, top):
                out.append(
                    pa.table(
                        [pa.array([lang] * len(at), pa.string()), pa.array([nums[row]] * len(at), pa.int32()),
                         pa.nulls(len(at), pa.int32()), pa.array([names[i] for i in at], pa.string()), pa.array(value, pa.int64())],
                        schema=_PRICED_ARROW,
                    )
                )
        return pa.concat_tables(out) if out else _PRICED_ARROW.empty_table()

    return run


def _blocks(counted: Counts) -> tuple[DataFrame, DataFrame]:
    """Counts and groups dealt to blocks of terms and pairs of tiles (x <= y)."""
    block = F.shiftright("id", LEVELS).alias("block")
    tile = F.shiftright("num", 6)
    tiles = F.floor((F.col("sources") - 1) / TILE)
    to = F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), tiles), lambda t: F.struct(F.least(t, F.col("tile")).alias("x"), F.greatest(t, F.col("tile")).alias("y"))))
    numbered = counted.groups.join(counted.langs.select("lang", "sources", F.col("total").alias("lang_total")), "lang").withColumn("tile", tile)
    numbered = numbered.withColumn("xy", to).select("*", "xy.x", "xy.y")
    at = ["lang", "block", "x", "y"]
    counts = counted.counts.select("*", block).join(numbered.select("lang", "source", "num", "x", "y"), ["lang", "source"])
    terms = counted.terms.select("*", block).join(numbered.select("lang", "x", "y").distinct(), "lang")
    both = counts.select(*at, "id", "num", "n").unionByName(terms.select(*at, "id", "term", "lang_n"), allowMissingColumns=True)
    last = F.shiftright(F.col("terms") - 1, LEVELS)
    groups = numbered.where("terms > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    # New names for the same columns: a cogroup of two frames of one origin needs them apart.
    return both, groups.select(*[F.col(c).alias(c) for c in (*at, "num", "total", "terms", "lang_total")])


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """Per group (lang, source): part ``pair`` with all other sources of the language, part ``term`` with its ``top`` terms.

    Columns lang, source, part, item, value, rank; ranks count from 1 by falling value, then by the bytes of the item.
    """
    counted = count_terms(docs, min_docs)
    counts, groups = _blocks(counted)
    keys = ["lang", "block", "x", "y"]
    priced = written(counts.groupBy(*keys).cogroup(groups.groupBy(*keys)).applyInArrow(_priced(top), _PRICED), "priced")
    own = counted.groups.select("lang", "source", "num")
    other = own.select("lang", F.col("source").alias("item"), F.col("num").alias("other"))
    sums = priced.where("term IS NULL").groupBy("lang", "num", "other").agg(F.sum("value").alias("value"))
    pairs = own.join(other, "lang").where("num <> other").join(sums, ["lang", "num", "other"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("bigint")).alias("value"))
    terms = priced.where("term IS NOT NULL").join(own, ["lang", "num"])
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.unionByName(terms).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))
