"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are positives; everything else, whatever its label, is unlabelled text that holds toxic
texts too. With the class prior p the risk of a classifier is p * R(positives as 1) plus
max(0, R(unlabelled as 0) - p * R(positives as 0)): the second part corrects for toxic texts among the
unlabelled and is kept from turning negative. The classifiers are logistic models in numpy, a few of different
seeds whose scores are averaged, over the presence of words and of five-byte sequences in lower case.

Features are hashed into tables of fixed size. Which ones count is decided from document counts of the training
sample, added up by Spark. The sample is bounded by parameters (``positives``, ``unlabelled``): ids are taken in
the order of their hash, so it does not depend on how the data lies, and each id is learned from once, whatever
the number of its rows. Scoring covers all texts; a text goes to the Python worker once and does not come back.

Null and empty texts have no features and get the score of the intercept; a very long text is scored as a whole, alone
in its slice of a batch. Repeated ids are scored row by row, and the largest of their texts is learned from; null ids
are scored but never learned from. Without any positive row every score is the prior, 0; an empty table gives an
empty result. Further columns are passed on; an input column named like the result is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.store import added, prepare, written
from orderlens.llm.vectors import parts, total
from orderlens.llm.words import _LOWER, slices, span_hashes, text_bytes

BITS, GRAM = 18, 5
SIZE = 2 << BITS  # words in the first half, byte sequences in the second
_IN_WORD = np.zeros(256, bool)
_IN_WORD[128:] = True
_IN_WORD[48:58] = True
_IN_WORD[97:123] = True


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every occurrence."""
    data, starts = text_bytes(column, GRAM)
    data = _LOWER[data]
    inside = _IN_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    a, b = edges[0::2], edges[1::2]
    words = (span_hashes(data, a, b) >> np.uint64(64 - BITS)).astype(np.int64)
    n = len(data) - GRAM + 1
    if n > 0:
        with np.errstate(over="ignore"):
            g = np.zeros(n, np.uint32)
            for k in range(GRAM):
                g = (g + data[k : k + n]) * np.uint32(0x9E3779B1)
        ok = np.ones(n, bool)
        for k in range(GRAM):
            ok &= inside[k : k + n]
        at = np.flatnonzero(ok)
        grams = (g[at] >> np.uint32(32 - BITS)).astype(np.int64) + (1 << BITS)
    else:
        at = grams = np.empty(0, np.int64)
    place = np.concatenate((a, at))
    return np.searchsorted(starts, place, side="right") - 1, np.concatenate((words, grams))


def _present(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, table entry) once per text, for features whose entry is not negative."""
    doc, feature = features(column)
    entry = table[feature]
    use = entry >= 0
    key = np.unique(doc[use] * np.int64(SIZE) + entry[use])
    return key // SIZE, key % SIZE


def train(docs: list[np.ndarray], positive: np.ndarray, n: int, prior: float, seed: int, least_steps: int = 1500):
    """A logistic model under the non-negative risk. docs: feature numbers of each text. Weights and intercept."""
    rng = np.random.default_rng(seed)
    pos, unl = np.flatnonzero(positive), np.flatnonzero(~positive)
    w = np.zeros(n + 1)
    w[n] = np.log(prior / (1 - prior))
    m, v, t = np.zeros(n + 1), np.zeros(n + 1), 0
    sizes = np.array([len(d) for d in docs])
    steps = max(1, len(unl) // 512)
    epochs = max(20, -(-least_steps // steps))

    def part(rows: np.ndarray):
        idx = np.concatenate([docs[i] for i in rows]) if len(rows) else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(rows)), sizes[rows])
        z = np.bincount(owner, w[idx], len(rows)) + w[n]
        return idx, owner, 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradient(idx, owner, slope):
        g = np.bincount(idx, slope[owner], n + 1)
        g[n] = slope.sum()
        return g

    for _ in range(epochs):
        rng.shuffle(unl)
        for u in np.array_split(unl, steps):
            p = rng.choice(pos, min(len(pos), 256), replace=False)
            pi, po, ps = part(p)
            ui, uo, us = part(u)
            as_one = gradient(pi, po, (ps - 1) / len(p))
            as_zero = gradient(pi, po, ps / len(p))
            unl_zero = gradient(ui, uo, us / len(u))
            low = np.log1p(-np.minimum(us, 1 - 1e-9))
            negative_part = -low.mean() + prior * np.log1p(-np.minimum(ps, 1 - 1e-9)).mean()
            if negative_part >= 0:
                g = prior * as_one + unl_zero - prior * as_zero
            else:  # the corrected part is too small already: step back up
                g = prior * as_zero - unl_zero
            g[:n] += 1e-4 * w[:n]
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= 0.03 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:n], w[n]


def calibrated(docs: list[np.ndarray], positive: np.ndarray, prior: float, w: np.ndarray, b: float, most: float):
    """The model, its intercept lowered where scores of unlabelled texts average above ``most`` times the class prior.

    With few positives the weights may separate them from everything and leave the intercept anywhere.
    """
    z = np.array([w[d].sum() for d, p in zip(docs, positive, strict=True) if not p])
    low, high = -60.0, 60.0
    for _ in range(60):
        at = (low + high) / 2
        over = (1 / (1 + np.exp(-np.clip(z + at, -30, 30)))).mean() > most * prior
        low, high = (low, at) if over else (at, high)
    return w, min(b, low)


class Model:
    """``weights``: one row per classifier over the chosen features; ``table``: feature to its place, or -1."""

    def __init__(self, table: np.ndarray, weights: np.ndarray, intercepts: np.ndarray, prior: float):
        self.table, self.weights, self.intercepts, self.prior = table, weights, intercepts, prior

    def scores(self, column: pa.Array) -> np.ndarray:
        n = len(column)
        if not len(self.intercepts):
            return np.full(n, self.prior)
        doc, entry = _present(column, self.table)
        out = np.zeros(n)
        for w, b in zip(self.weights, self.intercepts, strict=True):
            z = np.bincount(doc, w[entry], n) + b
            out += 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out / len(self.intercepts)


def fit(
    docs: DataFrame, labels: DataFrame, learnable: Column, positives: int = 8_000, unlabelled: int = 16_000,
    chosen: int = 3_000, classifiers: int = 3, most_unlabelled: float | None = 1.5,
) -> Model:
    """learnable: a condition on ``doc_id`` for rows that may be learned from.

    most_unlabelled: see ``calibrated``; None leaves the intercepts as they were trained.
    """
    spark = docs.sparkSession
    prepare(spark)
    order = F.xxhash64("doc_id")
    known = labels.where(learnable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    counts = known.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("int"))).first()
    if not counts[1]:
        return Model(np.empty(0, np.int32), np.empty((0, 0)), np.empty(0), 0.0)
    prior = min(0.9, counts[1] / counts[0])
    pos_rows = known.where("toxic = 1").select("doc_id").distinct().orderBy(order, "doc_id").limit(positives).collect()
    pos = spark.createDataFrame(pos_rows, "doc_id bigint").withColumn("p", F.lit(True))
    learn = docs.where(learnable & F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    line = min((1 << 63) - 1, int(unlabelled / max(1, learn.count()) * (1 << 63)))
    some = learn.join(F.broadcast(pos), "doc_id", "left").select(
        "doc_id", "text", F.coalesce("p", F.lit(False)).alias("p"), (F.shiftrightunsigned(order, 1) <= line).alias("u")
    )
    of_id = some.where("p OR u").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("p").alias("p"), F.max("u").alias("u"))
    sample = written(of_id.select("text", "p", "u"), "toxicity-texts")
    n_pos, n_unl = (max(1.0, float(x or 0)) for x in sample.agg(F.sum(F.col("p").cast("int")), F.sum(F.col("u").cast("int"))).first())
    counted = pa.schema([("part", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(2 * SIZE, np.uint32)
        everything = np.arange(SIZE)
        for whole in batches:
            for batch in slices(whole, "text"):
                doc, feature = _present(batch.column("text"), everything)
                for side, name in enumerate("pu"):
                    use = batch.column(name).to_numpy(zero_copy_only=False)[doc]
                    df[side * SIZE : (side + 1) * SIZE] += np.bincount(feature[use], minlength=SIZE).astype(np.uint32)
        for row in parts(df):
            yield pa.RecordBatch.from_pylist([row], schema=counted)

    df = total(sample.mapInArrow(count, "part int, counts binary"), 2 * SIZE).astype(np.float64)
    in_pos, in_unl = df[:SIZE], df[SIZE:]
    both = (in_pos + in_unl + 1) / (n_pos + n_unl + 2)
    gap = (in_pos / n_pos - in_unl / n_unl) / np.sqrt(both * (1 - np.minimum(both, 0.999)) * (1 / n_pos + 1 / n_unl))
    gap[in_pos + in_unl < 3] = 0
    best = np.argsort(-np.abs(gap), kind="stable")[:chosen]
    best = np.sort(best[np.abs(gap[best]) > 4])
    table = np.full(SIZE, -1, np.int32)
    table[best] = np.arange(len(best), dtype=np.int32)
    drawn = pa.schema([("p", pa.bool_()), ("u", pa.bool_()), ("f", pa.binary())])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                doc, entry = _present(batch.column("text"), table)
                cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
                f = [entry[a:b].astype("<u2").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("p"), batch.column("u"), pa.array(f, pa.binary())], schema=drawn)

    got = sample.mapInArrow(draw, "p boolean, u boolean, f binary").toArrow()
    texts, positive = [], []
    for f, p, u in zip(got["f"].to_pylist(), got["p"].to_pylist(), got["u"].to_pylist(), strict=True):
        entry = np.frombuffer(f, "<u2").astype(np.int64)
        for side in ([True] if p else []) + ([False] if u else []):
            texts.append(entry)
            positive.append(side)
    order_ = sorted(range(len(texts)), key=lambda i: (positive[i], texts[i].tobytes()))
    texts, positive = [texts[i] for i in order_], np.array([positive[i] for i in order_], bool)
    fits = []
    if positive.any() and (~positive).any():
        for seed in range(classifiers):
            w, b = train(texts, positive, len(best), prior, seed)
            fits.append(calibrated(texts, positive, prior, w, b, most_unlabelled) if most_unlabelled else (w, b))
    return Model(table, np.array([w for w, _ in fits]), np.array([b for _, b in fits]), prior)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """The input's columns and the score in a column ``out``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], names=["t"])
        return pa.array(np.concatenate([shared.value.scores(x.column("t")) for x in slices(batch, "t")] or [np.empty(0)]), pa.float64())

    # Nondeterministic to the optimizer, so that it is called once per row, however the score is used.
    scorer = F.arrow_udf(run, "double").asNondeterministic()
    return docs.select("*", scorer(F.col(text).cast("string")).alias(added(docs, out)))
