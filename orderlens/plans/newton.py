"""Logistic regression by Newton steps for a whole grid of models at once.

One pass over the rows gives loss, gradient and Hessian of every strength and inner fold that is still open; one strength goes
ahead and the others start at its optimum. Tasks sum small matrices in numpy and send one row each, sums are added on executors until at most ``MOST_SUMS`` reach the driver. A model with
d inputs costs d * d numbers, whatever the rows. A step that makes a model's loss larger is halved, so all models converge.

``fit_users`` fits the same with one intercept per user. For given common coefficients a user's intercept depends on the user's own
rows alone, so tasks solve it where the rows are and hand on gradient and Hessian with the intercepts eliminated (a Schur
complement). No vector has an entry per user, on the driver or anywhere else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_SUMS = 32
PASSES, TOLERANCE = 60, 1e-11
CHUNK = 2048  # rows whose products of inputs are held at once
_SUMS = "part int, sums binary"
_SUMS_ARROW = pa.schema([("part", pa.int32()), ("sums", pa.binary())])


# ---- sums over tasks ----------------------------------------------------------------------------------------


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, part = None, 0
    for batch in batches:
        for row in batch.to_pylist():
            own = np.frombuffer(row["sums"])
            total, part = own.copy() if total is None else total + own, row["part"]
    if total is not None:
        yield pa.RecordBatch.from_pylist([{"part": part, "sums": total.tobytes()}], schema=_SUMS_ARROW)


def summed(rows: DataFrame, function: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``function`` over all batches of rows: a vector of ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += function(batch)
        yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId() % MOST_SUMS, "sums": total.tobytes()}], schema=_SUMS_ARROW)

    parts = rows.mapInArrow(run, _SUMS)
    if rows.rdd.getNumPartitions() > MOST_SUMS:
        parts = parts.groupBy("part").applyInArrow(_added, _SUMS)
    return sum((np.frombuffer(r["sums"]) for r in parts.collect()), np.zeros(size))


def _list(column: pa.Array, rows: int, kind=np.float64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(rows, -1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


# ---- steps --------------------------------------------------------------------------------------------------


class Steps:
    """Newton iterations of many models of one width. ``ridge`` (models x width) is the penalty of each coefficient."""

    def __init__(self, ridge: np.ndarray):
        self.ridge = ridge
        self.at = np.zeros(ridge.shape)  # the best point so far
        self.trial = np.zeros(ridge.shape)
        self.loss = np.full(len(ridge), np.inf)
        self.open = np.ones(len(ridge), bool)

    def update(self, models: np.ndarray, loss: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, close: bool = True) -> None:
        """Sums at the trial points of some models: accept and step on, or go half way back. Unless ``close``, none ends here."""
        for i, m in enumerate(models):
            value = loss[i] + 0.5 * (self.ridge[m] * self.trial[m] ** 2).sum()
            if value > self.loss[m] + 1e-9 * abs(value) and np.abs(self.trial[m] - self.at[m]).max() > 1e-12:
                self.trial[m] = 0.5 * (self.trial[m] + self.at[m])
                continue
            self.at[m], self.loss[m] = self.trial[m], value
            g = gradient[i] + self.ridge[m] * self.at[m]
            h = hessian[i] + np.diag(self.ridge[m])
            step = np.linalg.lstsq(h, g, rcond=1e-13)[0]  # a column without rows of its own stays where it is
            if close and g @ step <= TOLERANCE * max(1.0, abs(value)):
                self.open[m] = False
            else:
                self.trial[m] = self.at[m] - step


# ---- plain models -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LinearModel:
    coefficients: np.ndarray
    intercept: float

    def margin(self, features: str = "features") -> Column:
        terms = (F.get(features, i) * float(c) for i, c in enumerate(self.coefficients))
        return sum(terms, F.lit(float(self.intercept)))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", (self.margin() > 0).cast("double"))


def in_blocks(rows: DataFrame) -> DataFrame:
    """Training rows as compressed matrices of a batch each: columns are inputs, label, weight, inner; ``width`` counts the inputs.

    Every pass reads all rows. A row's numbers go to Python one by one only here, and flags take next to no room.
    """
    schema = pa.schema([("n", pa.int32()), ("width", pa.int32()), ("block", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _list(batch.column("features"), batch.num_rows)
                others = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight", "inner")]
                block = pa.compress(np.vstack([x.T, *others]).tobytes(), codec="lz4_raw", asbytes=True)
                one = [[batch.num_rows], [x.shape[1]], [block]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(one, schema, strict=True)], schema=schema)

    return rows.select("features", "label", "weight", "inner").mapInArrow(run, "n int, width int, block binary")


def _matrices(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for n, width, block in zip(*(batch.column(c) for c in ("n", "width", "block")), strict=True):
        n, rows = n.as_py(), width.as_py() + 3
        yield np.frombuffer(pa.decompress(block.as_buffer(), 8 * n * rows, "lz4_raw")).reshape(rows, n)


def _half_products(x: np.ndarray) -> np.ndarray:
    """Products of two inputs (inputs x rows), each pair once, by rows of the upper triangle."""
    n, out, at = len(x), np.empty((len(x) * (len(x) + 1) // 2, x.shape[1])), 0
    for i in range(n):
        np.multiply(x[i], x[i:], out=out[at : at + n - i])
        at += n - i
    return out


def fit_grid(rows: DataFrame, width: int | None, folds: int, strengths: list[float]) -> tuple[list[LinearModel], np.ndarray]:
    """One model per strength C over all rows, and the mean held-out accuracy of each strength.

    ``rows``: features (array of ``width`` doubles, counted where None), label, weight, inner (fold number). They are read once.
    Minimised is the weighted loss plus |coefficients|**2 / (2 C); the intercept is free. With one strength nothing is held out.
    """
    blocks = in_blocks(rows).persist()
    try:
        if width is None:
            first = blocks.select("width").first()
            if first is None:
                raise ValueError("no rows to train on")
            width = first["width"]
        return _fit_blocks(blocks, width, folds, strengths)
    finally:
        blocks.unpersist()


def _fit_blocks(blocks: DataFrame, width: int, folds: int, strengths: list[float]) -> tuple[list[LinearModel], np.ndarray]:
    """``fit_grid`` over cached blocks.

    The model of the middle strength over all rows is fitted first. All others start at its optimum, where one set of sums per
    held-out fold serves every strength, and go on by steps of their own; on many rows one or two are left.
    """
    held = [None, *range(folds)] if len(strengths) > 1 else [None]
    models = [(k, c) for k in held for c in strengths]
    ridge = np.array([[1 / c] * width + [0.0] for _, c in models])
    n = width + 1
    accuracy = np.full(len(models), np.nan)
    upper = np.triu_indices(n)
    each = 3 + n + len(upper[0])

    def measured(points: np.ndarray, which: list[int], folds_out: list[int | None]) -> list[np.ndarray]:
        """Loss, hits, tested, gradient and Hessian at ``points[which[i]]`` over all rows but those of ``folds_out[i]``."""
        apart = np.array([-1 if k is None else k for k in folds_out])

        def some_rows(block: np.ndarray) -> np.ndarray:
            x, (label, weight, inner) = np.vstack((block[:-3], np.ones(block.shape[1]))), block[-3:]
            if np.isnan(x).any():
                raise ValueError("a training row has an input without a value")
            z = x.T @ points.T
            p = _sigmoid(z)
            aside = inner[:, None] == apart
            w = np.where(aside, 0.0, weight[:, None])
            tested = np.where(aside, weight[:, None], 0.0)
            out = np.empty((len(which), each))
            out[:, 0] = (w * (np.logaddexp(0, z) - label[:, None] * z)[:, which]).sum(axis=0)
            out[:, 1] = (tested * ((z > 0) == (label > 0)[:, None])[:, which]).sum(axis=0)
            out[:, 2] = tested.sum(axis=0)
            out[:, 3 : 3 + n] = (w * (p - label[:, None])[:, which]).T @ x.T
            # Products of two inputs once for all models: their Hessians are one matrix product.
            out[:, 3 + n :] = (_half_products(x) @ (w * (p * (1 - p))[:, which])).T
            return out

        def sums(batch: pa.RecordBatch) -> np.ndarray:
            parts = (some_rows(block[:, a : a + CHUNK]) for block in _matrices(batch) for a in range(0, block.shape[1], CHUNK))
            return sum(parts, np.zeros((len(which), each))).reshape(-1)

        total = summed(blocks, sums, len(which) * each).reshape(len(which), each)
        hessian = np.empty((len(which), n, n))
        hessian[:, upper[0], upper[1]] = hessian[:, upper[1], upper[0]] = total[:, 3 + n :]
        return [total[:, 0], total[:, 1], total[:, 2], total[:, 3 : 3 + n], hessian]

    steps = Steps(ridge)
    if len(held) > 1:
        lead = Steps(ridge[[len(strengths) // 2]])
        for _ in range(PASSES):
            loss, _, _, gradient, hessian = measured(lead.trial, [0] * len(held), held)
            lead.update(np.array([0]), loss[:1], gradient[:1], hessian[:1])
            if not lead.open[0]:
                break
        steps.trial[:] = lead.at
        if not lead.open[0]:  # these sums were taken at its optimum; every other model leaves it by a step of its own
            own = np.repeat(np.arange(len(held)), len(strengths))
            steps.update(np.arange(len(models)), loss[own], gradient[own], hessian[own], close=False)
    for _ in range(PASSES):
        chosen = np.flatnonzero(steps.open)
        if not len(chosen):
            break
        loss, hits, tested, gradient, hessian = measured(steps.trial[chosen], list(range(len(chosen))), [models[m][0] for m in chosen])
        steps.update(chosen, loss, gradient, hessian)
        done = ~steps.open[chosen]  # these sums were taken at the accepted points
        with np.errstate(invalid="ignore"):
            accuracy[chosen[done]] = hits[done] / tested[done]
    fitted = [LinearModel(steps.at[m][:width], float(steps.at[m][width])) for m in range(len(strengths))]
    if len(held) == 1:
        return fitted, np.full(len(strengths), np.nan)
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)  # no rows held out at all
        return fitted, np.nanmean(accuracy[len(strengths) :].reshape(folds, -1), axis=0)


# ---- models with an intercept per user ----------------------------------------------------------------------


@dataclass(frozen=True)
class UserModel:
    """Lag coefficients and intercept of one outer fold, with the strength that was chosen."""

    theta: np.ndarray
    strength: float
    accuracy: float
    equal: int
    n: int


def _effects(n: np.ndarray, y: np.ndarray, base: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """Every user's intercept for every strength: n, y are users x patterns, base is strengths x patterns."""
    u = np.zeros((len(n), len(base)))
    open_ = np.arange(len(n))
    for _ in range(80):
        own, some = u[open_], n[open_, None]
        p = _sigmoid(own[:, :, None] + base[None])
        g = (some * p - y[open_, None]).sum(axis=2) + own / strength
        h = (some * p * (1 - p)).sum(axis=2) + 1 / strength
        step = np.clip(g / h, -2, 2)
        u[open_] = own - step
        open_ = open_[np.abs(step).max(axis=1) >= 1e-10]
        if not len(open_):
            break
    return u


def pattern_inputs(lags: int) -> np.ndarray:
    """Inputs of each lag pattern: its bits, then 1."""
    bits = (np.arange(1 << lags)[:, None] >> np.arange(lags)) & 1
    return np.column_stack((bits, np.ones(1 << lags))).astype(float)


def _counts(batch: pa.RecordBatch, folds: int, patterns: int) -> tuple[np.ndarray, np.ndarray]:
    """Per user: rows by (outer fold, pattern, label), and the inner fold of each (pattern, label)."""
    rows = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("cells").offsets.to_numpy()))
    flat = batch.column("cells").flatten()
    cell, n, inner = (flat.field(f).to_numpy() for f in ("cell", "n", "inner"))
    count = np.zeros((batch.num_rows, (folds + 1) * patterns * 2))
    count[rows, cell] = n
    where = np.full((batch.num_rows, patterns * 2), -1)
    where[rows, cell % (patterns * 2)] = inner
    return count.reshape(-1, folds + 1, patterns, 2), where.reshape(-1, patterns, 2)


def fit_users(cells: DataFrame, lags: int, folds: int, inner_folds: int, strengths: list[float]) -> dict[int, UserModel]:
    """The chosen model of every outer fold; fold f trains on smaller numbers and tests on its own.

    ``cells``: one row per user with ``cells``, an array of (cell, n, inner): the number of rows n of the user in cell =
    (fold * patterns + pattern) * 2 + label. Penalised are lag coefficients and user intercepts, not the common one.
    """
    x, patterns, width = pattern_inputs(lags), 1 << lags, lags + 1
    held = [None, *range(inner_folds)] if len(strengths) > 1 else [None]
    groups = [(f, k) for f in range(1, folds + 1) for k in held]
    s = len(strengths)
    strength = np.array(strengths, float)
    ridge = np.array([[1 / c] * lags + [0.0] for _ in groups for c in strengths])
    steps = Steps(ridge)
    hits, tested = np.zeros(len(ridge)), np.zeros(len(ridge))
    each = 3 + width + width * width
    for _ in range(PASSES):
        todo = [g for g in range(len(groups)) if steps.open[g * s : g * s + s].any()]
        if not todo:
            break
        theta = steps.trial.reshape(len(groups), s, width)[todo]

        def sums(batch: pa.RecordBatch) -> np.ndarray:
            count, inner = _counts(batch, folds, patterns)
            out = np.zeros((len(todo), s, each))
            for i, g in enumerate(todo):
                fold, out_fold = groups[g]
                train = count[:, :fold].sum(axis=1)
                test = count[:, fold]
                if out_fold is not None:
                    test, train = np.where(inner == out_fold, train, 0), np.where(inner == out_fold, 0, train)
                some = train.sum(axis=(1, 2)) + test.sum(axis=(1, 2)) > 0
                train, test = train[some], test[some]
                n, y = train.sum(axis=2), train[:, :, 1]
                base = theta[i] @ x.T
                u = _effects(n, y, base, strength)
                z = u[:, :, None] + base[None]
                p = _sigmoid(z)
                w = n[:, None] * p * (1 - p)
                residual = n[:, None] * p - y[:, None]
                own = w.sum(axis=2) + 1 / strength
                cross = w @ x
                out[i, :, 0] = (n[:, None] * np.logaddexp(0, z) - y[:, None] * z).sum(axis=(0, 2)) + (u**2 / (2 * strength)).sum(axis=0)
                out[i, :, 1] = np.where(z > 0, test[:, None, :, 1], test[:, None, :, 0]).sum(axis=(0, 2))
                out[i, :, 2] = test.sum()
                out[i, :, 3 : 3 + width] = (residual @ x).sum(axis=0)
                pairs = (x[:, :, None] * x[:, None, :]).reshape(patterns, -1)
                by_model = cross.transpose(1, 0, 2)
                hessian = (w.sum(axis=0) @ pairs).reshape(s, width, width)
                hessian -= (by_model / own.T[:, :, None]).transpose(0, 2, 1) @ by_model
                out[i, :, 3 + width :] = hessian.reshape(s, -1)
            return out.reshape(-1)

        total = summed(cells, sums, len(todo) * s * each).reshape(-1, each)
        models = np.array([g * s + j for g in todo for j in range(s)])
        live = steps.open[models]
        models, total = models[live], total[live]
        steps.update(models, total[:, 0], total[:, 3 : 3 + width], total[:, 3 + width :].reshape(-1, width, width))
        hits[models], tested[models] = total[:, 1], total[:, 2]
    out = {}
    with np.errstate(invalid="ignore", divide="ignore"):
        share = (hits / tested).reshape(len(groups), s)
    for f in range(1, folds + 1):
        at = [i for i, (fold, _) in enumerate(groups) if fold == f]
        inner_share = share[at[1:]]
        usable = inner_share[~np.isnan(inner_share).any(axis=1)]
        best = int(np.argmax(usable.mean(axis=0))) if len(usable) else 0
        m = at[0] * s + best
        accuracy = float(hits[m] / tested[m]) if tested[m] else float("nan")
        out[f] = UserModel(steps.at[m].copy(), strengths[best], accuracy, int(hits[m]), int(tested[m]))
    return out


def user_effects(cells: DataFrame, model: UserModel, lags: int, folds: int, fold: int) -> DataFrame:
    """``(user_id, effect)`` of a fitted model, solved from each user's training rows."""
    x, patterns = pattern_inputs(lags), 1 << lags
    kind = cells.schema["user_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, _ = _counts(batch, folds, patterns)
            train = count[:, :fold].sum(axis=1)
            effect = _effects(train.sum(axis=2), train[:, :, 1], (model.theta @ x.T)[None], np.array([model.strength]))
            yield pa.RecordBatch.from_arrays([batch.column("user_id"), pa.array(effect[:, 0])], names=["user_id", "effect"])

    return cells.mapInArrow(run, f"user_id {kind.simpleString()}, effect double")
