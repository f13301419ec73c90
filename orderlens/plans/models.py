"""Tip classifiers: design matrices, chronological validation, training and scoring."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.scalars import cyclic
from orderlens.operators.panel import lag_columns
from orderlens.operators.ranking import time_series_folds, with_test_fold
from orderlens.operators.series import lagged_target
from orderlens.operators.skew import LIMITS, SkewLimits, find_heavy, salted_join
from orderlens.plans.features import feature_frame, trend_cycle_features
from orderlens.plans.newton import LinearModel, UserModel, fit_grid, fit_users, user_effects

# Inverse regularisation strengths 10^-4 .. 10^4 in ten steps.
INVERSE_STRENGTHS = [10 ** (-4 + 8 * i / 9) for i in range(10)]
# Values of a categorical column: a model has one coefficient for each.
MAX_CATEGORIES = 1_000
# Rows per partition of training data: a pass is one job, so small data wants few tasks.
TRAINING_ROWS = 20_000

# Column groups of the final model.
CATEGORICAL = ["order_contains_organic", "is_holiday", "cluster"]
STANDARDISED = [
    "avg_no_prod",
    "overall_tip_proba",
    "tip_proba_per_hour",
    "tip_proba_per_weekday",
    "tip_proba_per_department",
    "days_since_start",
]
MIN_MAX = ["no_orders", "cart_size"]


# ---- design matrix -----------------------------------------------------------


@dataclass(frozen=True)
class DesignMatrix:
    """Per-group scaling, encoding and imputation, fitted in one aggregate and one distinct of categories.

    ``fit`` reads a single row of statistics; ``transform`` is plain column
    arithmetic, so scoring needs neither joins nor shuffles.
    """

    impute: list[str]
    categorical: list[str]
    standardise: list[str]
    min_max: list[str]
    cyclic_columns: dict[str, int]
    passthrough: list[str]
    state: dict = field(default_factory=dict)

    def _categories(self, df: DataFrame) -> dict[str, list[str]]:
        """Sorted values of each categorical column: one matrix column each, so their number has a bound.

        No more than the bound is ever collected; beyond it the column is no category and is refused.
        """
        if not self.categorical:
            return {}
        # Equal rows first: a few combinations are left to be taken apart.
        combined = df.select(*[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(self.categorical)]).distinct()
        tagged = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("v")) for i in range(len(self.categorical))])
        values = combined.select(F.explode(tagged).alias("t")).select("t.*").where("v IS NOT NULL").distinct()
        found = values.limit(MAX_CATEGORIES * len(self.categorical) + 1).collect()
        out: dict[str, list[str]] = {f"cats_{i}": [] for i in range(len(self.categorical))}
        for r in found:
            out[f"cats_{r['i']}"].append(r["v"])
        wide = [c for i, c in enumerate(self.categorical) if len(out[f"cats_{i}"]) > MAX_CATEGORIES]
        if wide:
            raise ValueError(f"more than {MAX_CATEGORIES} categories in {', '.join(wide)}")
        return {k: sorted(v) for k, v in out.items()}

    def fit(self, df: DataFrame) -> "DesignMatrix":
        aggs = []
        for i, c in enumerate(self.impute):
            aggs.append(F.mode(F.col(c), True).alias(f"mode_{i}"))
        for i, c in enumerate(self.standardise):
            aggs += [F.avg(c).alias(f"avg_{i}"), F.stddev_pop(c).alias(f"std_{i}")]
        for i, c in enumerate(self.min_max):
            aggs += [F.min(c).alias(f"min_{i}"), F.max(c).alias(f"max_{i}")]
        state = (df.agg(*aggs).first().asDict() if aggs else {}) | self._categories(df)
        return DesignMatrix(
            self.impute,
            self.categorical,
            self.standardise,
            self.min_max,
            self.cyclic_columns,
            self.passthrough,
            state,
        )

    def columns(self) -> dict[str, Column]:
        """Named matrix columns in their order."""
        out: dict[str, Column] = {}
        s = self.state
        for i, c in enumerate(self.impute):
            out[c] = F.coalesce(F.col(c), F.lit(s[f"mode_{i}"]))
        for i, c in enumerate(self.categorical):
            for value in s[f"cats_{i}"]:
                # Unknown categories match nothing and give a zero row.
                out[f"{c}={value}"] = F.coalesce(F.col(c).cast("string") == value, F.lit(False))
        for i, c in enumerate(self.standardise):
            out[c] = (F.col(c) - F.lit(s[f"avg_{i}"])) / F.lit(s[f"std_{i}"] or 1.0)
        for i, c in enumerate(self.min_max):
            low, high = s[f"min_{i}"], s[f"max_{i}"]
            width = (high - low) if high is not None else None
            out[c] = (F.col(c) - F.lit(low)) / F.lit(float(width or 1))
        for c, period in self.cyclic_columns.items():
            out[f"{c}_sin"], out[f"{c}_cos"] = cyclic(c, period)
        for c in self.passthrough:
            out[c] = F.col(c)
        return {name: col.cast("double") for name, col in out.items()}

    def rows(self, df: DataFrame, name: str = "features") -> DataFrame:
        """The matrix row as an array of doubles."""
        return df.withColumn(name, F.array(*self.columns().values()))

    def transform(self, df: DataFrame, name: str = "features") -> DataFrame:
        """The same as a vector of Spark ML."""
        return df.withColumn(name, array_to_vector(F.array(*self.columns().values())))


def final_matrix(lags: int) -> DesignMatrix:
    _, names = lag_columns(lags)
    return DesignMatrix(
        impute=names,
        categorical=CATEGORICAL,
        standardise=STANDARDISED,
        min_max=MIN_MAX,
        cyclic_columns={"weekday": 7},
        passthrough=[f"{n}_is_nan" for n in names],
    )


def trend_matrix(lags: int) -> DesignMatrix:
    _, names = lag_columns(lags)
    return DesignMatrix(
        impute=[],
        categorical=[],
        standardise=[],
        min_max=[],
        cyclic_columns={"weekday": 7},
        passthrough=[*[f"{n}_is_nan" for n in names], *names, "days_since_start"],
    )


# ---- training --------------------------------------------------------------


def grouped_rows(df: DataFrame, inputs: list[str], label: str = "tip") -> DataFrame:
    """Equal rows become one row with a weight: the same likelihood on far fewer rows."""
    return df.groupBy(*inputs, label).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def training_partitions(rows: int) -> int:
    return max(1, -(-rows // TRAINING_ROWS))


def fit_logistic(
    train: DataFrame,
    inner_folds: int,
    strengths: list[float] | None = None,
    size: int | None = None,
) -> LinearModel:
    """L2 logistic regression; the strength is chosen by inner cross-validation on accuracy.

    Expects ``features`` (an array), ``tip`` and ``weight``. All strengths and inner folds are fitted
    together, one job per Newton step. ``size`` is an upper bound of the rows, if known; small data is put
    into fewer partitions, without a shuffle. Of equally good strengths the smallest is taken.
    """
    rows = train.select("features", F.col("tip").cast("double").alias("label"), "weight").withColumn(
        "inner", F.pmod(F.xxhash64("features", "label"), F.lit(inner_folds)).cast("int")
    )
    if size is not None:
        rows = rows.coalesce(training_partitions(size))
    models, shares = fit_grid(rows, None, inner_folds, strengths or INVERSE_STRENGTHS)
    return models[0] if np.isnan(shares).all() else models[int(np.nanargmax(shares))]


def accuracy() -> Column:
    return F.sum(F.when(F.col("prediction") == F.col("tip"), F.col("weight")).otherwise(0)) / F.sum("weight")


def judged(scored: DataFrame) -> tuple[float, tuple[int, int]]:
    """Accuracy of scored rows, and beside it the rows whose prediction equals the label and all rows, in one pass."""
    equal = F.count_if(F.col("prediction") == F.col("tip"))
    row = scored.agg(accuracy().alias("share"), equal.alias("equal"), F.count(F.lit(1)).alias("n")).first()
    return row["share"], (row["equal"], row["n"])


@dataclass(frozen=True)
class TrainedModel:
    model: LinearModel
    matrix: DesignMatrix
    fold_accuracy: dict[int, float]
    fold_sizes: dict[int, tuple[int, int]] = field(default_factory=dict)
    fold_matches: dict[int, tuple[int, int]] = field(default_factory=dict)

    @property
    def mean_accuracy(self) -> float:
        return sum(self.fold_accuracy.values()) / len(self.fold_accuracy)


def fold_sizes(rows: DataFrame, folds: int) -> dict[int, tuple[int, int]]:
    """Rows that each fold trains and tests on."""
    n = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}
    return {f: (sum(n.get(i, 0) for i in range(f)), n.get(f, 0)) for f in range(1, folds + 1)}


def train_with_folds(
    frame: DataFrame,
    matrix: DesignMatrix,
    inputs: list[str],
    folds: int,
    inner_folds: int = 3,
    final_inner_folds: int | None = None,
    strengths: list[float] | None = None,
    group_rows: bool = False,
) -> TrainedModel:
    """Chronological validation, then a fit on all labelled rows.

    The frame is cached once; fold membership is a comparison with at most
    ``folds`` border rows and costs no shuffle. No folds: only the fit on all rows.
    """
    known = frame.filter(F.col("tip").isNotNull()).select("order_id", "order_date", "tip", *inputs)
    known = known.persist()
    try:
        n, borders = time_series_folds(known, "order_date", "order_id", folds) if folds else (known.count(), [])
        rows = with_test_fold(known, "order_date", "order_id", borders)

        def prepared(part: DataFrame, fitted: DesignMatrix) -> DataFrame:
            data = (
                grouped_rows(part, inputs)
                if group_rows
                else part.withColumn("weight", F.lit(1.0))
            )
            return fitted.rows(data).select("features", "tip", "weight")

        def validate(fold: int) -> tuple[int, float]:
            train = rows.filter(F.col("fold") < fold)
            fitted = matrix.fit(train)
            model = fit_logistic(prepared(train, fitted), inner_folds, strengths, size=n)
            test = fitted.rows(rows.filter(F.col("fold") == fold)).withColumn("weight", F.lit(1.0))
            share, matches[fold] = judged(model.transform(test))
            return fold, share

        def refit() -> tuple[LinearModel, DesignMatrix]:
            fitted = matrix.fit(known)
            inner = final_inner_folds or inner_folds
            return fit_logistic(prepared(known, fitted), inner, strengths, size=n), fitted

        # One level of concurrency: folds follow each other, the search within a fold runs in parallel.
        matches: dict[int, tuple[int, int]] = {}
        scores = dict(validate(fold) for fold in range(1, folds + 1))
        final, fitted = refit()
        sizes = fold_sizes(rows, folds) if folds else {}
    finally:
        known.unpersist()
    return TrainedModel(final, fitted, scores, sizes, matches)


def train_trend_model(orders: DataFrame, lags: int = 4, folds: int = 3, **options) -> TrainedModel:
    """Lags, missing flags, trend and weekday cycle."""
    matrix = trend_matrix(lags)
    options.setdefault("final_inner_folds", 5)
    return train_with_folds(
        trend_cycle_features(orders, lags),
        matrix,
        [*matrix.passthrough, "weekday"],
        folds,
        group_rows=True,
        **options,
    )


def train_final_model(
    features: DataFrame, lags: int = 4, folds: int = 3, **options
) -> TrainedModel:
    """All features; ``features`` is a feature frame with clusters."""
    matrix = final_matrix(lags)
    inputs = [
        *matrix.impute,
        *matrix.categorical,
        *matrix.standardise,
        *matrix.min_max,
        *matrix.passthrough,
        "weekday",
    ]
    return train_with_folds(features, matrix, inputs, folds, **options)


@dataclass(frozen=True)
class ArModel:
    """An AR(n) model with one intercept per user, judged on chronological folds.

    ``cells`` holds one row per user: its counted rows per fold, lag pattern and label. User
    intercepts follow from them and the common coefficients, so they are never stored or collected.
    """

    lags: int
    models: dict[int, UserModel]
    cells: DataFrame
    rows: DataFrame
    complete: DataFrame

    @property
    def fold_accuracy(self) -> dict[int, float]:
        return {f: m.accuracy for f, m in self.models.items()}

    def predictions(self, fold: int, limits: SkewLimits = LIMITS) -> DataFrame:
        """The fold's test rows with ``prediction``, each scored by itself."""
        model, (_, names) = self.models[fold], lag_columns(self.lags)
        test = self.rows.filter(F.col("fold") == fold)
        effects = user_effects(self.cells, model, self.lags, len(self.models), fold)
        keyed = salted_join(test, effects, ["user_id"], "left", ["order_id"], limits=limits)
        common = sum((F.col(n) * float(c) for n, c in zip(names, model.theta)), F.lit(float(model.theta[-1])))
        return keyed.withColumn("prediction", (common + F.coalesce("effect", F.lit(0.0)) > 0).cast("double")).drop("effect")

    def release(self) -> None:
        self.cells.unpersist()
        self.complete.unpersist()


def ar_cells(rows: DataFrame, lags: int, inner_folds: int) -> DataFrame:
    """Rows (user_id, tip, lags, fold) counted per user, fold, lag pattern and label: one row per user."""
    _, names = lag_columns(lags)
    pattern = sum((F.col(n).cast("int") * (1 << i) for i, n in enumerate(names)), F.lit(0))
    label = F.col("tip").cast("int")
    inner = F.pmod(F.xxhash64("user_id", "pattern", "label"), F.lit(inner_folds)).cast("int")
    # Counted before users are put together, so a user with very many rows leaves few from each task.
    counted = rows.select("user_id", "fold", pattern.alias("pattern"), label.alias("label")).groupBy("user_id", "fold", "pattern", "label").count()
    cell = (F.col("fold") * (1 << lags) + F.col("pattern")) * 2 + F.col("label")
    entry = F.struct(cell.alias("cell"), F.col("count").alias("n"), inner.alias("inner"))
    return counted.groupBy("user_id").agg(F.collect_list(entry).alias("cells"))


def train_ar_model(
    orders: DataFrame,
    lags: int,
    folds: int = 5,
    inner_folds: int = 5,
    strengths: list[float] | None = None,
    limits: SkewLimits = LIMITS,
) -> ArModel:
    """The AR(n) model, lags plus one intercept per user, for every fold; release it after use.

    Users outside the training part have no intercept of their own. All folds, inner folds and
    strengths are fitted together; users are counted once and never ranked or indexed.
    """
    complete = lagged_target(
        orders.filter(F.col("tip").isNotNull()),
        "user_id",
        "order_date",
        "order_id",
        "tip",
        lags,
        limits,
    ).persist()
    _, borders = time_series_folds(complete, "order_date", "order_id", folds)
    rows = with_test_fold(complete, "order_date", "order_id", borders)
    cells = ar_cells(rows, lags, inner_folds).persist()
    models = fit_users(cells, lags, folds, inner_folds, strengths or INVERSE_STRENGTHS)
    return ArModel(lags, models, cells, rows, complete)


# ---- scoring ------------------------------------------------------------------


def prediction_sets(
    orders: DataFrame, labels: DataFrame, template: DataFrame, limits: SkewLimits = LIMITS
) -> dict[str, DataFrame]:
    """Labelled orders, and all orders of users who have at least one unlabelled order."""
    labelled = orders.join(labels, "order_id")
    either = labels.unionByName(template, allowMissingColumns=True).join(orders, "order_id")
    open_users = either.filter(F.col("tip").isNull()).select("user_id").distinct()
    heavy = find_heavy(orders.select("user_id"), ["user_id"], limits)
    return {
        "labelled": labelled,
        "scoring": salted_join(either, open_users, ["user_id"], "left_semi", ["order_id"], heavy),
    }


def score(frame: DataFrame, trained: TrainedModel, required: list[str]) -> DataFrame:
    """``(order_id, tip)`` for rows without a target; rows with missing inputs stay unscored (null)."""
    wanted = frame.filter(F.col("tip").isNull())
    usable = wanted.na.drop(subset=required)
    predicted = trained.model.transform(trained.matrix.rows(usable)).select(
        "order_id", F.col("prediction").cast("boolean").alias("tip")
    )
    return wanted.select("order_id").join(predicted, "order_id", "left")


def reject_missing(predictions: DataFrame) -> DataFrame:
    """Fails the job when an order was left without a prediction."""
    check = F.assert_true(F.col("tip").isNotNull(), F.lit("an order has no prediction"))
    return predictions.filter(F.coalesce(check.cast("boolean"), F.lit(True)))


def score_trend(orders: DataFrame, trained: TrainedModel, lags: int = 4, min_date: Column | None = None) -> DataFrame:
    frame = trend_cycle_features(orders, lags, min_date)
    return score(frame, trained, [*trained.matrix.passthrough, "weekday"])


def score_final(
    orders: DataFrame,
    lines: DataFrame,
    clusters: DataFrame,
    trained: TrainedModel,
    lags: int = 4,
    min_date: Column | None = None,
    **options,
) -> DataFrame:
    """Score open orders with all features; lags are imputed, so they are not required."""
    frame = feature_frame(orders, lines, lags, min_date, clusters, **options)
    m = trained.matrix
    required = [*m.categorical, *m.standardise, *m.min_max, *m.passthrough, "weekday"]
    scored = score(frame, trained, required)
    # Orders without lines never reach the feature frame; keep them as open rows.
    open_orders = orders.filter(F.col("tip").isNull()).select("order_id")
    return open_orders.join(scored, "order_id", "left")
