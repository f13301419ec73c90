import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderlens.operators import quality
from orderlens.operators.series import (
    autocorrelation,
    chi_square_tail,
    lagged_target,
    panel_acf,
    panel_pacf,
    resample_mean,
)
from orderlens.operators.skew import SkewLimits
from orderlens.plans import features as ft
from orderlens.plans import models as md
from orderlens.plans import newton
from orderlens.plans.catalogue import QUERIES


@pytest.fixture(scope="module")
def orders(spark):
    """Users repeat their last tip four times out of five; the last order of each is open."""
    rnd = random.Random(9)
    base = dt.datetime(2024, 1, 1)
    data, i = [], 0
    for user in range(30):
        tip = rnd.randrange(2)
        for n in range(14):
            tip = tip if rnd.random() < 0.8 else 1 - tip
            data.append((i, user, base + dt.timedelta(hours=36 * n + rnd.randrange(30)), None if n == 13 else tip))
            i += 1
    return spark.createDataFrame(
        data, "order_id long, user_id long, order_date timestamp_ntz, tip int"
    ).cache()


@pytest.fixture(scope="module")
def lines(spark, orders):
    return (
        orders.select("order_id", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("n"))
        .select(
            "order_id",
            (F.col("n") + 1).alias("add_to_cart_order"),
            F.when((F.col("order_id") + F.col("n")) % 4 == 0, "organic tea").otherwise("rice").alias("product_name"),
            F.concat(F.lit("d"), (F.col("order_id") * 7 + F.col("n")) % 5).alias("department"),
        )
        .cache()
    )


def test_design_matrix(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 1, "a", 5, 0), (1, 2.0, 3, "b", 5, 1), (None, 4.0, 5, "a", 5, 2)],
        "lag int, x double, n int, c string, flat int, day int",
    )
    fitted = md.DesignMatrix(["lag"], ["c"], ["x", "flat"], ["n"], {"day": 7}, ["day"]).fit(df)
    assert list(fitted.columns()) == ["lag", "c=a", "c=b", "x", "flat", "n", "day_sin", "day_cos", "day"]
    unseen = spark.createDataFrame([(None, 2.0, 7, "zzz", 6, 3)], df.schema)
    v = fitted.transform(unseen).first()["features"].toArray()
    want = [1, 0, 0, 0, 1, 1.5, math.sin(6 * math.pi / 7), math.cos(6 * math.pi / 7), 3]
    assert np.allclose(v, want)
    z = [r["features"][3] for r in fitted.transform(df).collect()]
    assert np.allclose(z, np.array([-2, 0, 2]) / math.sqrt(8 / 3))


def test_too_many_categories_are_refused_before_they_are_collected(spark, monkeypatch):
    monkeypatch.setattr(md, "MAX_CATEGORIES", 5)
    matrix = md.DesignMatrix([], ["id", "two"], [], [], {}, [])
    wide = spark.range(1_000_000).withColumn("two", F.col("id") % 2)
    with pytest.raises(ValueError, match="more than 5 categories in id"):
        matrix.fit(wide)
    assert matrix.fit(wide.withColumn("id", F.col("id") % 5)).state == {"cats_0": ["0", "1", "2", "3", "4"], "cats_1": ["0", "1"]}


def test_grouped_rows_give_the_same_fit(spark, orders):
    frame = ft.trend_cycle_features(orders, 2).filter("tip is not null")
    matrix = md.trend_matrix(2).fit(frame)
    inputs = [*matrix.passthrough, "weekday"]
    one = matrix.rows(frame.withColumn("weight", F.lit(1.0)))
    grouped = matrix.rows(md.grouped_rows(frame, inputs))
    a, b = (md.fit_logistic(x, 3, [1.0], size=1000) for x in (one, grouped))
    assert np.allclose(a.coefficients, b.coefficients, atol=1e-6)


def direct(x, y, w, strength):
    """Minimise the C-weighted objective by plain Newton steps on a dense matrix."""
    x = np.column_stack((x, np.ones(len(x))))
    ridge = np.diag([1 / strength] * (x.shape[1] - 1) + [0.0])
    b = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ b)))
        step = np.linalg.solve(x.T @ (x * (w * p * (1 - p))[:, None]) + ridge, x.T @ (w * (p - y)) + ridge @ b)
        b -= step
        if np.abs(step).max() < 1e-12:
            break
    return b


def test_grid_of_models_equals_one_by_one_fits(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(300, 3)) * [1, 5, 0.1]
    y = (x[:, 0] + 0.2 * x[:, 1] + rnd.normal(size=300) > 0).astype(float)
    w, inner = rnd.integers(1, 4, 300).astype(float), rnd.integers(0, 3, 300)
    data = [(list(map(float, a)), float(t), float(v), int(k)) for a, t, v, k in zip(x, y, w, inner)]
    df = spark.createDataFrame(data, "features array<double>, label double, weight double, inner int").repartition(40).persist()
    strengths = [1e-3, 0.1, 10.0, 1e4]
    models, shares = newton.fit_grid(df, 3, 3, strengths)
    for i, c in enumerate(strengths):
        b = direct(x, y, w, c)
        assert np.allclose([*models[i].coefficients, models[i].intercept], b, atol=1e-4)
        held = []
        for k in range(3):
            own = direct(x[inner != k], y[inner != k], w[inner != k], c)
            right = (x[inner == k] @ own[:3] + own[3] > 0) == (y[inner == k] > 0)
            held.append((w[inner == k] * right).sum() / w[inner == k].sum())
        assert np.isclose(shares[i], np.mean(held))


def test_one_strength_goes_ahead_of_the_grid(spark, monkeypatch):
    """Few models are measured until one is fitted; rows are turned into blocks in one reading, of several batches too."""
    rnd = np.random.default_rng(5)
    x = np.round(rnd.normal(size=(3000, 3)), 3)
    y = (x[:, 0] - x[:, 1] + rnd.normal(size=3000) > 0).astype(float)
    inner = np.arange(3000) % 3
    data = [(list(map(float, a)), float(t), 1.0, int(k)) for a, t, k in zip(x, y, inner)]
    df = spark.createDataFrame(data, "features array<double>, label double, weight double, inner int").coalesce(2)
    passes, add = [], newton.summed
    monkeypatch.setattr(newton, "summed", lambda rows, function, size: passes.append(size) or add(rows, function, size))
    models, shares = newton.fit_grid(df, None, 3, md.INVERSE_STRENGTHS)
    each = 3 + 4 + 10
    assert passes[0] == 4 * each and sum(p > 4 * each for p in passes) <= 3
    for i in (0, 5, 9):
        b = direct(x, y, np.ones(3000), md.INVERSE_STRENGTHS[i])
        assert np.allclose([*models[i].coefficients, models[i].intercept], b, atol=1e-5)
    assert shares.shape == (10,) and ((shares > 0.7) & (shares < 1)).all()


def test_no_rows_to_train_on_are_refused(spark):
    none = spark.createDataFrame([], "features array<double>, tip double, weight double")
    with pytest.raises(ValueError, match="no rows to train on"):
        md.fit_logistic(none, 3)


def test_grid_equals_the_library_optimiser(spark):
    """The strength C means lambda = 1 / (C n) without standardisation."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(200, 2)) * [1, 5]
    y = (x[:, 0] + 0.2 * x[:, 1] + rnd.normal(size=200) > 0).astype(float)
    df = spark.createDataFrame([([float(a), float(b)], float(t), 1.0) for (a, b), t in zip(x, y)], "features array<double>, tip double, weight double")
    mine = md.fit_logistic(df, 3, [0.05], size=200)
    rows = df.select(array_to_vector("features").alias("features"), F.col("tip").alias("label"))
    theirs = LogisticRegression(maxIter=1000, tol=1e-12, standardization=False, regParam=1 / (0.05 * 200)).fit(rows)
    assert np.allclose(mine.coefficients, theirs.coefficients.toArray(), atol=1e-4) and abs(mine.intercept - theirs.intercept) < 1e-4


def test_user_intercepts_equal_a_dense_fit(spark):
    """Eliminated intercepts give the coefficients of the model with one column per user; no fold sees its own rows."""
    rnd = np.random.default_rng(2)
    rows = []
    for user in range(25):
        for _ in range(rnd.integers(1, 14)):
            a, b = (int(v) for v in rnd.integers(0, 2, 2))
            tip = int(rnd.random() < 1 / (1 + np.exp(-(0.8 * a - 0.5 * b + (user % 5 - 2)))))
            rows.append((len(rows), user if user != 3 else None, tip, a, b, int(rnd.integers(0, 3))))
    frame = spark.createDataFrame(rows, ["order_id", "user_id", "tip", "tip_t-1", "tip_t-2", "fold"])
    cells = md.ar_cells(frame, 2, 2).persist()
    (model, last) = (newton.fit_users(cells, 2, 2, 2, [3.0])[f] for f in (1, 2))
    for fold, own in ((1, model), (2, last)):
        train = [r for r in rows if r[5] < fold]
        users = sorted({r[1] for r in train}, key=str)
        x = np.array([[r[3], r[4], *[float(r[1] == u) for u in users]] for r in train], float)
        b = direct(x, np.array([r[2] for r in train], float), np.ones(len(train)), 3.0)
        assert np.allclose(own.theta, [b[0], b[1], b[-1]], atol=1e-5)
        effects = {r["user_id"]: r["effect"] for r in newton.user_effects(cells, own, 2, 2, fold).collect()}
        assert all(np.isclose(effects[u], b[2 + i], atol=1e-5) for i, u in enumerate(users))
        test = [r for r in rows if r[5] == fold]
        right = [(b[0] * r[3] + b[1] * r[4] + b[-1] + effects[r[1]] > 0) == (r[2] == 1) for r in test]
        assert (own.equal, own.n) == (sum(right), len(test))


def test_models_beat_the_majority_on_planted_data(spark):
    """Users tip by habit and by the day: both models find it, a constant does not."""
    rnd = np.random.default_rng(3)
    start = dt.datetime(2024, 1, 1)
    data = []
    for user in range(60):
        habit, last = (0.9 if user % 2 else 0.1), 0
        for k in range(20):
            last = int(rnd.random() < 0.8 * habit + 0.2 * last)
            data.append((len(data), user, start + dt.timedelta(hours=30 * k + user % 7), last))
    orders = spark.createDataFrame(data, "order_id long, user_id long, order_date timestamp_ntz, tip int")
    share = np.mean([r[3] for r in data])
    trained = md.train_ar_model(orders, 2)
    assert sorted(trained.models) == [1, 2, 3, 4, 5]
    assert min(trained.fold_accuracy.values()) > max(share, 1 - share) + 0.2
    trained.release()
    assert md.train_trend_model(orders, 4, 3).mean_accuracy > max(share, 1 - share) + 0.2


def test_trend_model_learns_and_scores(orders):
    trained = md.train_trend_model(orders, 2, 3, strengths=[1.0, 100.0], final_inner_folds=3)
    assert sorted(trained.fold_accuracy) == [1, 2, 3]
    assert trained.mean_accuracy > 0.65
    scored = md.reject_missing(md.score_trend(orders, trained, 2))
    assert scored.count() == 30 and scored.filter("tip is null").count() == 0
    # Mostly the prediction repeats the last known tip.
    last = orders.filter("tip is not null").groupBy("user_id").agg(F.max_by("tip", "order_date").alias("last"))
    same = (
        scored.join(orders.select("order_id", "user_id"), "order_id")
        .join(last, "user_id")
        .filter(F.col("tip") == F.col("last").cast("boolean"))
        .count()
    )
    assert same >= 27


def test_final_model_scores_every_open_order(orders, lines):
    clusters = ft.cluster_users(orders, restarts=2)
    frame = ft.feature_frame(orders, lines, 2, clusters=clusters)
    trained = md.train_final_model(frame, 2, 2, strengths=[1.0], inner_folds=2)
    assert trained.mean_accuracy > 0.6
    scored = md.reject_missing(md.score_final(orders, lines, clusters, trained, 2))
    assert scored.count() == 30 and scored.columns == ["order_id", "tip"]
    without = lines.join(orders.filter("tip is null").select("order_id"), "order_id", "left_anti")
    open_rows = md.score_final(orders, without, clusters, trained, 2)
    assert open_rows.filter("tip is null").count() == 30
    with pytest.raises(Exception, match="no prediction"):
        md.reject_missing(open_rows).collect()


def test_ar_model_with_user_indicators(orders):
    trained = md.train_ar_model(orders, 1, folds=2, inner_folds=2, strengths=[1.0])
    scores = trained.fold_accuracy
    assert sorted(scores) == [1, 2] and all(s > 0.6 for s in scores.values())
    trained.release()


def test_prediction_sets(spark, orders):
    base = orders.select("order_id", "user_id", "order_date")
    some_open = orders.withColumn("tip", F.when(F.col("user_id") < 3, F.col("tip")).otherwise(F.coalesce("tip", F.lit(0))))
    labels = some_open.filter("tip is not null").select("order_id", "tip")
    template = some_open.filter("tip is null").select("order_id", "tip")
    for limits in (SkewLimits(), SkewLimits(1e-4, 10)):
        sets = md.prediction_sets(base, labels, template, limits)
        assert sets["labelled"].count() == labels.count()
        assert {r["user_id"] for r in sets["scoring"].collect()} == {0, 1, 2}


def test_acf_and_pacf_equal_residual_regression(spark, orders):
    known = orders.filter("tip is not null")
    for limits in (SkewLimits(), SkewLimits(1e-4, 5)):
        lagged = lagged_target(known, "user_id", "order_date", "order_id", "tip", 3, limits).cache()
        m = np.array([[r["tip"], *[r[f"tip_t-{k}"] for k in (1, 2, 3)]] for r in lagged.collect()], float)
        acf = {r["lag"]: r["acf"] for r in panel_acf(lagged, "tip", 3).collect()}
        pacf = {r["lag"]: r["pacf"] for r in panel_pacf(lagged, "tip", 3).collect()}
        for k in (1, 2, 3):
            assert np.isclose(acf[k], np.corrcoef(m[:, 0], m[:, k])[0, 1])
            x = np.column_stack([np.ones(len(m)), m[:, 1:k]])
            residual = [m[:, c] - x @ np.linalg.lstsq(x, m[:, c], rcond=None)[0] for c in (0, k)]
            assert np.isclose(pacf[k], np.corrcoef(*residual)[0, 1])


def test_pacf_of_constant_or_empty_series(spark, orders):
    flat = orders.filter("tip is not null").withColumn("tip", F.lit(1))
    lagged = lagged_target(flat, "user_id", "order_date", "order_id", "tip", 2)
    assert [r["pacf"] for r in panel_pacf(lagged, "tip", 2).collect()] == [None, None]
    assert [r["pacf"] for r in panel_pacf(lagged.limit(0), "tip", 2).collect()] == [None, None]


def test_resample_and_autocorrelation(spark):
    base = dt.datetime(2024, 1, 1, 5)
    values = {0: [1, 0], 1: [1], 3: [0], 4: [1, 1, 0], 7: [0]}
    data = [(base + dt.timedelta(days=d, minutes=i), v) for d, vs in values.items() for i, v in enumerate(vs)]
    series = resample_mean(spark.createDataFrame(data, "ts timestamp_ntz, tip int"), "ts", "tip", "day")
    got = [r["mean_value"] for r in series.orderBy("bin").collect()]
    assert got == [0.5, 1, None, 0, 2 / 3, None, None, 0]
    pairs = [(got[i], got[i - 1]) for i in range(1, 8) if got[i] is not None and got[i - 1] is not None]
    want = np.corrcoef(*zip(*pairs))[0, 1]
    auto = autocorrelation(series, "day", [1]).first()
    assert np.isclose(auto["autocorr"], want)
    with pytest.raises(ValueError):
        resample_mean(series, "bin", "mean_value", "week")


def test_chi_square_tail():
    # Upper 5 % points of the chi-square distribution.
    for dof, point in ((1, 3.841459), (2, 5.991465), (6, 12.591587), (23, 35.172462), (167, 198.154184)):
        assert math.isclose(chi_square_tail(point, dof), 0.05, rel_tol=2e-3)
    assert chi_square_tail(0.0, 3) == 1.0 and chi_square_tail(5000.0, 7) < 1e-300


def test_checks_and_readiness(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, 3), (None, 3)], "a int, b int")
    checks = quality.report([quality.unique(df, ["a"], "u"), quality.not_null(df, "b", "n"), quality.not_null(df.na.drop(), "a", "ok")])
    assert rows(checks) == [("n", 1), ("ok", 0), ("u", 1)]
    assert sorted(quality.failures(checks)) == ["n", "u"]
    ready = quality.readiness({"full": df, "empty": df.limit(0), "absent": None})
    assert rows(ready) == [("absent", False, False), ("empty", True, False), ("full", True, True)]
    assert quality.preview(spark.range(20), ["id"]).count() == 8
    assert quality.preview(spark.range(6), ["id"]).count() == 6


@pytest.mark.parametrize(
    "name, inner",
    [("m14_ar_extended", [3, 3, 3, 5]), ("m15_final", [3, 3, 3, 3]), ("m17_score", [5]), ("m17_score_final", [3])],
)
def test_registered_models_search_all_strengths(spark, sf_dir, monkeypatch, name, inner):
    """Every fit of a registered run selects among all strengths, over the inner folds of the reference."""
    seen, fit = [], md.fit_logistic

    def recorded(train, inner_folds, strengths=None, *args, **options):
        seen.append((inner_folds, strengths or md.INVERSE_STRENGTHS))
        return fit(train, inner_folds, [1.0], *args, **options)

    monkeypatch.setattr(md, "fit_logistic", recorded)
    QUERIES[name](spark, sf_dir)
    assert seen == [(n, md.INVERSE_STRENGTHS) for n in inner] and len(md.INVERSE_STRENGTHS) == 10


def test_registered_ar_model_searches_all_strengths(spark, sf_dir, monkeypatch):
    seen, fit = [], md.fit_users

    def recorded(cells, lags, folds, inner_folds, strengths):
        seen.append((lags, folds, inner_folds, strengths))
        return fit(cells, lags, folds, inner_folds, [1.0])

    monkeypatch.setattr(md, "fit_users", recorded)
    QUERIES["m13_ar"](spark, sf_dir)
    assert seen == [(2, 5, 5, md.INVERSE_STRENGTHS)]


def test_cluster_flag_sees_wrong_clusters(spark, sf_dir, monkeypatch):
    cluster = ft.cluster_users
    assert QUERIES["m4_clusters"](spark, sf_dir).filter("not has_cluster").count() == 0

    def moved(*args, **options):
        return cluster(*args, **options).withColumn("cluster", (F.col("cluster") + 1) % ft.CLUSTERS)

    monkeypatch.setattr(ft, "cluster_users", moved)
    assert QUERIES["m4_clusters"](spark, sf_dir).filter("has_cluster").count() == 0


def test_accuracy_flag_sees_wrong_accuracy(spark, sf_dir, monkeypatch):
    fit = md.fit_logistic
    monkeypatch.setattr(md, "fit_logistic", lambda rows, inner, *args, **options: fit(rows, inner, [1.0], size=1))
    assert [r["accuracy_is_share"] for r in QUERIES["m14_ar_extended"](spark, sf_dir).collect()] == [True] * 3
    monkeypatch.setattr(md, "accuracy", lambda: F.avg(F.lit(0.123)))
    assert [r["accuracy_is_share"] for r in QUERIES["m14_ar_extended"](spark, sf_dir).collect()] == [False] * 3


def test_ar_accuracy_flag_compares_counts_with_scored_rows(spark, sf_dir, monkeypatch):
    assert [r["accuracy_is_share"] for r in QUERIES["m13_ar"](spark, sf_dir).collect()] == [True] * 5
    effects = newton.user_effects
    monkeypatch.setattr(md, "user_effects", lambda *a: effects(*a).withColumn("effect", -F.col("effect") - 1))
    assert not all(r["accuracy_is_share"] for r in QUERIES["m13_ar"](spark, sf_dir).collect())
