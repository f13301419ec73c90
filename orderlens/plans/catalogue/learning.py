"""Features, design matrix, folds, models and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.panel import lag_columns
from orderlens.operators.ranking import time_series_folds, with_test_fold
from orderlens.operators.series import lagged_target
from orderlens.plans import features as ft
from orderlens.plans import models as md
from orderlens.plans.catalogue.registry import LINES, O, query
from orderlens.plans.catalogue.timeseries import FILLED, LAG_SQL, LAGS, NAN_SQL
from orderlens.plans.catalogue.warehouse import HOLIDAYS_SQL
from orderlens.sources import stand_ins as src

FOLDS, AR_FOLDS = 3, 5


def features(spark, sf, clusters: DataFrame | None = None) -> DataFrame:
    return ft.feature_frame(
        src.orders(spark, sf),
        src.order_lines(spark, sf),
        LAGS,
        clusters=clusters,
        organic_word=src.ORGANIC_STAND_IN,
    )


_FEATURES_SQL = f"""WITH {O}, {LINES}, {HOLIDAYS_SQL}, {FILLED},
g AS (SELECT *, tip IS NULL AS is_target_nan, {LAG_SQL}, {NAN_SQL} FROM fl),
ca AS (SELECT order_id, max(add_to_cart_order) AS cart_size,
       bool_or(contains(lower(product_name), 'red')) AS order_contains_organic FROM d GROUP BY 1),
cu AS (SELECT user_id, count(DISTINCT order_id) AS no_orders FROM o GROUP BY 1),
x AS (SELECT g.*, ca.cart_size, ca.order_contains_organic, cu.no_orders,
       avg(ca.cart_size) OVER (PARTITION BY g.user_id) AS avg_no_prod,
       CAST(isodow(order_date) - 1 AS INTEGER) AS weekday, CAST(hour(order_date) AS INTEGER) AS hour,
       CAST(order_date AS DATE) IN (SELECT d FROM hol) AS is_holiday
      FROM g JOIN ca USING (order_id) JOIN cu ON g.user_id = cu.user_id),
rh AS (SELECT hour, avg(tip) * 100 AS r FROM x GROUP BY 1),
rw AS (SELECT weekday, avg(tip) * 100 AS r FROM x GROUP BY 1),
rd AS (SELECT department, avg(tip) * 100 AS r FROM d JOIN o USING (order_id) GROUP BY 1),
dp AS (SELECT order_id, avg(r) AS r FROM d JOIN rd USING (department) GROUP BY 1)
SELECT order_id, user_id, order_date, tip, is_target_nan,
  (epoch_us(order_date) - (SELECT epoch_us(min(order_date)) FROM o)) // 86400000000 AS days_since_start,
  {', '.join(f'"tip_t-{k}", "tip_t-{k}_is_nan"' for k in range(1, LAGS + 1))},
  order_contains_organic, no_orders, cart_size, round(avg_no_prod, 8) AS avg_no_prod,
  weekday, hour, is_holiday,
  round((SELECT avg(tip) * 100 FROM x), 8) AS overall_tip_proba,
  round(rh.r, 8) AS tip_proba_per_hour, round(rw.r, 8) AS tip_proba_per_weekday,
  round(dp.r, 8) AS tip_proba_per_department
FROM x JOIN rh USING (hour) JOIN rw USING (weekday) LEFT JOIN dp USING (order_id)"""


@query("m1_features", _FEATURES_SQL)
def m1_features(spark, sf):
    _, names = lag_columns(LAGS)
    rounded = ["avg_no_prod", "overall_tip_proba", "tip_proba_per_hour", "tip_proba_per_weekday", "tip_proba_per_department"]
    return features(spark, sf).select(
        "order_id",
        "user_id",
        "order_date",
        "tip",
        "is_target_nan",
        "days_since_start",
        *[c for n in names for c in (n, f"{n}_is_nan")],
        "order_contains_organic",
        "no_orders",
        "cart_size",
        "weekday",
        "hour",
        "is_holiday",
        *[F.round(c, 8).alias(c) for c in rounded],
    )


@query(
    "m2_date_conversion",
    f"""WITH {O} SELECT order_id,
(epoch_us(order_date) - (SELECT epoch_us(min(order_date)) FROM o)) // 86400000000 AS days_since_start FROM o""",
)
def m2_date_conversion(spark, sf):
    return ft.date_conversion(src.orders(spark, sf)).select("order_id", "days_since_start")


@query(
    "m3_temporal",
    f"""WITH {HOLIDAYS_SQL} SELECT o_orderkey AS order_id, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday,
CAST(hour(o_orderdate) AS INTEGER) AS hour, CAST(o_orderdate AS DATE) IN (SELECT d FROM hol) AS is_holiday FROM orders""",
)
def m3_temporal(spark, sf):
    return ft.temporal_features(src.orders(spark, sf)).select("order_id", "weekday", "hour", "is_holiday")


# ---- design matrix -------------------------------------------------------------------

_BASE = f"""{O}, {LINES}, ca AS (SELECT order_id, max(add_to_cart_order) AS cart_size, count(*) AS n FROM d GROUP BY 1),
f AS (SELECT o.order_id, ca.cart_size, ca.n, CAST(isodow(order_date) AS INTEGER) AS dow, tip
      FROM o JOIN ca USING (order_id))"""


def matrix_base(spark, sf) -> DataFrame:
    lines = src.order_products(spark, sf).groupBy("order_id").agg(
        F.max("add_to_cart_order").alias("cart_size"), F.count(F.lit(1)).alias("n")
    )
    orders = src.orders(spark, sf).select(
        "order_id", (F.weekday("order_date") + 1).alias("dow"), "tip"
    )
    return orders.join(lines, "order_id")


def _matrix(base: DataFrame, **parts) -> DataFrame:
    empty = {"impute": [], "categorical": [], "standardise": [], "min_max": [], "cyclic_columns": {}, "passthrough": []}
    fitted = md.DesignMatrix(**{**empty, **parts}).fit(base)
    return base.select("order_id", *[c.alias(name) for name, c in fitted.columns().items()])


@query(
    "m5_scale",
    f"""WITH {_BASE} SELECT order_id, round((cart_size - avg(cart_size) OVER ()) / stddev_pop(cart_size) OVER (), 8) AS cart_size,
round((n - avg(n) OVER ()) / stddev_pop(n) OVER (), 8) AS n FROM f""",
)
def m5_scale(spark, sf):
    scaled = _matrix(matrix_base(spark, sf), standardise=["cart_size", "n"])
    return scaled.select("order_id", F.round("cart_size", 8).alias("cart_size"), F.round("n", 8).alias("n"))


@query(
    "m6_minmax",
    f"""WITH {_BASE} SELECT order_id, round((n - min(n) OVER ()) / (max(n) OVER () - min(n) OVER ()), 8) AS n FROM f""",
)
def m6_minmax(spark, sf):
    scaled = _matrix(matrix_base(spark, sf), min_max=["n"])
    return scaled.select("order_id", F.round("n", 8).alias("n"))


@query(
    "m7_onehot",
    f"""WITH {_BASE} SELECT order_id, {', '.join(f"CAST(dow = {d} AS DOUBLE) AS dow_{d}" for d in range(1, 8))} FROM f""",
)
def m7_onehot(spark, sf):
    encoded = _matrix(matrix_base(spark, sf), categorical=["dow"])
    return encoded.select("order_id", *[F.col(f"`dow={d}`").alias(f"dow_{d}") for d in range(1, 8)])


@query(
    "m8_impute",
    f"""WITH {_BASE}, mo AS (SELECT tip FROM f WHERE tip IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT order_id, CAST(coalesce(tip, (SELECT tip FROM mo)) AS DOUBLE) AS tip FROM f""",
)
def m8_impute(spark, sf):
    return _matrix(matrix_base(spark, sf), impute=["tip"])


@query(
    "m10_assembled",
    f"""WITH {_BASE} SELECT order_id,
round(CAST(dow = 7 AS DOUBLE) * 100 + (n - min(n) OVER ()) / (max(n) OVER () - min(n) OVER ())
 + 10 * sin(2 * pi() * dow / 7), 7) AS checksum FROM f""",
)
def m10_assembled(spark, sf):
    """One vector per row in the order of the groups; positions are read back from the vector."""
    from pyspark.ml.functions import vector_to_array

    base = matrix_base(spark, sf)
    fitted = md.DesignMatrix([], ["dow"], [], ["n"], {"dow": 7}, []).fit(base)
    at = {name: i for i, name in enumerate(fitted.columns())}
    v = vector_to_array("features")
    total = v[at["dow=7"]] * 100 + v[at["n"]] + v[at["dow_sin"]] * 10
    return fitted.transform(base).select("order_id", F.round(total, 7).alias("checksum"))


# ---- folds ------------------------------------------------------------------------------

_FOLDS_SQL = f"""{O}, kn AS (SELECT *, row_number() OVER (ORDER BY order_date, order_id) - 1 AS pos,
  count(*) OVER () AS n FROM o WHERE tip IS NOT NULL),
fo AS (SELECT *, CAST(CASE WHEN pos < n - {FOLDS} * (n // {FOLDS + 1}) THEN 0
  ELSE (pos - (n - {FOLDS} * (n // {FOLDS + 1}))) // (n // {FOLDS + 1}) + 1 END AS INTEGER) AS fold FROM kn)"""


def folded(spark, sf) -> DataFrame:
    known = src.orders(spark, sf).filter(F.col("tip").isNotNull())
    _, borders = time_series_folds(known, "order_date", "order_id", FOLDS)
    return with_test_fold(known, "order_date", "order_id", borders)


@query("m9_folds", f"WITH {_FOLDS_SQL} SELECT order_id, fold FROM fo")
def m9_folds(spark, sf):
    """test fold of every labelled order; fold i trains on all smaller numbers."""
    return folded(spark, sf).select("order_id", "fold")


@query(
    "m12_fold_accuracy",
    f"""WITH {_FOLDS_SQL}, pv AS (SELECT *, lag(tip) OVER (PARTITION BY user_id ORDER BY order_date, order_id) AS prediction FROM fo)
SELECT fold, count(*) AS orders, round(avg(CASE WHEN prediction = tip THEN 1.0 ELSE 0.0 END), 9) AS accuracy
FROM pv WHERE fold > 0 AND prediction IS NOT NULL GROUP BY fold""",
)
def m12_fold_accuracy(spark, sf):
    """Accuracy per fold of the simplest forecast: the user's previous tip."""
    rows = folded(spark, sf)
    previous = lagged_target(
        rows.select("user_id", "order_date", "order_id", "tip"), "user_id", "order_date", "order_id", "tip", 1
    ).select("order_id", F.col("tip_t-1").alias("prediction"))
    scored = rows.filter("fold > 0").join(previous, "order_id").withColumn("weight", F.lit(1.0))
    return scored.groupBy("fold").agg(
        F.count(F.lit(1)).alias("orders"), F.round(md.accuracy(), 9).alias("accuracy")
    )


# ---- models: SQL states which rows were counted, trained on, tested and scored --------------


@query(
    "m4_clusters",
    f"""WITH {O} SELECT user_id, CAST(count(*) FILTER (WHERE tip = 0) AS BIGINT) AS tips_0,
CAST(count(*) FILTER (WHERE tip = 1) AS BIGINT) AS tips_1, true AS has_cluster FROM o WHERE tip IS NOT NULL GROUP BY user_id""",
)
def m4_clusters(spark, sf):
    orders = src.orders(spark, sf)
    fitted: dict = {}
    clusters = ft.cluster_users(orders, fitted=fitted)
    counts = ft.tip_counts(orders).select("user_id", *[F.col(c).cast("long").alias(c) for c in ("tips_0", "tips_1")])
    return counts.join(clusters, "user_id", "left").select(
        "user_id", "tips_0", "tips_1", ft.in_nearest_cluster(fitted).alias("has_cluster")
    )


@query("m4_centres")
def m4_centres(spark, sf):
    """The centres themselves, in tip counts, with the users of each cluster."""
    orders = src.orders(spark, sf)
    fitted: dict = {}
    sizes = ft.cluster_users(orders, fitted=fitted).groupBy("cluster").agg(F.count(F.lit(1)).alias("users"))
    scale = list(fitted["scale"].values())
    rows = [(i, *[float(x * spread + mean) for x, (mean, spread) in zip(c, scale)]) for i, c in enumerate(fitted["centres"])]
    return spark.createDataFrame(rows, "cluster int, tips_0 double, tips_1 double").join(sizes, "cluster", "left")


def _fold_sql(source: str, folds: int = FOLDS) -> str:
    """Rows per fold, counted by position in the order of time."""
    return f"""kn AS (SELECT order_id, row_number() OVER (ORDER BY order_date, order_id) - 1 AS pos, count(*) OVER () AS n
  FROM {source}),
b AS (SELECT f, n - ({folds} - f + 1) * (n // {folds + 1}) AS start, n // {folds + 1} AS size
  FROM (SELECT DISTINCT n FROM kn), generate_series(1, {folds}) g(f))
SELECT CAST(f AS INTEGER) AS fold, CAST(start AS BIGINT) AS train_orders, CAST(size AS BIGINT) AS test_orders,
       true AS accuracy_is_share FROM b"""


def _fold_rows(
    spark, scores: dict[int, float], sizes: dict[int, tuple[int, int]], matches: dict[int, tuple[int, int]]
) -> DataFrame:
    """The accuracy must be the share of equal labels among the fold's test rows, scored one by one."""

    def is_share(fold: int, accuracy: float | None) -> bool:
        equal, n = matches[fold]
        return accuracy is not None and n == sizes[fold][1] and abs(accuracy - equal / n) < 1e-9

    rows = [(f, *sizes[f], is_share(f, a)) for f, a in sorted(scores.items())]
    return spark.createDataFrame(rows, "fold int, train_orders long, test_orders long, accuracy_is_share boolean")


def _accuracies(spark, scores: dict[int, float]) -> DataFrame:
    return spark.createDataFrame(sorted(scores.items()), "fold int, accuracy double")


@query(
    "m13_ar",
    f"""WITH {O}, pl AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY order_date, order_id) AS place
  FROM o WHERE tip IS NOT NULL), src AS (SELECT * FROM pl WHERE place > 2), {_fold_sql('src', AR_FOLDS)}""",
)
def m13_ar(spark, sf):
    """The accuracy comes from counts per user; the rows it is compared with are scored one by one."""
    trained = md.train_ar_model(src.orders(spark, sf), lags=2, folds=AR_FOLDS)
    sizes = md.fold_sizes(trained.rows, AR_FOLDS)
    matches = {f: md.judged(trained.predictions(f).withColumn("weight", F.lit(1.0)))[1] for f in trained.models}
    trained.release()
    return _fold_rows(spark, trained.fold_accuracy, sizes, matches)


@query("m13_accuracy")
def m13_accuracy(spark, sf):
    trained = md.train_ar_model(src.orders(spark, sf), lags=2, folds=AR_FOLDS)
    trained.release()
    return _accuracies(spark, trained.fold_accuracy)


@query("m14_ar_extended", f"WITH {O}, src AS (SELECT * FROM o WHERE tip IS NOT NULL), {_fold_sql('src')}")
def m14_ar_extended(spark, sf):
    trained = md.train_trend_model(src.orders(spark, sf), LAGS, FOLDS)
    return _fold_rows(spark, trained.fold_accuracy, trained.fold_sizes, trained.fold_matches)


@query("m14_accuracy")
def m14_accuracy(spark, sf):
    return _accuracies(spark, md.train_trend_model(src.orders(spark, sf), LAGS, FOLDS).fold_accuracy)


_WITH_LINES = f"""WITH {O}, src AS (SELECT * FROM o WHERE tip IS NOT NULL
  AND order_id IN (SELECT l_orderkey FROM lineitem)), {_fold_sql('src')}"""


@query("m15_final", _WITH_LINES)
def m15_final(spark, sf):
    frame = features(spark, sf, ft.cluster_users(src.orders(spark, sf)))
    trained = md.train_final_model(frame, LAGS, FOLDS)
    return _fold_rows(spark, trained.fold_accuracy, trained.fold_sizes, trained.fold_matches)


@query("m15_accuracy")
def m15_accuracy(spark, sf):
    frame = features(spark, sf, ft.cluster_users(src.orders(spark, sf)))
    return _accuracies(spark, md.train_final_model(frame, LAGS, FOLDS).fold_accuracy)


_OPEN = f"WITH {O} SELECT order_id, true AS scored FROM o WHERE tip IS NULL"


@query("m17_score", _OPEN)
def m17_score(spark, sf):
    """Train on labelled orders, score every open order of the prediction set; none may stay open.

    The strength is selected as in m14, whose folds judge the model.
    """
    orders = src.orders(spark, sf)
    trained = md.train_trend_model(orders, LAGS, folds=0)
    scored = md.reject_missing(md.score_trend(orders, trained, LAGS))
    return scored.select("order_id", F.col("tip").isNotNull().alias("scored"))


@query("m17_score_final", f"{_OPEN} AND order_id IN (SELECT l_orderkey FROM lineitem)")
def m17_score_final(spark, sf):
    """The delivered predictions: the model of all features, selected as in m15, over the open orders with lines."""
    orders, lines = src.orders(spark, sf), src.order_lines(spark, sf)
    clusters = ft.cluster_users(orders)
    trained = md.train_final_model(features(spark, sf, clusters), LAGS, folds=0)
    scored = md.score_final(orders, lines, clusters, trained, LAGS, organic_word=src.ORGANIC_STAND_IN)
    known = scored.join(lines.select("order_id").distinct(), "order_id", "left_semi")
    # Not checked by reject_missing: its filter would be moved below the semi join, to orders without lines.
    return known.select("order_id", F.col("tip").isNotNull().alias("scored"))


@query(
    "c15_no_missing_prediction",
    f"""WITH {O}, u AS (SELECT user_id, avg(tip) AS m FROM o GROUP BY 1)
SELECT order_id, coalesce(m, (SELECT avg(tip) FROM o)) >= 0.5 AS tip FROM o LEFT JOIN u USING (user_id) WHERE o.tip IS NULL""",
)
def c15_no_missing_prediction(spark, sf):
    """Predict from the user's share of tips, else from all users'; a missing prediction fails the job."""
    orders = src.orders(spark, sf)
    means = orders.groupBy("user_id").agg(F.avg("tip").alias("m"))
    overall = orders.agg(F.avg("tip").alias("m")).scalar()
    wanted = orders.filter(F.col("tip").isNull()).select("order_id", "user_id").join(means, "user_id", "left")
    return md.reject_missing(wanted.select("order_id", (F.coalesce("m", overall) >= 0.5).alias("tip")))
