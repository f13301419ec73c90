"""Feature steps for tip models, each a DataFrame -> DataFrame function.

Frames: orders (order_id, user_id, order_date, tip) and order lines in their
denormalised form (order_id, product_name, department, add_to_cart_order).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import whole_days_between
from orderlens.functions.holidays import dim_holiday, is_holiday
from orderlens.functions.scalars import contains_word, cyclic
from orderlens.operators.panel import (
    fill,
    find_heavy_spans,
    group_sums,
    lag_columns,
    make_panel,
    shift,
)
from orderlens.operators.skew import DETECT, LIMITS, SkewLimits, salted_join

ORGANIC_WORD = "organic"
CLUSTERS = 4
CLUSTER_SEED = 42
CLUSTER_RESTARTS = 10
POINTS_PER_TASK = 200_000
LOCAL_DEPARTMENTS = 10_000


def date_conversion(df: DataFrame, min_date: Column | None = None) -> DataFrame:
    """Whole days since the first order (or a given start)."""
    if min_date is None:
        min_date = df.agg(F.min("order_date").alias("m")).scalar()
    return df.withColumn("days_since_start", whole_days_between(min_date, "order_date"))


def lag_features(
    df: DataFrame,
    lags: int,
    backfill: bool = True,
    heavy: DataFrame | None | str = DETECT,
    limits: SkewLimits = LIMITS,
) -> DataFrame:
    """Lags 1..n of the gap-filled target per user, and 0/1 flags for missing lags.

    ``backfill=False`` avoids pulling later targets into the first orders.
    """
    steps, names = lag_columns(lags)
    marked = df.withColumn("is_target_nan", F.col("tip").isNull())
    panel = make_panel(marked, ["user_id"], "order_date", "order_id", heavy, limits)
    panel = fill(panel, "tip", "tip_for_shifting", backward=backfill)
    out = shift(panel, "tip_for_shifting", steps, names).result()
    return out.withColumns({f"{n}_is_nan": F.col(n).isNull().cast("int") for n in names})


def temporal_features(df: DataFrame) -> DataFrame:
    """Weekday (Monday = 0), hour and US-holiday flag."""
    return df.withColumns(
        {
            "weekday": F.weekday("order_date"),
            "hour": F.hour("order_date"),
            "is_holiday": is_holiday("to_date(order_date)"),
        }
    )


def holiday_lookup(df: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """The holiday flag as a join with the generated holiday dimension (about 16 rows per year).

    Without years it spans those of the data.
    """
    if first_year is None or last_year is None:
        span = df.agg(F.year(F.min("order_date")).alias("a"), F.year(F.max("order_date")).alias("z")).first()
        first_year, last_year = span["a"] or 1970, span["z"] or 1970
    days = dim_holiday(df.sparkSession, first_year, last_year).select("holiday_date").distinct()
    flagged = days.withColumn("is_holiday", F.lit(True))
    return (
        df.withColumn("_d", F.to_date("order_date"))
        .join(F.broadcast(flagged), F.col("_d") == F.col("holiday_date"), "left")
        .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))
        .drop("_d", "holiday_date")
    )


# ---- order lines ---------------------------------------------------------


def cart_size(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(F.max("add_to_cart_order").alias("cart_size"))


def with_cart_size(df: DataFrame, lines: DataFrame) -> DataFrame:
    """Inner join: orders without lines are dropped."""
    return df.join(cart_size(lines), "order_id")


def with_organic_flag(df: DataFrame, lines: DataFrame, word: str = ORGANIC_WORD) -> DataFrame:
    flags = lines.groupBy("order_id").agg(
        F.bool_or(contains_word("product_name", word)).alias("order_contains_organic")
    )
    return df.join(flags, "order_id", "left").withColumn(
        "order_contains_organic", F.coalesce("order_contains_organic", F.lit(False))
    )


def with_user_mean(df: DataFrame, value: str, name: str, limits: SkewLimits = LIMITS) -> DataFrame:
    """Mean of a column over the user's orders, on every order."""
    means = df.groupBy("user_id").agg(F.avg(value).alias(name))
    return salted_join(df, means, ["user_id"], "inner", ["order_id"], limits=limits)


def with_order_count(df: DataFrame, limits: SkewLimits = LIMITS) -> DataFrame:
    """Number of different orders of the user, on every order."""
    counts = df.groupBy("user_id").agg(F.countDistinct("order_id").alias("no_orders"))
    return salted_join(df, counts, ["user_id"], "left", ["order_id"], limits=limits)


# ---- target rates ---------------------------------------------------------


def rate_by(df: DataFrame, group: str, name: str) -> DataFrame:
    """Tip rate in percent per group; unknown targets do not count."""
    return df.groupBy(group).agg((F.avg("tip") * 100).alias(name))


def overall_rate(df: DataFrame) -> DataFrame:
    return df.agg((F.avg("tip") * 100).alias("overall_tip_proba"))


def department_sums(orders: DataFrame, lines: DataFrame, limits: SkewLimits = LIMITS) -> DataFrame:
    """Lines and tipped lines per department over labelled orders."""
    known = orders.filter(F.col("tip").isNotNull()).select("order_id", "tip")
    joined = salted_join(
        lines.select("order_id", "department", "add_to_cart_order"),
        known,
        ["order_id"],
        "inner",
        ["add_to_cart_order", "department"],
        limits=limits,
    )
    return joined.groupBy("department").agg(F.count(F.lit(1)).alias("n"), F.sum("tip").alias("t"))


def department_rates(orders: DataFrame, lines: DataFrame, limits: SkewLimits = LIMITS) -> DataFrame:
    """Tip rate in percent per department at line grain."""
    return department_sums(orders, lines, limits).select(
        "department", (F.col("t") / F.col("n") * 100).alias("tip_proba_per_department")
    )


@dataclass(frozen=True)
class TipRates:
    """Target rates learned on one frame and applied to any other (no leakage across folds).

    Hours and weekdays are a handful of numbers and are applied as literals.
    Department rates stay a table: a local one up to ``LOCAL_DEPARTMENTS`` rows,
    which is safe to broadcast, else whatever join Spark picks.
    """

    overall: float | None
    by_hour: dict[int, float]
    by_weekday: dict[int, float]
    by_department: DataFrame

    @staticmethod
    def fit(train: DataFrame, lines: DataFrame, limits: SkewLimits = LIMITS) -> "TipRates":
        """Rates over the labelled orders of ``train`` that have lines."""
        with_lines = lines.select("order_id").distinct()
        known = train.filter(F.col("tip").isNotNull()).join(with_lines, "order_id", "left_semi")
        grid = (
            known.groupBy(F.hour("order_date").alias("hour"), F.weekday("order_date").alias("weekday"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("tip").alias("t"))
            .collect()
        )  # at most 24 * 7 rows

        def percent(cells: list) -> float | None:
            n = sum(c["n"] for c in cells)
            return sum(c["t"] for c in cells) / n * 100 if n else None

        def split(field: str) -> dict[int, float]:
            values = {c[field] for c in grid}
            return {v: percent([c for c in grid if c[field] == v]) for v in values}

        rates = department_rates(train, lines, limits)
        few = rates.limit(LOCAL_DEPARTMENTS + 1).collect()
        if len(few) <= LOCAL_DEPARTMENTS:
            rates = F.broadcast(train.sparkSession.createDataFrame(few, rates.schema))
        return TipRates(percent(grid), split("hour"), split("weekday"), rates)

    def transform(self, df: DataFrame) -> DataFrame:
        def lookup(table: dict[int, float], key: str) -> Column:
            if not table:
                return F.lit(None).cast("double")
            return F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair])[F.col(key)]

        return df.withColumns(
            {
                "overall_tip_proba": F.lit(self.overall).cast("double"),
                "tip_proba_per_hour": lookup(self.by_hour, "hour"),
                "tip_proba_per_weekday": lookup(self.by_weekday, "weekday"),
            }
        )


# ---- user clusters ---------------------------------------------------------


def tip_counts(df: DataFrame) -> DataFrame:
    """Labelled orders per user by target value, missing = 0."""
    return (
        df.filter(F.col("tip").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count_if(F.col("tip") == 0).alias("tips_0"),
            F.count_if(F.col("tip") == 1).alias("tips_1"),
        )
    )


def cluster_users(
    df: DataFrame,
    k: int = CLUSTERS,
    seed: int = CLUSTER_SEED,
    restarts: int = CLUSTER_RESTARTS,
    fitted: dict | None = None,
) -> DataFrame:
    """k-means over standardised tip counts: ``(user_id, cluster)``.

    Users with the same two counts are the same point, so the fit runs on the
    distinct pairs with the number of users as weight. Best of several seeds;
    cluster ids follow the order of the centres. ``fitted``, if given, receives
    the ``centres`` in that order and the ``scale`` (mean, spread) of each count.
    """
    counts = tip_counts(df)
    columns = ("tips_0", "tips_1")
    points = counts.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("w")).persist()
    try:
        w, total = F.col("w"), F.sum("w")
        stats = points.agg(
            *[(F.sum(w * F.col(c)) / total).alias(f"m_{c}") for c in columns],
            *[(F.sum(w * F.col(c) * F.col(c)) / total).alias(f"q_{c}") for c in columns],
        ).first()
        scale = {}
        for c in columns:
            mean = stats[f"m_{c}"] or 0.0
            spread = max((stats[f"q_{c}"] or 0.0) - mean * mean, 0.0) ** 0.5
            scale[c] = (mean, spread or 1.0)

        def vectors(frame: DataFrame) -> DataFrame:
            z = {f"z_{c}": (F.col(c) - m) / s for c, (m, s) in scale.items()}
            return VectorAssembler(inputCols=list(z), outputCol="features").transform(
                frame.withColumns(z)
            )

        # Few distinct pairs need few tasks: every iteration is a job of its own.
        weighted = vectors(points.coalesce(max(1, points.count() // POINTS_PER_TASK)))
        # Restarts are independent and small; a few run side by side in one session.
        with ThreadPoolExecutor(max_workers=4) as pool:
            models = list(
                pool.map(
                    lambda i: KMeans(k=k, seed=seed + i, weightCol="w").fit(weighted),
                    range(restarts),
                )
            )
    finally:
        points.unpersist()
    best = min(models, key=lambda m: m.summary.trainingCost)
    by_centre = sorted(enumerate(tuple(c) for c in best.clusterCenters()), key=lambda e: e[1])
    if fitted is not None:
        fitted.update(centres=[c for _, c in by_centre], scale=scale)
    rename = F.create_map(*[F.lit(x) for new, (old, _) in enumerate(by_centre) for x in (old, new)])
    return best.transform(vectors(counts)).select(
        "user_id", rename[F.col("prediction")].alias("cluster")
    )


def in_nearest_cluster(fitted: dict) -> Column:
    """Whether no centre is nearer to a row's tip counts than that of its cluster."""
    z = [(F.col(c) - m) / s for c, (m, s) in fitted["scale"].items()]
    away = F.array(*[sum(((x - v) * (x - v) for x, v in zip(z, c)), F.lit(0.0)) for c in fitted["centres"]])
    return F.coalesce(F.get(away, F.col("cluster")) <= F.array_min(away) + 1e-9, F.lit(False))


def with_clusters(
    df: DataFrame, clusters: DataFrame, heavy: DataFrame | None | str = DETECT
) -> DataFrame:
    """Cluster as text; users without a cluster get -1."""
    joined = salted_join(df, clusters, ["user_id"], "left", ["order_id"], heavy)
    return joined.withColumn("cluster", F.coalesce("cluster", F.lit(-1)).cast("string"))


# ---- the whole chain ---------------------------------------------------------


def basket_frame(lines: DataFrame, rates: TipRates, organic_word: str = ORGANIC_WORD) -> DataFrame:
    """One row per order with lines, in one aggregate: cart size, organic flag, mean department rate."""
    rated = lines.join(rates.by_department, "department", "left")
    return rated.groupBy("order_id").agg(
        F.max("add_to_cart_order").alias("cart_size"),
        F.coalesce(F.bool_or(contains_word("product_name", organic_word)), F.lit(False)).alias(
            "order_contains_organic"
        ),
        F.avg("tip_proba_per_department").alias("tip_proba_per_department"),
    )


def feature_frame(
    orders: DataFrame,
    lines: DataFrame,
    lags: int,
    min_date: Column | None = None,
    clusters: DataFrame | None = None,
    rates: TipRates | None = None,
    organic_word: str = ORGANIC_WORD,
    backfill: bool = True,
    limits: SkewLimits = LIMITS,
) -> DataFrame:
    """All features on one row per order that has lines.

    Orders come one row per order. Lines are summed per order first, then orders
    and sums are joined once; lags, order count and mean cart size share one
    shuffle by user. Whole-frame rates by default; pass ``rates`` fitted on a
    training part to keep the test part out of them. ``clusters`` is optional
    because fitting runs jobs.
    """
    # Users are counted once; every step by user is spread by the same table.
    heavy = find_heavy_spans(orders, ["user_id"], "order_date", "order_id", limits)
    if rates is None:
        rates = TipRates.fit(orders, lines, limits)
    basket = basket_frame(lines, rates, organic_word)
    # Dates and lags need every order, also those without lines.
    df = date_conversion(orders.join(basket, "order_id", "left"), min_date)
    df = lag_features(df, lags, backfill, heavy)
    panel = make_panel(df, ["user_id"], "order_date", "order_id", heavy)
    sized = F.col("cart_size").isNotNull().cast("long")
    panel = group_sums(
        panel, {"no_orders": F.lit(1), "_lines": F.col("cart_size").cast("long"), "_sized": sized}
    )
    df = panel.result().withColumn("avg_no_prod", F.col("_lines") / F.col("_sized"))
    df = df.filter(F.col("cart_size").isNotNull()).drop("_lines", "_sized")
    if clusters is not None:
        df = with_clusters(df, clusters, heavy)
    return rates.transform(temporal_features(df))


def trend_cycle_features(
    orders: DataFrame,
    lags: int,
    min_date: Column | None = None,
    limits: SkewLimits = LIMITS,
) -> DataFrame:
    """Trend, weekday cycle and lags with missing lags as -1; the user column is dropped."""
    heavy = find_heavy_spans(orders, ["user_id"], "order_date", "order_id", limits)
    df = lag_features(date_conversion(orders, min_date), lags, True, heavy)
    df = df.withColumn("weekday", F.weekday("order_date"))
    sin, cos = cyclic("weekday", 7)
    _, names = lag_columns(lags)
    return (
        df.withColumns({n: F.coalesce(F.col(n), F.lit(-1)) for n in names})
        .withColumns({"weekday_sin": sin, "weekday_cos": cos})
        .drop("user_id")
    )
