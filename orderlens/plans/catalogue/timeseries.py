"""Lags, fills, resampling and correlation statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.operators import quality
from orderlens.operators.panel import fill, lag_columns, make_panel, shift
from orderlens.operators.series import (
    autocorrelation,
    chi_square,
    lagged_target,
    panel_acf,
    panel_pacf,
    resample_mean,
)
from orderlens.plans.catalogue.registry import CLICKS, O, query
from orderlens.plans.catalogue.relational import contingency_tables
from orderlens.plans.features import lag_features, trend_cycle_features
from orderlens.sources import stand_ins as src

LAGS = 4

FILLED = """fl AS (
  SELECT *, coalesce(
    last_value(tip IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY order_date, order_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(tip IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY order_date, order_id
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS tip_for_shifting
  FROM o)"""
_W = "OVER (PARTITION BY user_id ORDER BY order_date, order_id)"
LAG_SQL = ", ".join(f'lag(tip_for_shifting, {k}) {_W} AS "tip_t-{k}"' for k in range(1, LAGS + 1))
NAN_SQL = ", ".join(
    f'CASE WHEN lag(tip_for_shifting, {k}) {_W} IS NULL THEN 1 ELSE 0 END AS "tip_t-{k}_is_nan"'
    for k in range(1, LAGS + 1)
)


@query(
    "f2_lags",
    f"""WITH {O}, {FILLED} SELECT order_id, user_id, order_date, tip, tip IS NULL AS is_target_nan,
tip_for_shifting, {LAG_SQL}, {NAN_SQL} FROM fl""",
)
def f2_lags(spark, sf):
    """F2 + F3: lags of the filled target and their missing flags."""
    return lag_features(src.orders(spark, sf), LAGS)


@query(
    "f4_ffill",
    f"""WITH {O} SELECT order_id, last_value(tip IGNORE NULLS) OVER (PARTITION BY user_id
ORDER BY order_date, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM o""",
)
def f4_ffill(spark, sf):
    panel = make_panel(src.orders(spark, sf), ["user_id"], "order_date", "order_id")
    return fill(panel, "tip", "filled").result().select("order_id", "filled")


@query("f5_bfill", f"WITH {O}, {FILLED} SELECT order_id, tip_for_shifting AS filled FROM fl")
def f5_bfill(spark, sf):
    panel = make_panel(src.orders(spark, sf), ["user_id"], "order_date", "order_id")
    return fill(panel, "tip", "filled", backward=True).result().select("order_id", "filled")


@query(
    "f2_event_gaps",
    """SELECT event_id, user_id, lag(ts) OVER w AS previous_ts, lead(event_type) OVER w AS next_type FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def f2_event_gaps(spark, sf):
    events = src.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    panel = make_panel(events, ["user_id"], "ts", "event_id")
    panel = shift(panel, "ts", [1], ["previous_ts"])
    panel = shift(panel, "event_type", [1], ["next_type"], ahead=True)
    return panel.result().select("event_id", "user_id", "previous_ts", "next_type")


@query(
    "d15_label_write_back",
    f"""WITH {O}, {FILLED} SELECT order_id, tip_for_shifting = 1 AS tip FROM fl WHERE tip IS NULL""",
)
def d15_label_write_back(spark, sf):
    """Labels go back to open orders by order id, never by row position."""
    orders = src.orders(spark, sf)
    panel = make_panel(orders, ["user_id"], "order_date", "order_id")
    labels = fill(panel, "tip", "label", backward=True).result().select(
        "order_id", F.col("label").cast("boolean").alias("tip")
    )
    open_orders = orders.filter(F.col("tip").isNull()).select("order_id")
    return open_orders.join(labels, "order_id", "left")


_RAW_LAGS = f"""lg AS (SELECT order_id, tip, {', '.join(f'lag(tip, {k}) {_W} AS t{k}' for k in range(1, LAGS + 1))}
  FROM o WHERE tip IS NOT NULL),
cr AS (SELECT * FROM lg WHERE {' AND '.join(f't{k} IS NOT NULL' for k in range(1, LAGS + 1))})"""


@query(
    "k1_acf",
    f"""WITH {O}, {_RAW_LAGS}
{' UNION ALL '.join(f'SELECT {k} AS lag, round(corr(tip, t{k}), 8) AS acf FROM cr' for k in range(1, LAGS + 1))}""",
)
def k1_acf(spark, sf):
    known = src.orders(spark, sf).filter(F.col("tip").isNotNull())
    lagged = lagged_target(known, "user_id", "order_date", "order_id", "tip", LAGS)
    return panel_acf(lagged, "tip", LAGS).withColumn("acf", F.round("acf", 8))


def _pacf_sql() -> str:
    """Partial correlations by recursion: condition on lag 1, then 2, then 3."""
    names = ["tip"] + [f"t{k}" for k in range(1, LAGS + 1)]
    pairs = ", ".join(
        f"corr({names[i]}, {names[j]}) AS r{i}{j}"
        for i in range(LAGS + 1)
        for j in range(i + 1, LAGS + 1)
    )
    ctes = [f"p0 AS (SELECT {pairs} FROM cr)"]
    out = ["SELECT 1 AS lag, round(r01, 8) AS pacf FROM p0"]
    for m in range(1, LAGS):
        left = [0] + list(range(m + 1, LAGS + 1))

        def r(i, j):
            return f"r{min(i, j)}{max(i, j)}"

        cols = ", ".join(
            f"({r(i, j)} - {r(i, m)} * {r(j, m)}) / sqrt((1 - {r(i, m)} ** 2) * (1 - {r(j, m)} ** 2)) AS {r(i, j)}"
            for a, i in enumerate(left)
            for j in left[a + 1 :]
        )
        ctes.append(f"p{m} AS (SELECT {cols} FROM p{m - 1})")
        out.append(f"SELECT {m + 1}, round(r0{m + 1}, 8) FROM p{m}")
    return f"WITH {O}, {_RAW_LAGS}, {', '.join(ctes)} {' UNION ALL '.join(out)}"


@query("k2_pacf", _pacf_sql())
def k2_pacf(spark, sf):
    known = src.orders(spark, sf).filter(F.col("tip").isNotNull())
    lagged = lagged_target(known, "user_id", "order_date", "order_id", "tip", LAGS)
    return panel_pacf(lagged, "tip", LAGS).withColumn("pacf", F.round("pacf", 8))


_CHI = """
SELECT '{name}' AS grouping_name, round(sum((a - r * ca / n) ** 2 / (r * ca / n) + (b - r * cb / n) ** 2 / (r * cb / n)), 6) AS statistic,
       CAST(count(*) - 1 AS INTEGER) AS dof
FROM (SELECT grp, count(*) FILTER (WHERE tip = 0) AS a, count(*) FILTER (WHERE tip = 1) AS b, count(*) * 1.0 AS r,
             sum(count(*) FILTER (WHERE tip = 0)) OVER () AS ca, sum(count(*) FILTER (WHERE tip = 1)) OVER () AS cb,
             sum(count(*)) OVER () AS n
      FROM (SELECT {expr} AS grp, tip FROM ev) GROUP BY grp)"""


@query(
    "k3_chi2",
    "WITH "
    + CLICKS
    + " UNION ALL ".join(
        _CHI.format(name=n, expr=e)
        for n, e in (
            ("weekday", "strftime(order_date, '%A')"),
            ("hour", "CAST(hour(order_date) AS VARCHAR)"),
            ("weekday_hour", "strftime(order_date, '%A_%H')"),
        )
    ),
)
def k3_chi2(spark, sf):
    return quality.report(
        [
            chi_square(table).select(
                F.lit(name).alias("grouping_name"), F.round("statistic", 6).alias("statistic"), "dof"
            )
            for name, table in contingency_tables(spark, sf).items()
        ]
    )


@query(
    "k3_chi2_weekday_p",
    "WITH "
    + CLICKS
    + ", c AS ("
    + _CHI.format(name="weekday", expr="strftime(order_date, '%A')").replace("round(sum(", "(sum(").replace(", 6) AS statistic", ") AS statistic")
    + """)
SELECT round(exp(-statistic / 2) * (1 + statistic / 2 + (statistic / 2) ** 2 / 2), 9) AS p_value FROM c""",
)
def k3_chi2_weekday_p(spark, sf):
    """Six degrees of freedom have a closed tail probability, which SQL can state."""
    table = contingency_tables(spark, sf)["weekday"]
    return chi_square(table).select(F.round("p_value", 9).alias("p_value"))


def _resample_sql(unit: str) -> str:
    return f"""b AS (SELECT date_trunc('{unit}', order_date) AS bin, avg(tip) AS m FROM ev GROUP BY 1),
sp AS (SELECT unnest(generate_series((SELECT min(bin) FROM b), (SELECT max(bin) FROM b), INTERVAL 1 {unit})) AS bin),
rs AS (SELECT CAST(sp.bin AS TIMESTAMP) AS bin, b.m AS mean_value FROM sp LEFT JOIN b ON sp.bin = b.bin)"""


for _unit in ("day", "hour"):

    @query(
        f"k4_resample_{_unit}",
        f"WITH {CLICKS}, {_resample_sql(_unit)} SELECT bin, round(mean_value, 9) AS mean_value FROM rs",
    )
    def k4_resample(spark, sf, unit=_unit):
        return resample_mean(src.clicks(spark, sf), "order_date", "tip", unit).select(
            "bin", F.round("mean_value", 9).alias("mean_value")
        )


@query(
    "k4_resample_orders",
    f"""WITH {O.replace('o AS', 'ev AS', 1)}, {_resample_sql('day')}
SELECT bin, round(mean_value, 9) AS mean_value FROM rs""",
)
def k4_resample_orders(spark, sf):
    return resample_mean(src.orders(spark, sf), "order_date", "tip", "day").select(
        "bin", F.round("mean_value", 9).alias("mean_value")
    )


def _autocorr_sql(unit: str, lags: list[int]) -> str:
    return " UNION ALL ".join(
        f"""SELECT {k} AS lag, round(corr(a.mean_value, z.mean_value), 8) AS autocorr
FROM rs a JOIN rs z ON a.bin = z.bin + INTERVAL {k} {unit}"""
        for k in lags
    )


@query(
    "k5_autocorr_day",
    f"WITH {O.replace('o AS', 'ev AS', 1)}, {_resample_sql('day')} {_autocorr_sql('day', [1, 7])}",
)
def k5_autocorr_day(spark, sf):
    daily = resample_mean(src.orders(spark, sf), "order_date", "tip", "day")
    return autocorrelation(daily, "day", [1, 7]).withColumn("autocorr", F.round("autocorr", 8))


@query(
    "k5_autocorr_hour",
    f"WITH {CLICKS}, {_resample_sql('hour')} {_autocorr_sql('hour', [24, 168])}",
)
def k5_autocorr_hour(spark, sf):
    """the same on an hourly series."""
    hourly = resample_mean(src.clicks(spark, sf), "order_date", "tip", "hour")
    return autocorrelation(hourly, "hour", [24, 168]).withColumn("autocorr", F.round("autocorr", 8))


@query(
    "k6_trend_cycle",
    f"""WITH {O}, {FILLED}, g AS (SELECT *, {LAG_SQL} FROM fl)
SELECT order_id, tip,
  (epoch_us(order_date) - (SELECT epoch_us(min(order_date)) FROM o)) // 86400000000 AS days_since_start,
  CAST(isodow(order_date) - 1 AS INTEGER) AS weekday,
  round(sin(2 * pi() * (isodow(order_date) - 1) / 7), 9) AS weekday_sin,
  round(cos(2 * pi() * (isodow(order_date) - 1) / 7), 9) AS weekday_cos,
  {', '.join(f'coalesce("tip_t-{k}", -1) AS "tip_t-{k}"' for k in range(1, LAGS + 1))},
  {', '.join(f'CASE WHEN "tip_t-{k}" IS NULL THEN 1 ELSE 0 END AS "tip_t-{k}_is_nan"' for k in range(1, LAGS + 1))}
FROM g""",
)
def k6_trend_cycle(spark, sf):
    _, names = lag_columns(LAGS)
    return trend_cycle_features(src.orders(spark, sf), LAGS).select(
        "order_id",
        "tip",
        "days_since_start",
        "weekday",
        F.round("weekday_sin", 9).alias("weekday_sin"),
        F.round("weekday_cos", 9).alias("weekday_cos"),
        *names,
        *[f"{n}_is_nan" for n in names],
    )
