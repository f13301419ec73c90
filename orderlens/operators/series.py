"""Time-series statistics over aggregated bins and over panels."""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators.panel import lag_columns, make_panel, shift
from orderlens.operators.skew import LIMITS, SkewLimits

# Supported bin widths.
BINS = {"day": "INTERVAL 1 DAY", "hour": "INTERVAL 1 HOUR"}


def resample_mean(df: DataFrame, ts: str, value: str, unit: str) -> DataFrame:
    """Mean per bin from the first to the last bin; empty bins are null.

    The spine is as long as the time span divided by the bin, whatever the rows.
    """
    if unit not in BINS:
        raise ValueError(f"unit must be one of {', '.join(BINS)}")
    bins = df.groupBy(F.date_trunc(unit, F.col(ts).cast("timestamp")).alias("bin")).agg(
        F.avg(value).alias("mean_value")
    )
    spine = bins.filter(F.col("bin").isNotNull()).agg(
        F.min("bin").alias("a"), F.max("bin").alias("b")
    ).select(F.explode(F.sequence("a", "b", F.expr(BINS[unit]))).alias("bin"))
    return spine.join(bins, "bin", "left").withColumn("bin", F.col("bin").cast("timestamp_ntz"))


def autocorrelation(series: DataFrame, unit: str, lags: list[int]) -> DataFrame:
    """Correlation of a binned series with itself ``lag`` bins earlier; null pairs are left out.

    Each bin is joined to the bin ``lag`` steps before by equality on the bin
    start, so no window over the whole series is needed.
    """
    step = F.expr(BINS[unit])
    now = series.select(F.col("bin").alias("_b"), F.col("mean_value").alias("_y"))
    earlier = series.select("bin", F.col("mean_value").alias("_x")).withColumn(
        "lag", F.explode(F.array(*[F.lit(k) for k in lags]))
    )
    moved = earlier.select((F.col("bin") + step * F.col("lag")).alias("_b"), "lag", "_x")
    return moved.join(now, "_b").groupBy("lag").agg(F.corr("_y", "_x").alias("autocorr"))


def lagged_target(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    target: str,
    lags: int,
    limits: SkewLimits = LIMITS,
) -> DataFrame:
    """Complete rows of the target and its per-key lags."""
    steps, names = lag_columns(lags)
    panel = make_panel(df.select(key, ts, tie, target), [key], ts, tie, limits=limits)
    return shift(panel, target, steps, names).result().na.drop(subset=[target, *names])


def panel_acf(lagged: DataFrame, target: str, lags: int) -> DataFrame:
    """Correlation of the target with each lag, all lags from one aggregate."""
    _, names = lag_columns(lags)
    wide = lagged.agg(*[F.corr(target, f"`{n}`").alias(f"c{i}") for i, n in enumerate(names, 1)])
    pairs = ", ".join(f"{i}, c{i}" for i in range(1, lags + 1))
    return wide.selectExpr(f"stack({lags}, {pairs}) as (lag, acf)")


def panel_pacf(lagged: DataFrame, target: str, lags: int) -> DataFrame:
    """Partial autocorrelation per lag from one pass over the rows.

    Spark sums the cross products of target and lags; the driver sees only that
    (lags + 1) square matrix. Correlating regression residuals equals the
    partial correlation read from the inverse of its leading block.
    """
    _, names = lag_columns(lags)
    cols = [target, *[f"`{n}`" for n in names]]
    pairs = list(combinations_with_replacement(range(lags + 1), 2))
    sums = lagged.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
        *[
            F.sum(F.col(cols[i]).cast("double") * F.col(cols[j]).cast("double")).alias(f"p{i}_{j}")
            for i, j in pairs
        ],
    ).first()
    values: list[tuple[int, float | None]] = []
    n = sums["n"]
    cov = np.zeros((lags + 1, lags + 1))
    if n:
        for i, j in pairs:
            cov[i, j] = cov[j, i] = sums[f"p{i}_{j}"] / n - sums[f"s{i}"] / n * (sums[f"s{j}"] / n)
    for k in range(1, lags + 1):
        values.append((k, _last_partial(cov[: k + 1, : k + 1]) if n > 1 else None))
    return lagged.sparkSession.createDataFrame(
        values, T.StructType([T.StructField("lag", T.IntegerType()), T.StructField("pacf", T.DoubleType())])
    )


def _last_partial(cov: np.ndarray) -> float | None:
    """Correlation of the first and last variable given those between."""
    try:
        precision = np.linalg.inv(cov)
    except np.linalg.LinAlgError:
        return None
    out = -precision[0, -1] / math.sqrt(precision[0, 0] * precision[-1, -1])
    return None if math.isnan(out) else float(out)


def contingency(df: DataFrame, group: Column, flag: str, name: str = "grp") -> DataFrame:
    """Counts of flag 0 and 1 per group as one conditional aggregate; null flags do not count."""
    return (
        df.filter(F.col(flag).isNotNull())
        .groupBy(group.alias(name))
        .agg(
            F.count_if(F.col(flag) == 0).alias("no_tip"),
            F.count_if(F.col(flag) == 1).alias("with_tip"),
        )
        .filter(F.col(name).isNotNull())
    )


def chi_square(table: DataFrame, name: str = "grp") -> DataFrame:
    """Independence test of a two-column contingency table: statistic, degrees, p-value."""
    totals = table.agg(
        F.struct(F.sum("no_tip").alias("a"), F.sum("with_tip").alias("b")).alias("t")
    ).scalar()
    cells = table.withColumn("_t", totals)
    n = F.col("_t.a") + F.col("_t.b")
    row = F.col("no_tip") + F.col("with_tip")

    def term(observed: str, column_total: Column) -> Column:
        expected = row * column_total / n
        return F.pow(F.col(observed) - expected, F.lit(2)) / expected

    return cells.agg(
        F.sum(term("no_tip", F.col("_t.a")) + term("with_tip", F.col("_t.b"))).alias("statistic"),
        (F.count(name) - 1).cast("int").alias("dof"),
    ).withColumn("p_value", _chi_square_tail(F.col("statistic"), F.col("dof")))


@F.pandas_udf(T.DoubleType())
def _chi_square_tail(statistic, dof):
    """Upper tail of the chi-square distribution on the single result row of a test."""
    return statistic.combine(dof, chi_square_tail)


def chi_square_tail(x: float, dof: int) -> float | None:
    """Finite sums exist for whole degrees of freedom: plain for even, with erfc for odd ones."""
    if x is None or dof is None or math.isnan(x) or dof < 1:
        return None
    h = x / 2
    if h <= 0:
        return 1.0
    start = 0.0 if dof % 2 == 0 else 0.5
    total = 0.0 if dof % 2 == 0 else math.erfc(math.sqrt(h))
    count = dof // 2 if dof % 2 == 0 else (dof - 1) // 2
    for j in range(count):
        power = start + j
        total += math.exp(power * math.log(h) - h - math.lgamma(power + 1))
    return min(1.0, total)
