"""Heavy keys: find them, split them, join through them.

A key that holds a large share of all rows must not end up in one task. Heavy
keys are looked for once, by a count over the key columns alone (combined on the
map side), and cut into pieces. Where there are none, plans stay plain.

With ``limit = max(min_rows, share * total)`` at most ``1 / share`` keys can be
above the limit, and all their pieces together number at most ``2 / share``.
That bound is why the heavy-key table may be collected and broadcast at any scale.
The table only steers how rows are spread; results do not depend on it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DETECT = "detect"


@dataclass(frozen=True)
class SkewLimits:
    """A key is heavy above ``max(min_rows, share * total)`` rows."""

    share: float = 1e-4
    min_rows: int = 1_000_000


LIMITS = SkewLimits()


def find_heavy(
    df: DataFrame, keys: list[str], limits: SkewLimits = LIMITS, stats: list[Column] | None = None
) -> DataFrame | None:
    """Heavy keys with ``_pieces`` (and extra statistics), or None when there are none.

    Pass a cheap frame that has the key columns, such as the scan, rather than
    the end of a long plan. No key can be heavy in a frame of ``min_rows`` rows,
    so small inputs cost a row count, which Parquet answers from its footers.
    """
    total = df.count()
    if total <= limits.min_rows:
        return None
    limit = max(float(limits.min_rows), total * limits.share)
    found = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), *(stats or []))
        .filter(F.col("_n") > limit)
        .withColumn("_pieces", F.ceil(F.col("_n") / limit).cast("long"))
        .drop("_n")
    )
    rows = found.collect()  # at most 1 / share rows
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def _matches(df: DataFrame, side: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [df[k].eqNullSafe(side[f"_heavy_{k}"]) for k in keys])


def mark_heavy(df: DataFrame, keys: list[str], heavy: DataFrame) -> DataFrame:
    """Attach the heavy-key columns (null on ordinary keys). The null key may be heavy too."""
    side = heavy.withColumnsRenamed({k: f"_heavy_{k}" for k in keys})
    joined = df.join(F.broadcast(side), _matches(df, side, keys), "left")
    return joined.drop(*[f"_heavy_{k}" for k in keys])


def heavy_rows(df: DataFrame, keys: list[str], heavy: DataFrame) -> DataFrame:
    """Rows of heavy keys only."""
    side = heavy.select(*[F.col(k).alias(f"_heavy_{k}") for k in keys])
    return df.join(F.broadcast(side), _matches(df, side, keys), "left_semi")


def salted_join(
    many: DataFrame,
    one: DataFrame,
    keys: list[str],
    how: str,
    spread_by: list[str],
    heavy: DataFrame | None | str = None,
    limits: SkewLimits = LIMITS,
) -> DataFrame:
    """Join a large table with one row (or few) per key, splitting heavy keys of the large side.

    By default this is the plain join: adaptive execution splits skewed partitions at run time, and nothing
    is counted while a query is built. Pass heavy keys that are known (or DETECT) to salt them by hand.

    Rows of a heavy key are dealt to its pieces by a hash of ``spread_by``; the
    other side is copied once per piece of that key only. Ordinary keys join as
    usual, so the result equals ``many.join(one, keys, how)``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if isinstance(heavy, str):
        heavy = find_heavy(many.select(*keys), keys, limits)
    if heavy is None:
        return many.join(one, keys, how)
    heavy = heavy.select(*keys, "_pieces")
    left = mark_heavy(many, keys, heavy).withColumn(
        "_salt",
        F.when(
            F.col("_pieces").isNotNull(),
            F.pmod(F.xxhash64(*spread_by), F.col("_pieces")),
        ).otherwise(F.lit(0)),
    )
    right = mark_heavy(one, keys, heavy).withColumn(
        "_salt",
        F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)) - 1)),
    )
    return left.drop("_pieces").join(right.drop("_pieces"), [*keys, "_salt"], how).drop("_salt")
