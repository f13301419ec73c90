"""Current state of each entity from a log of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key as an aggregate: one row per key leaves each map task.

    ``order`` must end in a unique column so that ties are settled the same way
    on every run.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return newest.select(*[c if c in keys else f"_row.{c}" for c in df.columns])


def latest_by_rank(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The same with ``row_number() = 1``; Spark limits groups before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def without_deleted(latest: DataFrame, op: str = "op_type") -> DataFrame:
    """Drop entities whose newest change is a delete (an unknown operation is kept out too)."""
    return latest.filter(F.col(op) != "d")


def newer_than_target(
    source: DataFrame, target: DataFrame, load_ts: str, target_ts: str | None = None
) -> DataFrame:
    """Rows loaded after the newest row of the target; everything if the target is empty."""
    newest = target.agg(
        F.coalesce(F.max(target_ts or load_ts).cast("timestamp"), F.timestamp_micros(F.lit(-1).cast("long"))).alias("m")
    ).scalar()
    return source.filter(F.col(load_ts).cast("timestamp") > newest)


def upsert(target: DataFrame, delta: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Target with the delta's rows in place of those with the same key."""
    return latest_by_key(target.unionByName(delta), keys, order)
