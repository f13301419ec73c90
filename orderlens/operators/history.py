"""Type-2 history: from a full change log in one pass, or run by run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import micros
from orderlens.functions.scalars import version_id
from orderlens.operators.panel import find_heavy_spans, make_panel, shift
from orderlens.operators.skew import LIMITS, SkewLimits


def scd_id(key: str, valid_from: str) -> Column:
    return version_id(F.col(key), micros(valid_from))


def history_from_changes(
    changes: DataFrame,
    key: str,
    ts: str,
    op: str,
    tie: str,
    attributes: list[str],
    limits: SkewLimits = LIMITS,
) -> DataFrame:
    """Every version of every key. Changes at one instant collapse to the last by ``tie``.

    A version ends where the next change of its key begins; a delete opens no
    version of its own, it only ends the one before.
    """
    per_instant = (
        changes.filter(F.col(ts).isNotNull())
        .groupBy(key, ts)
        .agg(
            F.max_by(F.struct(op, *attributes), F.col(tie)).alias("_r"),
            F.max(tie).alias("_tie"),
        )
        .select(key, ts, "_tie", "_r.*")
    )
    # Counted on the log itself, which is cheaper than the collapsed rows.
    heavy = find_heavy_spans(changes.withColumnRenamed(tie, "_tie"), [key], ts, "_tie", limits)
    panel = make_panel(per_instant, [key], ts, "_tie", heavy)
    closed = shift(panel, ts, [1], ["valid_to"], ahead=True).result()
    return closed.filter(F.col(op) != "d").select(
        key,
        *attributes,
        scd_id(key, ts).alias("scd_id"),
        F.col(ts).alias("valid_from"),
        "valid_to",
    )


def snapshot_step(
    history: DataFrame,
    source: DataFrame,
    key: str,
    updated_at: str,
    invalidate_missing: bool = True,
    now: Column | None = None,
) -> DataFrame:
    """One snapshot run: open new and changed keys, close replaced and (optionally) missing ones.

    One full outer join of open versions with the source, at most one row per key
    on each side; a changed key leaves it as two rows (closed, opened).
    """
    now = F.current_timestamp() if now is None else now
    attributes = [c for c in source.columns if c not in (key, updated_at)]
    ts_type = history.schema["valid_from"].dataType
    closed = history.filter(F.col("valid_to").isNotNull())
    opened = history.filter(F.col("valid_to").isNull()).select(
        key, F.struct(*history.columns).alias("_old")
    )
    incoming = source.select(
        key,
        F.struct(
            *[
                F.col(c).cast(history.schema[c].dataType).alias(c)
                if c in (key, *attributes)
                else {
                    updated_at: F.col(updated_at).cast(ts_type),
                    "scd_id": scd_id(key, updated_at),
                    "valid_from": F.col(updated_at).cast(ts_type),
                    "valid_to": F.lit(None).cast(ts_type),
                }[c].alias(c)
                for c in history.columns
            ]
        ).alias("_new"),
    )
    both = opened.join(incoming, key, "full_outer")

    is_changed = F.col("_old").isNotNull() & (F.col("_new.valid_from") > F.col("_old.valid_from"))
    is_missing = F.col("_new").isNull()

    def old_until(end: Column) -> Column:
        return F.col("_old").withField("valid_to", end.cast(ts_type))

    when_missing = F.array(old_until(now) if invalidate_missing else F.col("_old"))
    outcome = (
        F.when(F.col("_old").isNull(), F.array(F.col("_new")))
        .when(is_missing, when_missing)
        .when(is_changed, F.array(old_until(F.col("_new.valid_from")), F.col("_new")))
        .otherwise(F.array(F.col("_old")))
    )
    return closed.unionByName(both.select(F.explode(outcome).alias("_r")).select("_r.*"))


def open_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col("valid_to").isNull())
