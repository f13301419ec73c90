"""Positions in a total order without a single-partition window.

Rows are range-partitioned by the order; a count per range gives each range its
offset. Range bounds come from a sample, so the ranged rows are checkpointed
before they are counted: both passes must see the same ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import reliable_checkpoint

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def global_rank(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Zero-based position of every row by ``order`` (which must be unique)."""
    tagged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            *df.columns,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1).alias("_row"),
        )
    )
    ranged = reliable_checkpoint(tagged)
    # One row per range; their number is the number of shuffle partitions, not of rows.
    parts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + F.col("_row"))
        .drop("_part", "_row", "_off")
    )


@dataclass(frozen=True)
class FoldBorder:
    """First row of a test fold in the order (ts, tie) and its position."""

    fold: int
    position: int
    ts: object
    tie: int


def border_rows(df: DataFrame, ts: str, tie: str, positions: list[int]) -> list[tuple[int, object, int]]:
    """Rows at the given zero-based positions of the order ``(ts, tie)``.

    Counts per day (a calendar, not the data) locate the days that hold a
    position; only those days are ranked. A day of any size is fine, because the
    ranking range-partitions it by ``(ts, tie)``.
    """
    if not positions:
        return []
    # Bounded by the calendar: one row per day present.
    days = (
        df.groupBy(F.to_date(ts).alias("_day"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_n").over(
                    Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
    )
    wanted = F.array(*[F.lit(p).cast("long") for p in sorted(set(positions))])
    hits = (
        days.withColumn("_p", F.explode(wanted))
        .filter((F.col("_p") >= F.col("_before")) & (F.col("_p") < F.col("_before") + F.col("_n")))
        .collect()
    )  # at most one row per wanted position
    day_list = sorted({r["_day"] for r in hits})
    size = {r["_day"]: r["_n"] for r in hits}
    base, start = {}, 0
    for d in day_list:
        base[d], start = start, start + size[d]
    target = {base[r["_day"]] + r["_p"] - r["_before"]: r["_p"] for r in hits}

    candidates = df.select(ts, tie).filter(F.to_date(ts).isin(day_list))
    ranked = global_rank(candidates, [ts, tie], "_pos").filter(F.col("_pos").isin(list(target)))
    found = [(target[r["_pos"]], r[ts], r[tie]) for r in ranked.collect()]
    return sorted(found)


def time_series_folds(df: DataFrame, ts: str, tie: str, folds: int) -> tuple[int, list[FoldBorder]]:
    """Borders of ``folds`` chronological splits: test size ``n // (folds + 1)``, growing train prefix."""
    n = df.count()
    test = n // (folds + 1)
    if test == 0:
        raise ValueError(f"{n} rows are too few for {folds} folds")
    starts = [n - (folds - i) * test for i in range(folds)]
    rows = border_rows(df, ts, tie, starts)
    return n, [FoldBorder(i + 1, p, t, k) for i, (p, t, k) in enumerate(rows)]


def with_test_fold(df: DataFrame, ts: str, tie: str, borders: list[FoldBorder], name: str = "fold") -> DataFrame:
    """Test fold of every row (0 = before the first test fold): literal comparisons, no shuffle.

    Fold ``i`` trains on rows with a smaller fold number and tests on rows equal to ``i``.
    """
    dtype = df.schema[ts].dataType
    fold = F.lit(0)
    for b in borders:
        edge = F.lit(b.ts).cast(dtype)
        at_or_after = (F.col(ts) > edge) | ((F.col(ts) == edge) & (F.col(tie) >= F.lit(b.tie)))
        fold = F.when(at_or_after, F.lit(b.fold)).otherwise(fold)
    return df.withColumn(name, fold)


def key_chunks(df: DataFrame, key: str, share: float) -> DataFrame:
    """Distinct keys in order, cut into slices of ``max(1, int(n * share))``; chunks count from 1."""
    ranked = global_rank(df.select(key).distinct(), [key], "_pos")
    size = max(1, int(ranked.count() * share))
    return ranked.select(key, (F.floor(F.col("_pos") / size) + 1).cast("int").alias("chunk"))
