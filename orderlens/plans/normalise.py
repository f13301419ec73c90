"""Split denormalised order files into the six entity tables, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.scalars import text_to_bool
from orderlens.operators.ranking import key_chunks
from orderlens.operators.skew import LIMITS, SkewLimits, salted_join


def distinct_dimension(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    return df.select(*columns).filter(F.col(key).isNotNull()).distinct()


def orders_with_tips(orders: DataFrame, tips: DataFrame | None) -> DataFrame:
    """Orders with a nullable tip flag; keys are compared as numbers, a missing tip table gives nulls."""
    base = orders.withColumn("order_id", F.col("order_id").cast("long"))
    if tips is None or "order_id" not in tips.columns:
        tipped = base.withColumn("tip", F.lit(None).cast("boolean"))
    else:
        side = tips.select(F.col("order_id").cast("long").alias("order_id"), "tip")
        tipped = base.join(side, "order_id", "left")
    return tipped.select("order_id", "user_id", "order_date", text_to_bool("tip").alias("tip_given"))


def normalise(orders: DataFrame, tips: DataFrame | None, lines: DataFrame) -> dict[str, DataFrame]:
    """The six entity tables."""
    return {
        "departments": distinct_dimension(lines, ["department_id", "department"], "department_id"),
        "aisles": distinct_dimension(lines, ["aisle_id", "aisle"], "aisle_id"),
        "products": distinct_dimension(
            lines, ["product_id", "product_name", "aisle_id", "department_id"], "product_id"
        ),
        "users": distinct_dimension(orders, ["user_id"], "user_id"),
        "orders": orders_with_tips(orders, tips),
        "order_products": lines.select("order_id", "product_id", "add_to_cart_order"),
    }


def denormalise(orders: DataFrame, lines: DataFrame, limits: SkewLimits = LIMITS) -> DataFrame:
    """Order lines with their order's columns; orders without lines are kept."""
    spread = [c for c in lines.columns if c != "order_id"]
    joined = salted_join(lines, orders, ["order_id"], "inner", spread, limits=limits)
    bare = orders.join(lines.select("order_id").distinct(), "order_id", "left_anti")
    return joined.unionByName(bare, allowMissingColumns=True)


def user_chunks(
    orders: DataFrame, lines: DataFrame, share: float, limits: SkewLimits = LIMITS
) -> DataFrame:
    """Denormalised rows with the number of their user chunk (consecutive slices of sorted users).

    A chunk joins orders with lines; a chunk whose orders have no lines at all
    keeps its orders.
    """
    chunks = key_chunks(orders.filter(F.col("user_id").isNotNull()), "user_id", share)
    numbered = salted_join(orders, chunks, ["user_id"], "inner", ["order_id"], limits=limits)
    spread = [c for c in lines.columns if c != "order_id"]
    joined = salted_join(lines, numbered, ["order_id"], "inner", spread, limits=limits)
    # At most 1 / share + 1 chunk numbers, so this side is safe to broadcast; chunks are large.
    with_lines = F.broadcast(joined.select("chunk").distinct())
    bare = numbered.join(with_lines, "chunk", "left_anti")
    return joined.unionByName(bare, allowMissingColumns=True).withColumnRenamed("chunk", "user_chunk")
