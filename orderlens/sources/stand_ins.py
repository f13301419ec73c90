"""Order entities derived from the benchmark tables, by expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.dates import millis
from orderlens.operators.history import scd_id

# Fixed value: the word that plays "organic" in these product names.
ORGANIC_STAND_IN = "red"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tip_flag(status: str = "o_orderstatus"):
    """F = tipped, O = not tipped, P = unknown."""
    return F.when(F.col(status) == "F", True).when(F.col(status) == "O", False)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_id, user_id, order_date, tip (0, 1 or null)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
        tip_flag().cast("int").alias("tip"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("aisle"),
        F.col("p_type").alias("department"),
    )


def order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Denormalised lines: with product name, aisle and department."""
    return order_products(spark, sf_dir).join(products(spark, sf_dir), "product_id", "left")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as labelled rows with a time of day: purchase = 1."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("order_id"),
        "user_id",
        F.col("ts").alias("order_date"),
        (F.col("event_type") == "purchase").cast("int").alias("tip"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of users: signup creates, error deletes, anything else updates."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        "event_type",
        "value",
        "ts",
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
        .alias("op"),
        millis("ts").alias("ts_ms"),
    )


def change_messages(spark: SparkSession, sf_dir: str, topic: str = "cdc.shop.public.users") -> DataFrame:
    """The change log as JSON envelopes; every event whose id ends in 7 mod 50 is damaged on purpose.

    Four kinds of damage alternate: broken JSON, a null payload, no payload key
    (still readable), and text in the change time.
    """
    log = change_log(spark, sf_dir)
    payload = F.struct(
        "user_id",
        "event_id",
        "event_type",
        "value",
        F.col("op").alias("__op"),
        F.col("ts_ms").cast("string").alias("__ts_ms"),
        F.when(F.col("op") == "d", "true").otherwise("false").alias("__deleted"),
        F.lit("users").alias("__table"),
    )
    broken_time = payload.withField("__ts_ms", F.lit("soon"))
    kind = F.when(F.col("event_id") % 50 == 7, F.floor(F.col("event_id") / 50) % 4)
    value = (
        F.when(kind == 0, F.concat(F.lit('{"payload": {'), F.col("event_id").cast("string")))
        .when(kind == 1, F.lit('{"payload": null}'))
        .when(kind == 2, F.to_json(payload))
        .when(kind == 3, F.to_json(F.struct(broken_time.alias("payload"))))
        .otherwise(F.to_json(F.struct(payload.alias("payload"))))
    )
    return log.select(F.lit(topic).alias("topic"), value.alias("value"), "event_id")


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of products: every third has its name upper-cased some day in 1998."""
    key = F.col("product_id")
    start = F.to_timestamp_ntz(F.lit("1990-01-01 00:00:00"))
    renamed_at = F.date_add(F.lit("1998-01-01").cast("date"), (key % 365).cast("int")).cast("timestamp_ntz")
    changes = products(spark, sf_dir).withColumn("renamed_at", F.when(key % 3 == 0, renamed_at))
    versions = F.array(
        F.struct(F.col("product_name"), start.alias("valid_from"), F.col("renamed_at").alias("valid_to")),
        F.struct(
            F.upper("product_name").alias("product_name"),
            F.col("renamed_at").alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        ),
    )
    return _exploded(changes, versions, "product_id", ["product_name", "aisle", "department"])


def user_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of users: every fourth changes some day in 1997."""
    key = F.col("user_id")
    start = F.to_timestamp_ntz(F.lit("1990-01-01 00:00:00"))
    changed_at = F.date_add(F.lit("1997-01-01").cast("date"), (key % 365).cast("int")).cast("timestamp_ntz")
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    changes = users.withColumn("changed_at", F.when(key % 4 == 0, changed_at))
    versions = F.array(
        F.struct(start.alias("valid_from"), F.col("changed_at").alias("valid_to")),
        F.struct(F.col("changed_at").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to")),
    )
    return _exploded(changes, versions, "user_id", [])


def _exploded(changes: DataFrame, versions, key: str, attributes: list[str]) -> DataFrame:
    kept = F.filter(versions, lambda v: v.getField("valid_from").isNotNull())
    own = [c for c in attributes if c != "product_name"]
    rows = changes.select(key, *own, F.explode(kept).alias("v")).select(key, *own, "v.*")
    return rows.select(
        key, *attributes, scd_id(key, "valid_from").alias("scd_id"), "valid_from", "valid_to"
    )


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in two load batches; the overlap is re-sent with the tip set."""
    base = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        "o_orderstatus",
    )
    digit = F.col("order_id") % 10
    first = base.filter(digit < 8).withColumn("staging_load_timestamp", _instant("2024-01-01"))
    second = (
        base.filter(digit >= 7)
        .withColumn("o_orderstatus", F.when(digit == 7, F.lit("F")).otherwise(F.col("o_orderstatus")))
        .withColumn("staging_load_timestamp", _instant("2024-01-02"))
    )
    return first.unionByName(second).select(
        "order_id",
        "user_id",
        "order_timestamp",
        tip_flag().alias("tip_given"),
        F.lit("u").alias("op_type"),
        F.col("order_timestamp").alias("source_ts"),
        "staging_load_timestamp",
    )


def _instant(day: str):
    return F.to_timestamp_ntz(F.lit(f"{day} 00:00:00"))
