"""Sources, sinks, streams and the whole refresh, checked on what is read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import micros
from orderlens.plans.catalogue.registry import CHANGES, L, LINES, O, query
from orderlens.plans.catalogue.warehouse import USER_EVENT, _F_ORDERS, order_facts
from orderlens.plans.normalise import user_chunks
from orderlens.plans.refresh import Warehouse
from orderlens.schemas import ENTITIES
from orderlens.session import scratch_path
from orderlens.sinks.exports import export_mart, read_user_chunks, write_predictions, write_user_chunks
from orderlens.sinks.lake import append_to_lake, replace_table, write_lake_batch, write_sorted
from orderlens.sources import files
from orderlens.sources import stand_ins as src
from orderlens.sources.changes import decode, file_stream, table_of_path
from orderlens.streaming.ingest import start_distinct_stream, start_lake_stream


def lake_orders(spark, sf) -> DataFrame:
    """Orders as lake rows; the change time is the order time."""
    return src.orders(spark, sf).select(
        "order_id",
        "user_id",
        micros("order_date").alias("order_date"),
        F.col("tip").cast("boolean").alias("tip_given"),
        F.lit("c").alias("_op"),
        F.expr("unix_millis(cast(order_date as timestamp))").alias("_ts_ms"),
    )


def lake_users(spark, sf) -> DataFrame:
    return src.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lit("c").alias("_op"), F.lit(0).cast("long").alias("_ts_ms")
    )


_LAKE_ORDERS = """SELECT o_orderkey AS order_id, o_custkey AS user_id, epoch_us(o_orderdate) AS order_date,
CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS tip_given, 'c' AS _op, epoch_us(o_orderdate) // 1000 AS _ts_ms"""


@query(
    "b1_lake_sink",
    f"""WITH {CHANGES} SELECT user_id, event_id, event_type, value, op AS _op, ts_ms AS _ts_ms,
CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM ch""",
)
def b1_lake_sink(spark, sf):
    """Partitioned by the day of the change."""
    root = scratch_path(spark, "lake")
    rows = src.change_log(spark, sf).select(
        "user_id", "event_id", "event_type", "value", F.col("op").alias("_op"), F.col("ts_ms").alias("_ts_ms")
    )
    append_to_lake(rows, root, "users")
    return spark.read.parquet(f"{root}/users").select(
        *rows.columns, *[F.col(c).cast("int").alias(c) for c in ("year", "month", "day")]
    )


@query("a5_typed_read", f"{_LAKE_ORDERS} FROM orders")
def a5_typed_read(spark, sf):
    root = scratch_path(spark, "typed")
    lake_orders(spark, sf).write.parquet(f"{root}/orders")
    return files.read_lake_table(spark, root, "orders")


@query("b3_repeated_batch", f"{_LAKE_ORDERS} FROM orders")
def b3_repeated_batch(spark, sf):
    """A batch written twice is there once. Its change time is kept aside, so that it has one day's folder."""
    root = scratch_path(spark, "repeat")
    rows = lake_orders(spark, sf).withColumnRenamed("_ts_ms", "changed")
    day = rows.withColumn("_ts_ms", F.lit(0).cast("long"))
    write_lake_batch(day, root, "orders", 7)
    write_lake_batch(day, root, "orders", 7)
    back = spark.read.parquet(f"{root}/orders")
    return back.select("order_id", "user_id", "order_date", "tip_given", "_op", F.col("changed").alias("_ts_ms"))


@query(
    "a4_route_by_path",
    """SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS n
UNION ALL SELECT 'users', (SELECT count(*) FROM customer)""",
)
def a4_route_by_path(spark, sf):
    root = scratch_path(spark, "route") + "/cdc_events"
    lake_orders(spark, sf).write.parquet(f"{root}/orders")
    lake_users(spark, sf).write.parquet(f"{root}/users")
    rows = spark.read.option("recursiveFileLookup", "true").schema("_op string").parquet(root)
    return rows.groupBy(table_of_path(F.col("_metadata.file_path")).alias("table_name")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("a3_file_discovery", f"{_LAKE_ORDERS} FROM orders")
def a3_file_discovery(spark, sf):
    """B5: new files found by a stream, staged with a typed change time, seen once over two runs."""
    root = scratch_path(spark, "discover")
    lake_orders(spark, sf).repartition(4).write.parquet(f"{root}/lake/orders")

    def run():
        stream = files.staged(files.stream_lake_table(spark, f"{root}/lake", "orders"))
        stream.writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/state"
        ).trigger(availableNow=True).start().awaitTermination()

    run()
    run()
    return spark.read.parquet(f"{root}/out").select(
        "order_id",
        "user_id",
        "order_date",
        "tip_given",
        "_op",
        F.unix_millis("_ts_ms").alias("_ts_ms"),
    )


@query("b4_archive", f"{_LAKE_ORDERS} FROM orders")
def b4_archive(spark, sf):
    """Files read by a committed batch move to the archive; every row is staged exactly once."""
    root = scratch_path(spark, "archive")
    rows = lake_orders(spark, sf)

    def load():
        stream = files.stream_lake_table(spark, f"{root}/lake", "orders", f"{root}/archive")
        stream.writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/state"
        ).trigger(availableNow=True).start().awaitTermination()

    labelled = F.col("tip_given").isNotNull()
    for part in (rows.filter(labelled), rows.filter(~labelled)):
        part.write.mode("append").parquet(f"{root}/lake/orders")
        load()
    return spark.read.parquet(f"{root}/out")


@query(
    "a6_inferred_staging",
    """SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS aisle, p_type AS department,
true AS has_load_ts FROM part""",
)
def a6_inferred_staging(spark, sf):
    path = scratch_path(spark, "inferred")
    src.products(spark, sf).write.parquet(path)
    staged = files.inferred_staging(spark, path)
    return staged.select("*", F.col("load_ts").isNotNull().alias("has_load_ts")).drop("load_ts")


@query(
    "a7_seed",
    """SELECT p_partkey AS product_id, concat('"', p_name, '", new') AS product_name, CAST(p_size AS BIGINT) AS aisle_id,
p_partkey AS department_id, 'c' AS _op, TIMESTAMP '1970-01-01' AS source_ts FROM part""",
)
def a7_seed(spark, sf):
    """Quotes and commas inside values survive the round trip."""
    path = scratch_path(spark, "seed")
    src.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit('"'), "p_name", F.lit('", new')).alias("product_name"),
        F.col("p_size").alias("aisle_id"),
        F.col("p_partkey").alias("department_id"),
        F.lit("c").alias("_op"),
        F.lit(0).alias("_ts_ms"),
        F.lit("1970-01-01 00:00:00").alias("load_ts"),
    ).write.options(header=True, quote='"', escape='"').csv(path)
    seed = files.read_seed(spark, path, "products")
    return seed.select(
        "product_id",
        "product_name",
        "aisle_id",
        "department_id",
        "_op",
        F.col("_ts_ms").cast("timestamp_ntz").alias("source_ts"),
    )


@query(
    "a8_inferred_csv",
    """SELECT CAST(o_orderkey AS INTEGER) AS order_id, o_totalprice AS total_price FROM orders""",
)
def a8_inferred_csv(spark, sf):
    path = scratch_path(spark, "csv")
    orders = src.table(spark, sf, "orders")
    orders.select(
        F.col("o_orderkey").alias("Order ID"), F.col("o_totalprice").alias("Total-Price")
    ).write.option("header", True).csv(path)
    return files.read_inferred_csv(spark, path)


@query("a9_clean_header", f"WITH {O} SELECT order_id, tip FROM o")
def a9_clean_header(spark, sf):
    rows = src.orders(spark, sf).select(
        F.col("order_id").alias("Unnamed: 0"), F.col("order_id").alias(" Order ID "), F.col("tip").alias("TIP")
    )
    return files.clean_header(rows)


@query("a10_tip_file", f"WITH {O} SELECT order_id, tip FROM o")
def a10_tip_file(spark, sf):
    path = scratch_path(spark, "tips")
    tip = F.when(F.col("tip") == 1, "True").when(F.col("tip") == 0, "False")
    src.orders(spark, sf).select(
        F.col("order_id").alias("_index"), "order_id", tip.alias("tip")
    ).write.option("header", True).csv(path)
    return files.read_tips(spark, path)


@query("a11_projected_read", "SELECT o_orderkey, o_custkey FROM orders")
def a11_projected_read(spark, sf):
    return files.read_columns(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey"])


@query(
    "a13_load_once",
    """SELECT 'raw_orders' AS table_name, (SELECT count(*) FROM orders) AS n, false AS skipped_first, true AS skipped_second
UNION ALL SELECT 'raw_order_products', (SELECT count(*) FROM lineitem), false, true""",
)
def a13_load_once(spark, sf):
    database = "raw_" + scratch_path(spark, "db").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'raw')}'")
    tables = {"raw_orders": src.orders(spark, sf), "raw_order_products": src.order_products(spark, sf)}
    skipped = [files.load_tables_once(tables, database) for _ in range(2)]
    parts = [
        spark.table(f"{database}.{name}")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.lit(name).alias("table_name"),
            "n",
            F.lit(skipped[0]).alias("skipped_first"),
            F.lit(skipped[1]).alias("skipped_second"),
        )
        for name in tables
    ]
    return parts[0].unionByName(parts[1])


@query("b7_mart_export", f"WITH {_F_ORDERS} SELECT * FROM fo")
def b7_mart_export(spark, sf):
    database = "mart_" + scratch_path(spark, "db").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'mart')}'")
    replace_table(order_facts(spark, sf), f"{database}.f_orders")
    path = scratch_path(spark, "export")
    export_mart(spark, database, "f_orders", path)
    return spark.read.parquet(path)


@query("b8_prediction_csv", f"WITH {O} SELECT order_id, tip = 1 AS tip FROM o WHERE tip IS NOT NULL")
def b8_prediction_csv(spark, sf):
    path = scratch_path(spark, "predictions")
    known = src.orders(spark, sf).filter(F.col("tip").isNotNull())
    write_predictions(known.withColumn("tip", F.col("tip").cast("boolean")), path)
    return spark.read.option("header", True).schema("order_id long, tip boolean").csv(path)


@query(
    "b9_user_chunks",
    f"""WITH {O}, {L}, u AS (SELECT DISTINCT user_id FROM o),
s AS (SELECT greatest(1, CAST(floor(count(*) * 0.1) AS BIGINT)) AS size FROM u),
c AS (SELECT user_id, CAST((row_number() OVER (ORDER BY user_id) - 1) // (SELECT size FROM s) + 1 AS INTEGER) AS user_chunk FROM u)
SELECT c.user_chunk, o.order_id, o.user_id, l.product_id, l.add_to_cart_order
FROM o JOIN c USING (user_id) JOIN l USING (order_id)""",
)
def b9_user_chunks(spark, sf):
    """H2: written per chunk, read back as one frame."""
    path = scratch_path(spark, "chunks")
    orders = src.orders(spark, sf).select("order_id", "user_id", "order_date")
    write_user_chunks(user_chunks(orders, src.order_products(spark, sf), 0.1), path)
    return read_user_chunks(
        spark, path, ["user_chunk", "order_id", "user_id", "product_id", "add_to_cart_order"]
    )


@query(
    "g7_sorted_storage",
    f"WITH {LINES} SELECT order_id, product_id, add_to_cart_order FROM l",
)
def g7_sorted_storage(spark, sf):
    path = scratch_path(spark, "sorted")
    write_sorted(src.order_products(spark, sf), path, ["order_id", "product_id"])
    return spark.read.parquet(path)


_DECODED = f"""WITH {CHANGES}
SELECT user_id, event_id, event_type, value, op AS _op,
       CASE WHEN event_id % 50 = 7 AND (event_id // 50) % 4 = 3 THEN NULL ELSE ts_ms END AS _ts_ms
FROM ch WHERE NOT (event_id % 50 = 7 AND (event_id // 50) % 4 IN (0, 1))"""


@query("j1_stream_lake", _DECODED)
def j1_stream_lake(spark, sf):
    """Envelopes from a stream to the lake in several batches, read back."""
    root = scratch_path(spark, "stream")
    src.change_messages(spark, sf).select("topic", "value").repartition(4).write.json(f"{root}/in")
    query_ = start_lake_stream(
        file_stream(spark, f"{root}/in", max_files=2),
        f"{root}/lake",
        f"{root}/state",
        tables=("users",),
        schemas={"users": USER_EVENT},
        available_now=True,
    )
    query_.awaitTermination()
    schema = USER_EVENT.fieldNames() + ["_op", "_ts_ms"]
    return spark.read.parquet(f"{root}/lake/users").select(*schema)


@query(
    "j3_stream_dedup",
    f"WITH {CHANGES} SELECT user_id, event_id, op, ts_ms FROM ch",
)
def j3_stream_dedup(spark, sf):
    """Three arrivals; the last repeats every delete of the log. Repeats are dropped."""
    root = scratch_path(spark, "dedup")
    log = src.change_log(spark, sf).select("user_id", "event_id", "op", "ts_ms")
    arrival = log.withColumn("part", F.col("event_id") % 3)
    repeated = arrival.filter(F.col("op") == "d").withColumn("part", F.lit(2).cast("long"))
    schema = "user_id long, event_id long, op string, ts_ms long"
    arrival.unionByName(repeated).write.partitionBy("part").parquet(f"{root}/in")
    stream = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", 8)
        .parquet(f"{root}/in")
    )
    # Files arrive in no particular order: most rows of later batches are older than those before.
    start_distinct_stream(
        stream, f"{root}/out", f"{root}/state", ["user_id", "event_id", "op", "ts_ms"], "ts_ms"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("user_id", "event_id", "op", "ts_ms")


@query(
    "l14_refresh",
    """SELECT order_id, user_sk, order_date_sk, is_tip_given, is_active FROM (
SELECT o_orderkey AS order_id,
       CASE WHEN c_custkey IS NOT NULL THEN md5(concat_ws('|', CAST(c_custkey AS VARCHAR), '0')) END AS user_sk,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_sk,
       coalesce(o_orderstatus = 'F', false) AS is_tip_given, true AS is_active
FROM orders LEFT JOIN customer ON o_custkey = c_custkey)""",
)
def l14_refresh(spark, sf):
    """J5, L11: lake files of all six tables to tested marts in one call; the order facts read back."""
    root = scratch_path(spark, "warehouse")
    zero = [F.lit("c").alias("_op"), F.lit(0).cast("long").alias("_ts_ms")]
    part = src.table(spark, sf, "part")
    lines = src.order_products(spark, sf).groupBy("order_id", "product_id").agg(
        F.max("add_to_cart_order").cast("long").alias("add_to_cart_order")
    )
    names = {"aisle": "p_brand", "department": "p_type"}
    small = {
        table: part.select(F.xxhash64(column).alias(f"{table}_id"), F.col(column).alias(table)).distinct()
        for table, column in names.items()
    }
    entities = {
        "users": src.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id")),
        "aisles": small["aisle"],
        "departments": small["department"],
        "products": part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.xxhash64("p_brand").alias("aisle_id"),
            F.xxhash64("p_type").alias("department_id"),
        ),
        "orders": lake_orders(spark, sf).drop("_op", "_ts_ms"),
        "order_products": lines,
    }
    for name in ENTITIES:
        rows = lake_orders(spark, sf) if name == "orders" else entities[name].select("*", *zero)
        rows.write.parquet(f"{root}/lake/{name}")
    house = Warehouse(
        spark,
        database="house_" + root.rsplit("-", 1)[-1],
        lake=f"{root}/lake",
        staging=f"{root}/staging",
        facts=f"{root}/facts",
        state=f"{root}/state",
        location=f"{root}/tables",
    )
    failed = house.refresh(1, today=dt.date(2024, 1, 1))
    if failed:
        raise AssertionError(f"failed checks: {failed}")
    return house.fact("f_orders").select("order_id", "user_sk", "order_date_sk", "is_tip_given", "is_active")


@query(
    "a2_decode_whole_message",
    f"WITH {CHANGES} SELECT event_id, op AS _op, ts_ms AS _ts_ms FROM ch",
)
def a2_decode_whole_message(spark, sf):
    """Messages without an envelope are read as the row itself."""
    log = src.change_log(spark, sf)
    bare = F.to_json(
        F.struct(
            "user_id",
            "event_id",
            F.col("op").alias("__op"),
            F.col("ts_ms").alias("__ts_ms"),
            F.lit("false").alias("__deleted"),
        )
    )
    return decode(log.select(bare.alias("value")), USER_EVENT).rows.select("event_id", "_op", "_ts_ms")
