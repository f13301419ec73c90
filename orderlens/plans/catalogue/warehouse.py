"""Change log, history, facts, calendar and validation queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.dates import date_key, from_millis, micros
from orderlens.functions.holidays import dim_holiday
from orderlens.functions.scalars import is_active, known_true
from orderlens.operators import quality
from orderlens.operators.history import history_from_changes, open_versions, snapshot_step
from orderlens.operators.panel import make_panel, shift
from orderlens.operators.skew import salted_join
from orderlens.operators.latest import (
    latest_by_key,
    latest_by_rank,
    newer_than_target,
    upsert,
    without_deleted,
)
from orderlens.plans.catalogue.registry import (
    CHANGES,
    L,
    O,
    PRODUCT_VERSIONS,
    STAGED,
    USER_VERSIONS,
    query,
)
from orderlens.plans.dims import dim_date, product_snapshot_input, user_snapshot_input
from orderlens.plans.facts import (
    f_order_lines,
    f_orders,
    monthly_tip_rate,
    order_line_keys,
    point_in_time_key,
)
from orderlens.plans.staging import stg_order_products, stg_orders, stg_products, stg_users
from orderlens.sources import stand_ins as src
from orderlens.sources.changes import bootstrap, decode, with_bootstrap

SNAPSHOT_NOW = "2024-02-01 00:00:00"

USER_EVENT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def staged_change_log(spark, sf) -> DataFrame:
    """The change log in staging form."""
    return src.change_log(spark, sf).select(
        "user_id",
        F.col("op").alias("_op"),
        F.col("ts").cast("timestamp").alias("_ts_ms"),
        F.col("ts").cast("timestamp").alias("load_ts"),
    )


def order_facts(spark, sf) -> DataFrame:
    """f_orders over the whole order table, users looked up at order time."""
    staged = src.orders(spark, sf).select(
        "order_id",
        "user_id",
        F.col("order_date").alias("order_timestamp"),
        F.col("tip").cast("boolean").alias("tip_given"),
        F.lit("c").alias("op_type"),
        F.col("order_date").alias("source_ts"),
        F.col("order_date").alias("staging_load_timestamp"),
    )
    return f_orders(staged, src.user_versions(spark, sf))


def stage_lines(spark, sf) -> DataFrame:
    """Order lines as staged changes; one load, so every column takes part in the tie-break."""
    zero = F.timestamp_micros(F.lit(0).cast("long"))
    lines = src.order_products(spark, sf)
    newest = lines.groupBy("order_id", "product_id").agg(
        F.max("add_to_cart_order").alias("add_to_cart_order")
    )
    return newest.select("*", F.lit("c").alias("op_type"), zero.alias("source_ts"), zero.alias("staging_load_timestamp"))


def line_facts(spark, sf) -> DataFrame:
    orders = src.orders(spark, sf).select(
        "order_id",
        "user_id",
        F.col("order_date").alias("order_timestamp"),
        F.col("order_date").alias("source_ts"),
        F.col("order_date").alias("staging_load_timestamp"),
    )
    return f_order_lines(
        stage_lines(spark, sf), orders, src.product_versions(spark, sf), src.user_versions(spark, sf),
        counted=src.order_products(spark, sf),
    )


def order_calendar(spark, sf) -> DataFrame:
    """A calendar that covers every order."""
    span = src.orders(spark, sf).agg(F.min("order_date").alias("a"), F.max("order_date").alias("z")).first()
    if span["a"] is None:
        return dim_date(spark).limit(0)
    return dim_date(spark, span["a"].date(), span["z"].date() + dt.timedelta(days=1))


# ---- flagship ------------------------------------------------------------------


@query(
    "e10_monthly_tip_rate",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS total_orders,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS orders_with_tip,
       round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) * 1.0 / count(*) * 100, 6) AS tip_rate_percent
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2""",
)
def e10_monthly_tip_rate(spark, sf):
    tip = F.col("tip").cast("boolean")
    facts = src.orders(spark, sf).select(
        "order_id", date_key("order_date").alias("order_date_sk"), F.coalesce(tip, F.lit(False)).alias("is_tip_given")
    )
    out = monthly_tip_rate(facts, order_calendar(spark, sf))
    return out.withColumn("tip_rate_percent", F.round("tip_rate_percent", 6))


# ---- decode and row-level rules --------------------------------------------------


@query(
    "c1_cdc_decode",
    f"""WITH {CHANGES}
SELECT user_id, event_id, event_type, value, op AS _op,
       CASE WHEN event_id % 50 = 7 AND (event_id // 50) % 4 = 3 THEN NULL ELSE ts_ms END AS _ts_ms
FROM ch WHERE NOT (event_id % 50 = 7 AND (event_id // 50) % 4 IN (0, 1))""",
)
def c1_cdc_decode(spark, sf):
    messages = src.change_messages(spark, sf).select("value")
    return decode(messages, USER_EVENT).rows


@query(
    "a2_quarantine",
    """SELECT CASE (event_id // 50) % 4 WHEN 0 THEN 'invalid json' ELSE 'null payload' END AS reason,
       count(*) AS messages
FROM events WHERE event_id % 50 = 7 AND (event_id // 50) % 4 IN (0, 1) GROUP BY 1""",
)
def a2_quarantine(spark, sf):
    messages = src.change_messages(spark, sf).select("value")
    return decode(messages, USER_EVENT).quarantine.groupBy("reason").agg(
        F.count(F.lit(1)).alias("messages")
    )


@query(
    "f1_latest_row",
    f"""WITH {CHANGES}
SELECT user_id, event_id, event_type, value, op FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ch)
WHERE rn = 1""",
)
def f1_latest_row(spark, sf):
    log = src.change_log(spark, sf)
    return latest_by_rank(log, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value", "op"
    )


@query(
    "e18_latest_by_agg",
    f"""WITH {CHANGES}
SELECT user_id, event_id, event_type, value, op FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ch)
WHERE rn = 1""",
)
def e18_latest_by_agg(spark, sf):
    log = src.change_log(spark, sf)
    return latest_by_key(log, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value", "op"
    )


@query(
    "j2_out_of_order_changes",
    f"""WITH {CHANGES}
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,
       arg_max(op, (ts, event_id)) AS op, count(*) AS changes FROM ch GROUP BY user_id""",
)
def j2_out_of_order_changes(spark, sf):
    # Arrival order plays no part: the newest source time wins.
    log = src.change_log(spark, sf)
    newest = latest_by_key(log, ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "op")
    counts = log.groupBy("user_id").agg(F.count(F.lit(1)).alias("changes"))
    return newest.join(counts, "user_id")


@query(
    "c3_typed_staging",
    """SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_timestamp,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS tip_given,
       'c' AS op_type, o_orderdate AS source_ts FROM orders""",
)
def c3_typed_staging(spark, sf):
    raw = src.orders(spark, sf).select(
        "order_id",
        "user_id",
        micros("order_date").alias("order_date"),
        F.col("tip").cast("boolean").alias("tip_given"),
        F.lit("c").alias("_op"),
        F.col("order_date").cast("timestamp").alias("_ts_ms"),
        F.col("order_date").cast("timestamp").alias("load_ts"),
    )
    return stg_orders(raw).select(
        "order_id",
        "user_id",
        F.col("order_timestamp").cast("timestamp_ntz").alias("order_timestamp"),
        "tip_given",
        "op_type",
        F.col("source_ts").cast("timestamp_ntz").alias("source_ts"),
    )


@query(
    "c4_known_change_time",
    f"""WITH {CHANGES}
SELECT event_id, user_id, ts_ms FROM ch
WHERE NOT (event_id % 50 = 7 AND (event_id // 50) % 4 IN (0, 1, 3))""",
)
def c4_known_change_time(spark, sf):
    rows = decode(src.change_messages(spark, sf).select("value"), USER_EVENT).rows
    return rows.filter(F.col("_ts_ms").isNotNull()).select(
        "event_id", "user_id", F.col("_ts_ms").alias("ts_ms")
    )


@query(
    "c5_active_only",
    f"""WITH {CHANGES}
SELECT user_id, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ch)
WHERE rn = 1 AND op <> 'd'""",
)
def c5_active_only(spark, sf):
    log = src.change_log(spark, sf)
    newest = latest_by_key(log, ["user_id"], ["ts", "event_id"])
    return without_deleted(newest, "op").select("user_id", "event_id")


@query(
    "c6_soft_delete",
    f"""WITH {CHANGES}
SELECT event_id, CASE WHEN op = 'd' THEN false ELSE true END AS is_active FROM ch""",
)
def c6_soft_delete(spark, sf):
    return src.change_log(spark, sf).select("event_id", is_active("op").alias("is_active"))


@query(
    "c7_known_true",
    f"""WITH {O} SELECT order_id, coalesce(tip = 1, false) AS is_tip_given FROM o""",
)
def c7_known_true(spark, sf):
    flagged = src.orders(spark, sf).withColumn("tip_given", F.col("tip").cast("boolean"))
    return flagged.select("order_id", known_true("tip_given").alias("is_tip_given"))


@query(
    "c8_effective_ts",
    """WITH prod AS (SELECT p_partkey, p_brand, p_type FROM part),
ps AS (SELECT l_partkey, max(l_shipdate) AS t FROM lineitem GROUP BY 1),
aisle AS (SELECT p_brand, max(l_shipdate) AS t FROM lineitem JOIN part ON l_partkey = p_partkey
          WHERE l_returnflag = 'R' GROUP BY 1),
dep AS (SELECT p_type, max(l_shipdate) AS t FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_returnflag = 'A' GROUP BY 1)
SELECT p_partkey AS product_id,
       greatest(coalesce(ps.t, TIMESTAMP '1970-01-01'), coalesce(aisle.t, TIMESTAMP '1970-01-01'),
                coalesce(dep.t, TIMESTAMP '1970-01-01')) AS effective_last_updated_ts
FROM prod LEFT JOIN ps ON p_partkey = l_partkey LEFT JOIN aisle USING (p_brand) LEFT JOIN dep USING (p_type)
WHERE ps.t IS NOT NULL""",
)
def c8_effective_ts(spark, sf):
    """L4: product snapshot input, where shipments play the part of changes."""
    products = src.products(spark, sf)
    lines = src.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"), "l_returnflag", F.col("l_shipdate").cast("timestamp").alias("t")
    )
    detailed = lines.join(products, "product_id")

    def changes(group: str, flag: str | None) -> DataFrame:
        rows = detailed if flag is None else detailed.filter(F.col("l_returnflag") == flag)
        return rows.groupBy(group).agg(F.max("t").alias("_ts_ms"))

    product_changes = products.join(changes("product_id", None), "product_id", "left").select(
        "product_id",
        "product_name",
        F.col("aisle").alias("aisle_id"),
        F.col("department").alias("department_id"),
        F.lit("u").alias("_op"),
        "_ts_ms",
        F.col("_ts_ms").alias("load_ts"),
    )
    aisles = changes("aisle", "R").select(
        F.col("aisle").alias("aisle_id"), "aisle", "_ts_ms", F.lit("u").alias("_op"), F.col("_ts_ms").alias("load_ts")
    )
    departments = changes("department", "A").select(
        F.col("department").alias("department_id"),
        "department",
        "_ts_ms",
        F.lit("u").alias("_op"),
        F.col("_ts_ms").alias("load_ts"),
    )
    staged = stg_products(product_changes, aisles, departments)
    return product_snapshot_input(staged).select(
        "product_id", F.col("effective_last_updated_ts").cast("timestamp_ntz").alias("effective_last_updated_ts")
    )


@query(
    "l4_user_snapshot_input",
    f"""WITH {CHANGES}
SELECT user_id, ts AS effective_last_updated_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM ch)
WHERE rn = 1 AND op <> 'd'""",
)
def l4_user_snapshot_input(spark, sf):
    newest = user_snapshot_input(stg_users(staged_change_log(spark, sf)))
    return newest.withColumn(
        "effective_last_updated_ts", F.col("effective_last_updated_ts").cast("timestamp_ntz")
    )


# ---- history ----------------------------------------------------------------------


def change_history(spark, sf) -> DataFrame:
    return history_from_changes(
        src.change_log(spark, sf), "user_id", "ts", "op", "event_id", ["event_type", "value"]
    )


@query(
    "l3_scd2_history",
    f"""WITH {CHANGES}, v AS (
  SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM ch)
SELECT user_id, event_type, value,
       md5(concat_ws('|', CAST(user_id AS VARCHAR), CAST(epoch_us(ts) AS VARCHAR))) AS scd_id,
       ts AS valid_from, valid_to
FROM v WHERE op <> 'd'""",
)
def l3_scd2_history(spark, sf):
    return change_history(spark, sf)


@query(
    "f8_validity_interval",
    f"""WITH {CHANGES}
SELECT user_id, event_id, ts AS valid_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM ch""",
)
def f8_validity_interval(spark, sf):
    log = src.change_log(spark, sf).select("user_id", "event_id", "ts")
    panel = make_panel(log, ["user_id"], "ts", "event_id")
    return shift(panel, "ts", [1], ["valid_to"], ahead=True).result().withColumnRenamed("ts", "valid_from")


def snapshot_source(spark, sf, until: str | None) -> DataFrame:
    """Newest change per user up to an instant, as a snapshot source."""
    log = src.change_log(spark, sf)
    if until:
        log = log.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    newest = without_deleted(latest_by_key(log, ["user_id"], ["ts", "event_id"]), "op")
    return newest.select("user_id", "event_type", F.col("ts").alias("updated_at"))


def first_snapshot(spark, sf, until: str) -> DataFrame:
    source = snapshot_source(spark, sf, until)
    empty = source.limit(0).select(
        "user_id",
        "event_type",
        F.lit(None).cast("string").alias("scd_id"),
        F.col("updated_at").alias("valid_from"),
        F.col("updated_at").alias("valid_to"),
    )
    return snapshot_step(empty, source, "user_id", "updated_at")


_SNAPSHOT_SQL = """WITH {changes},
s1 AS (SELECT user_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM ch
  WHERE ts < TIMESTAMP '2024-01-15') WHERE rn = 1 AND op <> 'd'),
s2 AS (SELECT user_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM ch)
  WHERE rn = 1 AND op <> 'd'),
v AS (
  SELECT s1.user_id, s1.event_type, s1.ts AS valid_from,
         CASE WHEN s2.user_id IS NULL THEN {missing}
              WHEN s2.ts > s1.ts THEN s2.ts END AS valid_to
  FROM s1 LEFT JOIN s2 USING (user_id)
  UNION ALL
  SELECT s2.user_id, s2.event_type, s2.ts, NULL
  FROM s2 LEFT JOIN s1 USING (user_id) WHERE s1.user_id IS NULL OR s2.ts > s1.ts)
SELECT user_id, event_type,
       md5(concat_ws('|', CAST(user_id AS VARCHAR), CAST(epoch_us(valid_from) AS VARCHAR))) AS scd_id,
       valid_from, valid_to
FROM v"""


@query("l1_snapshot_step", _SNAPSHOT_SQL.format(changes=CHANGES, missing="NULL"))
def l1_snapshot_step(spark, sf):
    history = first_snapshot(spark, sf, "2024-01-15 00:00:00")
    return snapshot_step(history, snapshot_source(spark, sf, None), "user_id", "updated_at", False)


@query(
    "l2_hard_delete",
    _SNAPSHOT_SQL.format(changes=CHANGES, missing=f"TIMESTAMP '{SNAPSHOT_NOW}'"),
)
def l2_hard_delete(spark, sf):
    history = first_snapshot(spark, sf, "2024-01-15 00:00:00")
    now = F.lit(SNAPSHOT_NOW).cast("timestamp_ntz")
    return snapshot_step(history, snapshot_source(spark, sf, None), "user_id", "updated_at", True, now)


@query(
    "c11_open_versions",
    f"""WITH {PRODUCT_VERSIONS}
SELECT product_id, product_name, scd_id, valid_from FROM pv WHERE valid_to IS NULL""",
)
def c11_open_versions(spark, sf):
    return open_versions(src.product_versions(spark, sf)).select(
        "product_id", "product_name", "scd_id", "valid_from"
    )


@query(
    "c12_point_lookup",
    f"""WITH {PRODUCT_VERSIONS},
top AS (SELECT l_partkey FROM lineitem JOIN pr ON l_partkey = product_id WHERE renamed IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT product_id, product_name, valid_from, valid_to FROM pv
WHERE product_id = (SELECT l_partkey FROM top)""",
)
def c12_point_lookup(spark, sf):
    """Parameterised lookup of the most ordered product among those with several versions."""
    versions = src.product_versions(spark, sf)
    renamed = versions.filter(F.col("valid_to").isNotNull()).select("product_id")
    busiest = (
        src.order_products(spark, sf)
        .join(renamed, "product_id", "left_semi")
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "product_id")
        .first()
    )
    return spark.sql(
        "SELECT product_id, product_name, valid_from, valid_to FROM {history} WHERE product_id = :product_id",
        args={"product_id": busiest["product_id"]},
        history=versions,
    )


# ---- point-in-time joins and facts ---------------------------------------------------


@query(
    "d3_pit_user",
    f"""WITH {CHANGES}, v AS (
  SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM ch),
h AS (SELECT user_id AS k, ts AS valid_from, valid_to,
      md5(concat_ws('|', CAST(user_id AS VARCHAR), CAST(epoch_us(ts) AS VARCHAR))) AS scd_id
      FROM v WHERE op <> 'd')
SELECT ch.event_id, ch.user_id, h.scd_id AS user_sk
FROM ch LEFT JOIN h ON ch.user_id = h.k AND ch.ts + INTERVAL 1 HOUR >= h.valid_from
 AND ch.ts + INTERVAL 1 HOUR < coalesce(h.valid_to, TIMESTAMP '9999-12-31 23:59:59.999999')""",
)
def d3_pit_user(spark, sf):
    facts = src.change_log(spark, sf).select(
        "event_id", "user_id", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("at")
    )
    keyed = point_in_time_key(facts, change_history(spark, sf), "user_id", "at", "user_sk")
    return keyed.select("event_id", "user_id", "user_sk")


@query(
    "d4_pit_lines",
    f"""WITH {PRODUCT_VERSIONS}, {USER_VERSIONS}
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS add_to_cart_order,
       l_suppkey AS supplier_id, pv.scd_id AS product_sk, uv.scd_id AS user_sk
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN pv ON l_partkey = pv.product_id AND o_orderdate >= pv.valid_from
 AND o_orderdate < coalesce(pv.valid_to, TIMESTAMP '9999-12-31 23:59:59.999999')
LEFT JOIN uv ON o_custkey = uv.user_id AND o_orderdate >= uv.valid_from
 AND o_orderdate < coalesce(uv.valid_to, TIMESTAMP '9999-12-31 23:59:59.999999')""",
)
def d4_pit_lines(spark, sf):
    orders = src.orders(spark, sf).select("order_id", "user_id", "order_date")
    lines = src.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
        F.col("l_suppkey").alias("supplier_id"),
    )
    keyed = order_line_keys(
        lines,
        orders,
        src.product_versions(spark, sf),
        src.user_versions(spark, sf),
        "order_date",
        ["product_id", "supplier_id"],
    )
    return keyed.select("order_id", "product_id", "add_to_cart_order", "supplier_id", "product_sk", "user_sk")


_F_ORDERS = f"""{USER_VERSIONS}, fo AS (
SELECT uv.scd_id AS user_sk, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_sk,
       o_orderkey AS order_id, coalesce(o_orderstatus = 'F', false) AS is_tip_given, true AS is_active,
       o_orderdate AS order_timestamp, o_orderdate AS staging_load_timestamp
FROM orders LEFT JOIN uv ON o_custkey = uv.user_id AND o_orderdate >= uv.valid_from
 AND o_orderdate < coalesce(uv.valid_to, TIMESTAMP '9999-12-31 23:59:59.999999'))"""


@query("l9_fact_orders", f"WITH {_F_ORDERS} SELECT * FROM fo")
def l9_fact_orders(spark, sf):
    return order_facts(spark, sf)


_F_LINES = f"""{PRODUCT_VERSIONS}, {USER_VERSIONS}, ll AS (
  SELECT l_orderkey, l_partkey, max(l_linenumber) AS pos FROM lineitem GROUP BY 1, 2),
fl AS (
SELECT pv.scd_id AS product_sk, uv.scd_id AS user_sk, l_orderkey AS order_id, l_partkey AS product_id,
       pos AS add_to_cart_order, o_orderdate AS order_timestamp, o_orderdate AS staging_load_timestamp
FROM ll LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN pv ON l_partkey = pv.product_id AND o_orderdate >= pv.valid_from
 AND o_orderdate < coalesce(pv.valid_to, TIMESTAMP '9999-12-31 23:59:59.999999')
LEFT JOIN uv ON o_custkey = uv.user_id AND o_orderdate >= uv.valid_from
 AND o_orderdate < coalesce(uv.valid_to, TIMESTAMP '9999-12-31 23:59:59.999999'))"""


@query("l10_fact_lines", f"WITH {_F_LINES} SELECT * FROM fl")
def l10_fact_lines(spark, sf):
    return line_facts(spark, sf)


@query(
    "d5_lines_to_orders",
    f"""WITH {L} SELECT l.order_id, l.product_id, l.add_to_cart_order, o_custkey AS user_id, o_orderdate AS order_date
FROM l LEFT JOIN orders ON l.order_id = o_orderkey""",
)
def d5_lines_to_orders(spark, sf):
    orders = src.orders(spark, sf).select("order_id", "user_id", "order_date")
    return salted_join(
        src.order_products(spark, sf), orders, ["order_id"], "left", ["product_id", "add_to_cart_order"]
    ).select("order_id", "product_id", "add_to_cart_order", "user_id", "order_date")


@query(
    "l5_incremental_upsert",
    f"""WITH {STAGED}
SELECT order_id, tip_given, staging_load_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY staging_load_timestamp DESC) rn FROM so)
WHERE rn = 1""",
)
def l5_incremental_upsert(spark, sf):
    staged = src.staged_orders(spark, sf)
    load = F.col("staging_load_timestamp")
    first_load = staged.agg(F.min("staging_load_timestamp").alias("m")).scalar()
    target = staged.filter(load == first_load)
    delta = newer_than_target(staged, target, "staging_load_timestamp")
    return upsert(target, delta, ["order_id"], ["staging_load_timestamp"]).select(
        "order_id", "tip_given", "staging_load_timestamp"
    )


@query(
    "e17_newer_than_target",
    f"""WITH {STAGED}
SELECT order_id, tip_given FROM so WHERE staging_load_timestamp >
 (SELECT min(staging_load_timestamp) FROM so)""",
)
def e17_newer_than_target(spark, sf):
    staged = src.staged_orders(spark, sf)
    oldest = staged.agg(F.min("staging_load_timestamp").alias("staging_load_timestamp"))
    return newer_than_target(staged, oldest, "staging_load_timestamp").select("order_id", "tip_given")


@query(
    "l6_replacing_dedup",
    """SELECT l_orderkey AS order_id, l_partkey AS product_id,
       arg_max(l_linenumber, (l_shipdate, l_linenumber, l_suppkey)) AS add_to_cart_order,
       max(l_shipdate) AS staging_load_timestamp
FROM lineitem GROUP BY 1, 2""",
)
def l6_replacing_dedup(spark, sf):
    rows = src.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
        F.col("l_shipdate").alias("staging_load_timestamp"),
        "l_suppkey",
    )
    order = ["staging_load_timestamp", "add_to_cart_order", "l_suppkey"]
    return latest_by_key(rows, ["order_id", "product_id"], order).drop("l_suppkey")


@query(
    "d9_fact_to_version",
    f"""WITH {_F_LINES}
SELECT fl.order_id, fl.product_id, fl.product_sk, pv.product_name, pv.valid_from
FROM fl JOIN pv ON fl.product_sk = pv.scd_id""",
)
def d9_fact_to_version(spark, sf):
    history = src.product_versions(spark, sf).select("scd_id", "product_name", "valid_from")
    facts = line_facts(spark, sf).select("order_id", "product_id", "product_sk")
    keyed = history.withColumnRenamed("scd_id", "product_sk")
    return salted_join(facts, keyed, ["product_sk"], "inner", ["order_id"]).select(
        "order_id", "product_id", "product_sk", "product_name", "valid_from"
    )


@query(
    "d10_star_join",
    f"""WITH {_F_ORDERS}
SELECT order_id, CAST(order_timestamp AS DATE) AS full_date, CAST(quarter(order_timestamp) AS INTEGER) AS quarter,
       isodow(order_timestamp) IN (6, 7) AS is_weekend, is_tip_given
FROM fo WHERE order_timestamp IS NOT NULL""",
)
def d10_star_join(spark, sf):
    calendar = order_calendar(spark, sf).select("date_sk", "full_date", "quarter", "is_weekend")
    facts = order_facts(spark, sf).select("order_id", "order_date_sk", "is_tip_given")
    # One row per day between the first and the last order.
    return facts.join(F.broadcast(calendar), F.col("order_date_sk") == F.col("date_sk")).select(
        "order_id", "full_date", "quarter", "is_weekend", "is_tip_given"
    )


# ---- calendar -----------------------------------------------------------------------


@query(
    "l7_dim_date",
    """WITH b AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders),
cal AS (SELECT CAST(d AS DATE) AS full_date,
         CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
         CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(strftime(d, '%U') AS INTEGER) AS week_of_year,
         CAST(quarter(d) AS INTEGER) AS quarter, isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series(a, z, INTERVAL 1 DAY)) AS d FROM b)),
n AS (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS k, count(*) AS c FROM orders GROUP BY 1)
SELECT cal.*, coalesce(n.c, 0) AS orders FROM cal LEFT JOIN n ON cal.date_sk = n.k""",
)
def l7_dim_date(spark, sf):
    """Calendar over the span of the orders, with the orders of each day."""
    dates = src.orders(spark, sf)
    span = dates.agg(F.min("order_date").alias("a"), F.max("order_date").alias("z")).first()
    end = span["z"].date() + dt.timedelta(days=1)
    per_day = dates.groupBy(date_key("order_date").alias("date_sk")).agg(F.count(F.lit(1)).alias("orders"))
    return (
        dim_date(spark, span["a"].date(), end)
        .join(per_day, "date_sk", "left")
        .withColumn("orders", F.coalesce("orders", F.lit(0).cast("long")))
    )


HOLIDAYS_SQL = """yrs AS (SELECT unnest(generate_series(a, z + 1)) AS y FROM (
  SELECT year(min(o_orderdate)) AS a, year(max(o_orderdate)) AS z FROM orders)),
rules AS (
  SELECT y, make_date(y, 1, 1) AS d, true AS fixed FROM yrs
  UNION ALL SELECT y, make_date(y, 7, 4), true FROM yrs
  UNION ALL SELECT y, make_date(y, 11, 11), true FROM yrs
  UNION ALL SELECT y, make_date(y, 12, 25), true FROM yrs
  UNION ALL SELECT y, make_date(y, 1, 1) + CAST((8 - isodow(make_date(y, 1, 1))) % 7 + 14 AS INTEGER), false FROM yrs
  UNION ALL SELECT y, make_date(y, 2, 1) + CAST((8 - isodow(make_date(y, 2, 1))) % 7 + 14 AS INTEGER), false FROM yrs
  UNION ALL SELECT y, make_date(y, 5, 31) - CAST((isodow(make_date(y, 5, 31)) - 1) % 7 AS INTEGER), false FROM yrs
  UNION ALL SELECT y, make_date(y, 9, 1) + CAST((8 - isodow(make_date(y, 9, 1))) % 7 AS INTEGER), false FROM yrs
  UNION ALL SELECT y, make_date(y, 10, 1) + CAST((8 - isodow(make_date(y, 10, 1))) % 7 + 7 AS INTEGER), false FROM yrs
  UNION ALL SELECT y, make_date(y, 11, 1) + CAST((11 - isodow(make_date(y, 11, 1))) % 7 + 21 AS INTEGER), false FROM yrs),
hol AS (
  SELECT CAST(d AS DATE) AS d FROM rules
  UNION SELECT CAST(d - 1 AS DATE) FROM rules WHERE fixed AND isodow(d) = 6
  UNION SELECT CAST(d + 1 AS DATE) FROM rules WHERE fixed AND isodow(d) = 7)"""


@query(
    "l8_holidays",
    f"""WITH {HOLIDAYS_SQL}, n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS c FROM orders GROUP BY 1)
SELECT hol.d AS holiday_date, coalesce(n.c, 0) AS orders
FROM hol LEFT JOIN n ON hol.d = n.d
WHERE year(hol.d) BETWEEN (SELECT year(min(o_orderdate)) FROM orders) AND (SELECT year(max(o_orderdate)) FROM orders)""",
)
def l8_holidays(spark, sf):
    """Holidays of the years present, with the orders of each."""
    orders = src.orders(spark, sf)
    span = orders.agg(F.year(F.min("order_date")).alias("a"), F.year(F.max("order_date")).alias("z")).first()
    days = dim_holiday(spark, span["a"], span["z"]).select("holiday_date").distinct()
    per_day = orders.groupBy(F.to_date("order_date").alias("holiday_date")).agg(F.count(F.lit(1)).alias("orders"))
    return days.join(per_day, "holiday_date", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0).cast("long"))
    )


# ---- bootstrap, tests, validation -------------------------------------------------------


@query(
    "a12_bootstrap",
    f"""WITH {CHANGES}, e AS (
  SELECT c_custkey AS user_id, 'c' AS op, TIMESTAMP '1970-01-01' AS ts FROM customer
  UNION ALL SELECT user_id, op, ts FROM ch)
SELECT user_id, op AS _op, ts AS source_ts FROM e""",
)
def a12_bootstrap(spark, sf):
    users = src.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    log = staged_change_log(spark, sf)
    return with_bootstrap(users, log).select(
        "user_id", "_op", F.col("_ts_ms").cast("timestamp_ntz").alias("source_ts")
    )


@query(
    "l12_quality",
    f"""WITH {PRODUCT_VERSIONS}, {USER_VERSIONS} SELECT 'line order and position unique' AS check_name, (SELECT count(*) FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'order unique', (SELECT count(*) FROM (
  SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'order tip not null', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
UNION ALL SELECT 'product one open version', (SELECT count(*) FROM (
  SELECT product_id FROM pv GROUP BY 1 HAVING count(*) FILTER (WHERE valid_to IS NULL) <> 1))
UNION ALL SELECT 'user version unique', (SELECT count(*) FROM (
  SELECT scd_id FROM uv WHERE scd_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1))""",
)
def l12_quality(spark, sf):
    lines, orders = src.order_products(spark, sf), src.orders(spark, sf)
    return quality.report(
        [
            quality.unique(lines, ["order_id", "add_to_cart_order"], "line order and position unique"),
            quality.unique(orders, ["order_id"], "order unique"),
            quality.not_null(orders, "tip", "order tip not null"),
            quality.one_open_version(
                src.product_versions(spark, sf), "product_id", "product one open version", exactly=True
            ),
            quality.unique(src.user_versions(spark, sf), ["scd_id"], "user version unique"),
        ]
    )


@query(
    "e12_readiness",
    """SELECT 'customers' AS table_name, true AS table_exists, (SELECT count(*) > 0 FROM customer) AS has_rows
UNION ALL SELECT 'lines', true, (SELECT count(*) > 0 FROM lineitem)
UNION ALL SELECT 'orders', true, (SELECT count(*) > 0 FROM orders)
UNION ALL SELECT 'products', true, (SELECT count(*) > 0 FROM part)
UNION ALL SELECT 'returns', false, false""",
)
def e12_readiness(spark, sf):
    return quality.readiness(
        {
            "customers": src.table(spark, sf, "customer"),
            "lines": src.table(spark, sf, "lineitem"),
            "orders": src.table(spark, sf, "orders"),
            "products": src.table(spark, sf, "part"),
            "returns": None,
        }
    )


@query(
    "n1_history",
    f"""WITH {PRODUCT_VERSIONS}
SELECT product_id, scd_id, product_name, valid_from, valid_to,
       CAST(row_number() OVER (PARTITION BY product_id ORDER BY valid_from) AS INTEGER) AS version
FROM pv""",
)
def n1_history(spark, sf):
    """Every product's versions in order (a single product is a filter on top)."""
    history = src.product_versions(spark, sf)
    # A product has at most two versions here; change logs of any length go through the panel operators.
    w = Window.partitionBy("product_id").orderBy("valid_from")
    return history.select(
        "product_id", "scd_id", "product_name", "valid_from", "valid_to", F.row_number().over(w).alias("version")
    )


@query(
    "g1_version_history",
    f"""WITH {PRODUCT_VERSIONS}, most AS (SELECT min(product_id) AS product_id FROM pv WHERE valid_to IS NOT NULL)
SELECT product_id, scd_id, product_name, valid_from, valid_to FROM pv JOIN most USING (product_id) ORDER BY valid_from""",
)
def g1_version_history(spark, sf):
    """All versions of the first product that changed, oldest first."""
    history = src.product_versions(spark, sf)
    first = history.filter(F.col("valid_to").isNotNull()).agg(F.min("product_id")).first()[0]
    found = quality.version_history(history, "product_id", first)
    return found.select("product_id", "scd_id", "product_name", "valid_from", "valid_to")


@query(
    "n2_sound_history",
    f"""WITH {PRODUCT_VERSIONS}
SELECT product_id, count(*) AS versions, count(*) FILTER (WHERE valid_to IS NULL) AS open_versions,
       arg_min(valid_to IS NOT NULL, valid_from) AS oldest_closed
FROM pv GROUP BY product_id""",
)
def n2_sound_history(spark, sf):
    return src.product_versions(spark, sf).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(F.col("valid_to").isNull()).alias("open_versions"),
        F.min_by(F.col("valid_to").isNotNull(), "valid_from").alias("oldest_closed"),
    )


@query(
    "n3_newest_fact",
    f"""WITH {_F_LINES}, m AS (
  SELECT product_sk, arg_max(order_id, (order_timestamp, order_id)) AS order_id,
         max(order_timestamp) AS t
  FROM fl WHERE product_sk IS NOT NULL GROUP BY 1)
SELECT m.order_id, m.product_sk, pv.product_name, strftime(m.t, '%Y-%m-%d %H:%M:%S') AS order_timestamp
FROM m JOIN pv ON m.product_sk = pv.scd_id""",
)
def n3_newest_fact(spark, sf):
    """Newest order of every product version, next to the version it points to."""
    newest = line_facts(spark, sf).filter(F.col("product_sk").isNotNull()).groupBy("product_sk").agg(
        F.max(F.struct("order_timestamp", "order_id")).alias("f")
    )
    history = src.product_versions(spark, sf).select(F.col("scd_id").alias("product_sk"), "product_name")
    return newest.join(history, "product_sk").select(
        F.col("f.order_id").alias("order_id"),
        "product_sk",
        "product_name",
        F.date_format("f.order_timestamp", "yyyy-MM-dd HH:mm:ss").alias("order_timestamp"),
    )


@query(
    "n4_state",
    f"""WITH {PRODUCT_VERSIONS}
SELECT (SELECT count(*) FROM pv) AS total_products, (SELECT count(*) FROM orders) AS total_orders,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) AS total_order_lines""",
)
def n4_state(spark, sf):
    return quality.warehouse_state(
        src.product_versions(spark, sf), src.orders(spark, sf), stage_lines(spark, sf)
    )


@query(
    "c3_staged_lines",
    """SELECT l_orderkey AS order_id, l_partkey AS product_id,
       arg_max(l_linenumber, l_linenumber) AS add_to_cart_order, 'c' AS op_type
FROM lineitem GROUP BY 1, 2""",
)
def c3_staged_lines(spark, sf):
    raw = bootstrap(
        src.order_products(spark, sf).groupBy("order_id", "product_id").agg(
            F.max("add_to_cart_order").alias("add_to_cart_order")
        )
    )
    return stg_order_products(raw).select("order_id", "product_id", "add_to_cart_order", "op_type")


@query(
    "i1_change_time",
    f"""WITH {CHANGES} SELECT event_id, date_trunc('millisecond', ts) AS source_ts FROM ch""",
)
def i1_change_time(spark, sf):
    return src.change_log(spark, sf).select(
        "event_id", from_millis("ts_ms").cast("timestamp_ntz").alias("source_ts")
    )
