"""Registration of queries and shared SQL fragments for their expected results."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from orderlens.session import ensure_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query function ``(spark, sf_dir) -> DataFrame`` and its oracle SQL."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


# ---- SQL stand-ins, the same expressions as sources/stand_ins.py ---------------------

O = """o AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS tip
  FROM orders)"""
P = """p AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS aisle, p_type AS department
  FROM part)"""
L = """l AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS add_to_cart_order
  FROM lineitem)"""
D = """d AS (
  SELECT l.order_id, l.product_id, l.add_to_cart_order, p.product_name, p.aisle, p.department
  FROM l LEFT JOIN p ON l.product_id = p.product_id)"""
LINES = f"{P}, {L}, {D}"
CLICKS = """ev AS (
  SELECT event_id AS order_id, user_id, ts AS order_date,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS tip
  FROM events)"""
CHANGES = """ch AS (
  SELECT user_id, event_id, event_type, value, ts,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         epoch_us(ts) // 1000 AS ts_ms
  FROM events)"""
PRODUCT_VERSIONS = """pr AS (
  SELECT p_partkey AS product_id, p_name, p_brand AS aisle, p_type AS department,
         CASE WHEN p_partkey % 3 = 0
              THEN TIMESTAMP '1998-01-01' + to_days(CAST(p_partkey % 365 AS INTEGER)) END AS renamed
  FROM part),
pv0 AS (
  SELECT product_id, p_name AS product_name, aisle, department,
         TIMESTAMP '1990-01-01' AS valid_from, renamed AS valid_to FROM pr
  UNION ALL
  SELECT product_id, upper(p_name), aisle, department, renamed, NULL FROM pr WHERE renamed IS NOT NULL),
pv AS (
  SELECT product_id, product_name, aisle, department,
         md5(concat_ws('|', CAST(product_id AS VARCHAR), CAST(epoch_us(valid_from) AS VARCHAR))) AS scd_id,
         valid_from, valid_to
  FROM pv0)"""
USER_VERSIONS = """us AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_custkey % 4 = 0
              THEN TIMESTAMP '1997-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) END AS changed
  FROM customer),
uv0 AS (
  SELECT user_id, TIMESTAMP '1990-01-01' AS valid_from, changed AS valid_to FROM us
  UNION ALL
  SELECT user_id, changed, NULL FROM us WHERE changed IS NOT NULL),
uv AS (
  SELECT user_id,
         md5(concat_ws('|', CAST(user_id AS VARCHAR), CAST(epoch_us(valid_from) AS VARCHAR))) AS scd_id,
         valid_from, valid_to
  FROM uv0)"""
STAGED = """so AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_timestamp,
         CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS tip_given,
         'u' AS op_type, o_orderdate AS source_ts, TIMESTAMP '2024-01-01' AS staging_load_timestamp
  FROM orders WHERE o_orderkey % 10 < 8
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderdate,
         CASE WHEN o_orderkey % 10 = 7 THEN true
              WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END,
         'u', o_orderdate, TIMESTAMP '2024-01-02'
  FROM orders WHERE o_orderkey % 10 >= 7)"""
