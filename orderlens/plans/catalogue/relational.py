"""Joins, aggregates, sorts, set operations and scalar functions on orders and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import dates
from orderlens.functions.scalars import contains_word, cyclic, text_to_bool, valid_identifier
from orderlens.operators import quality
from orderlens.operators.ranking import key_chunks
from orderlens.operators.series import contingency
from orderlens.operators.skew import salted_join
from orderlens.plans import features as ft
from orderlens.plans.catalogue.registry import CLICKS, L, LINES, O, query
from orderlens.plans.catalogue.warehouse import HOLIDAYS_SQL
from orderlens.plans.models import prediction_sets
from orderlens.plans.normalise import denormalise, normalise, orders_with_tips
from orderlens.sources import stand_ins as src


def tip_files(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders, known tips and open orders as three separate inputs."""
    base = src.orders(spark, sf)
    return (
        base.select("order_id", "user_id", "order_date"),
        base.filter(F.col("tip").isNotNull()).select("order_id", "tip"),
        base.filter(F.col("tip").isNull()).select("order_id", "tip"),
    )


# ---- filters and projections ------------------------------------------------------


@query(
    "c9_bool_map",
    """SELECT o_orderkey AS order_id,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS tip_given FROM orders""",
)
def c9_bool_map(spark, sf):
    text = F.when(F.col("tip") == 1, "True").when(F.col("tip") == 0, "False").otherwise("unknown")
    return src.orders(spark, sf).select("order_id", text.alias("tip")).select(
        "order_id", text_to_bool("tip").alias("tip_given")
    )


@query(
    "c10_target_recast",
    f"""WITH {O} SELECT order_id, tip, CAST(tip AS BOOLEAN) AS tip_flag FROM o""",
)
def c10_target_recast(spark, sf):
    flagged = src.orders(spark, sf).withColumn("tip_flag", F.col("tip").cast("boolean"))
    return flagged.select("order_id", F.col("tip_flag").cast("int").alias("tip"), "tip_flag")


@query(
    "c13_null_target_split",
    f"""WITH {O} SELECT tip IS NULL AS to_predict, count(*) AS orders, min(order_date) AS first_order,
       max(order_date) AS last_order FROM o GROUP BY 1""",
)
def c13_null_target_split(spark, sf):
    return (
        src.orders(spark, sf)
        .groupBy(F.col("tip").isNull().alias("to_predict"))
        .agg(
            F.count(F.lit(1)).alias("orders"), F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
    )


@query("c14_drop_incomplete", f"""WITH {O} SELECT order_id, tip FROM o WHERE tip IS NOT NULL""")
def c14_drop_incomplete(spark, sf):
    return src.orders(spark, sf).na.drop(subset=["tip", "user_id"]).select("order_id", "tip")


@query("c16_fill_constant", f"""WITH {O} SELECT order_id, coalesce(tip, -1) AS tip FROM o""")
def c16_fill_constant(spark, sf):
    return src.orders(spark, sf).na.fill(-1, subset=["tip"]).select("order_id", "tip")


@query(
    "c17_word_in_name",
    """SELECT p_partkey AS product_id, contains(lower(p_name), 'red') AS is_organic FROM part""",
)
def c17_word_in_name(spark, sf):
    return src.products(spark, sf).select(
        "product_id", contains_word("product_name", src.ORGANIC_STAND_IN).alias("is_organic")
    )


@query("c18_drop_columns", """SELECT o_orderkey AS order_id, o_orderdate AS order_date FROM orders""")
def c18_drop_columns(spark, sf):
    return src.orders(spark, sf).drop("user_id", "tip")


@query(
    "c19_weekend",
    """SELECT isodow(ts) IN (6, 7) AS is_weekend, count(*) AS events FROM events GROUP BY 1""",
)
def c19_weekend(spark, sf):
    return (
        src.clicks(spark, sf)
        .groupBy((F.weekday("order_date") >= 5).alias("is_weekend"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


# ---- joins -----------------------------------------------------------------------


@query(
    "d1_dim_chain",
    """WITH a AS (SELECT p_brand, count(*) AS aisle_products FROM part GROUP BY 1),
t AS (SELECT p_type, count(*) AS department_products FROM part GROUP BY 1)
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS aisle, aisle_products,
       p_type AS department, department_products
FROM part LEFT JOIN a USING (p_brand) LEFT JOIN t USING (p_type)""",
)
def d1_dim_chain(spark, sf):
    products = src.products(spark, sf)
    n = F.count(F.lit(1))
    aisles = products.groupBy("aisle").agg(n.alias("aisle_products"))
    departments = products.groupBy("department").agg(n.alias("department_products"))
    return products.join(aisles, "aisle", "left").join(departments, "department", "left")


@query(
    "d2_newest_branches",
    """WITH r AS (SELECT l_partkey AS product_id, l_returnflag, l_shipdate, l_orderkey, l_linenumber,
  row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
  FROM lineitem)
SELECT n.product_id, n.l_orderkey AS newest_n, a.l_orderkey AS newest_a, r.l_orderkey AS newest_r
FROM (SELECT * FROM r WHERE rn = 1 AND l_returnflag = 'N') n
LEFT JOIN (SELECT * FROM r WHERE rn = 1 AND l_returnflag = 'A') a USING (product_id)
LEFT JOIN (SELECT * FROM r WHERE rn = 1 AND l_returnflag = 'R') r USING (product_id)""",
)
def d2_newest_branches(spark, sf):
    """Three "newest row" branches of one key: one conditional aggregate, no join."""
    lines = src.table(spark, sf, "lineitem")
    place = F.struct("l_shipdate", "l_orderkey", "l_linenumber")

    def newest(flag: str):
        return F.max_by("l_orderkey", F.when(F.col("l_returnflag") == flag, place)).alias(f"newest_{flag.lower()}")

    return (
        lines.groupBy(F.col("l_partkey").alias("product_id"))
        .agg(newest("N"), newest("A"), newest("R"))
        .filter(F.col("newest_n").isNotNull())
    )


@query(
    "d6_orders_with_tips",
    f"""WITH {O} SELECT order_id, user_id, order_date, tip FROM o WHERE tip IS NOT NULL""",
)
def d6_orders_with_tips(spark, sf):
    orders, tips, _ = tip_files(spark, sf)
    return orders.join(tips, "order_id")


@query(
    "d7_left_tip",
    """SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS tip_given FROM orders""",
)
def d7_left_tip(spark, sf):
    orders, tips, _ = tip_files(spark, sf)
    as_text = orders.withColumn("order_id", F.col("order_id").cast("string"))
    return orders_with_tips(as_text, tips.withColumn("tip", F.col("tip").cast("boolean").cast("string")))


@query(
    "d8_semi_unlabelled",
    f"""WITH {O} SELECT order_id, user_id, tip FROM o
WHERE user_id IN (SELECT user_id FROM o WHERE tip IS NULL)""",
)
def d8_semi_unlabelled(spark, sf):
    orders = src.orders(spark, sf).select("order_id", "user_id", "tip")
    open_users = orders.filter(F.col("tip").isNull()).select("user_id").distinct()
    return salted_join(orders, open_users, ["user_id"], "left_semi", ["order_id"])


@query(
    "d11_group_mean",
    f"""WITH {CLICKS} SELECT order_id, avg(tip) OVER (PARTITION BY user_id) AS user_rate FROM ev""",
)
def d11_group_mean(spark, sf):
    return ft.with_user_mean(src.clicks(spark, sf), "tip", "user_rate").select("order_id", "user_rate")


@query(
    "d12_denormalise",
    f"""WITH {O}, {L} SELECT o.order_id, o.user_id, o.order_date, l.product_id, l.add_to_cart_order
FROM o LEFT JOIN l ON o.order_id = l.order_id""",
)
def d12_denormalise(spark, sf):
    orders = src.orders(spark, sf).select("order_id", "user_id", "order_date")
    return denormalise(orders, src.order_products(spark, sf))


@query(
    "d13_scalar_mean",
    f"""WITH {O} SELECT order_id, round((SELECT avg(tip) * 100 FROM o), 9) AS overall_tip_proba FROM o""",
)
def d13_scalar_mean(spark, sf):
    orders = src.orders(spark, sf)
    return orders.select("order_id", F.round(ft.overall_rate(orders).scalar(), 9).alias("overall_tip_proba"))


@query(
    "d14_holiday_lookup",
    f"""WITH {HOLIDAYS_SQL} SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) IN (SELECT d FROM hol) AS is_holiday
FROM orders""",
)
def d14_holiday_lookup(spark, sf):
    return ft.holiday_lookup(src.orders(spark, sf)).select("order_id", "is_holiday")


@query(
    "d16_inner_cart",
    f"""WITH {O}, {L} SELECT o.order_id, o.user_id, max(add_to_cart_order) AS cart_size
FROM o JOIN l ON o.order_id = l.order_id GROUP BY 1, 2""",
)
def d16_inner_cart(spark, sf):
    orders = src.orders(spark, sf).select("order_id", "user_id")
    return ft.with_cart_size(orders, src.order_products(spark, sf))


# ---- aggregates --------------------------------------------------------------------


@query(
    "e1_dimensions",
    f"""WITH {LINES}
SELECT 'departments' AS entity, count(*) AS n FROM (SELECT DISTINCT department FROM d WHERE department IS NOT NULL)
UNION ALL SELECT 'aisles', count(*) FROM (SELECT DISTINCT aisle FROM d WHERE aisle IS NOT NULL)
UNION ALL SELECT 'products', count(*) FROM (SELECT DISTINCT product_id, product_name, aisle, department FROM d)
UNION ALL SELECT 'users', (SELECT count(DISTINCT o_custkey) FROM orders)
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders)
UNION ALL SELECT 'order_products', (SELECT count(*) FROM lineitem)""",
)
def e1_dimensions(spark, sf):
    """L13: all six entity tables out of the denormalised files, counted."""
    orders, tips, _ = tip_files(spark, sf)
    lines = (
        src.order_lines(spark, sf)
        .withColumn("aisle_id", F.col("aisle"))
        .withColumn("department_id", F.col("department"))
    )
    tables = normalise(orders, tips, lines)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("entity"), "n")
        for name, df in tables.items()
    ]
    return quality.report(counts)


@query(
    "l13_products",
    f"""WITH {LINES} SELECT DISTINCT product_id, product_name, aisle AS aisle_id, department AS department_id FROM d""",
)
def l13_products(spark, sf):
    orders, tips, _ = tip_files(spark, sf)
    lines = (
        src.order_lines(spark, sf)
        .withColumn("aisle_id", F.col("aisle"))
        .withColumn("department_id", F.col("department"))
    )
    return normalise(orders, tips, lines)["products"]


@query("e2_distinct_users", "SELECT DISTINCT o_custkey AS user_id FROM orders")
def e2_distinct_users(spark, sf):
    return src.orders(spark, sf).select("user_id").distinct()


@query(
    "e3_cart_size",
    f"""WITH {L} SELECT order_id, max(add_to_cart_order) AS cart_size FROM l GROUP BY 1""",
)
def e3_cart_size(spark, sf):
    return ft.cart_size(src.order_products(spark, sf))


@query(
    "e4_avg_cart",
    f"""WITH {O}, {L}, c AS (SELECT order_id, max(add_to_cart_order) AS cart_size FROM l GROUP BY 1)
SELECT order_id, user_id, cart_size, round(avg(cart_size) OVER (PARTITION BY user_id), 9) AS avg_no_prod
FROM o JOIN c USING (order_id)""",
)
def e4_avg_cart(spark, sf):
    sized = ft.with_cart_size(src.orders(spark, sf).select("order_id", "user_id"), src.order_products(spark, sf))
    return ft.with_user_mean(sized, "cart_size", "avg_no_prod").withColumn(
        "avg_no_prod", F.round("avg_no_prod", 9)
    )


@query(
    "e5_order_count",
    f"""WITH {O}, n AS (SELECT user_id, count(DISTINCT order_id) AS no_orders FROM o GROUP BY 1)
SELECT order_id, user_id, no_orders FROM o JOIN n USING (user_id)""",
)
def e5_order_count(spark, sf):
    return ft.with_order_count(src.orders(spark, sf).select("order_id", "user_id"))


@query(
    "e6_weekday",
    f"""WITH {O} SELECT CAST(isodow(order_date) - 1 AS INTEGER) AS weekday,
       round(avg(tip) * 100, 9) AS tip_proba_per_weekday FROM o GROUP BY 1 ORDER BY 2 DESC""",
)
def e6_weekday(spark, sf):
    days = src.orders(spark, sf).withColumn("weekday", F.weekday("order_date"))
    rates = ft.rate_by(days, "weekday", "tip_proba_per_weekday")
    return rates.withColumn("tip_proba_per_weekday", F.round("tip_proba_per_weekday", 9)).orderBy(
        F.desc("tip_proba_per_weekday")
    )


@query(
    "e7_hour",
    f"""WITH {CLICKS} SELECT CAST(hour(order_date) AS INTEGER) AS hour, round(avg(tip) * 100, 9) AS tip_proba_per_hour
FROM ev GROUP BY 1""",
)
def e7_hour(spark, sf):
    hours = src.clicks(spark, sf).withColumn("hour", F.hour("order_date"))
    return ft.rate_by(hours, "hour", "tip_proba_per_hour").withColumn(
        "tip_proba_per_hour", F.round("tip_proba_per_hour", 9)
    )


@query(
    "e8_department",
    f"""WITH {O}, {LINES}
SELECT department, round(avg(tip) * 100, 9) AS tip_proba_per_department
FROM d JOIN o USING (order_id) WHERE tip IS NOT NULL GROUP BY 1""",
)
def e8_department(spark, sf):
    return ft.department_rates(src.orders(spark, sf), src.order_lines(spark, sf)).withColumn(
        "tip_proba_per_department", F.round("tip_proba_per_department", 9)
    )


@query("e9_overall", f"""WITH {O} SELECT round(avg(tip) * 100, 9) AS overall_tip_proba FROM o""")
def e9_overall(spark, sf):
    return ft.overall_rate(src.orders(spark, sf)).withColumn(
        "overall_tip_proba", F.round("overall_tip_proba", 9)
    )


@query(
    "e11_counts",
    """SELECT (SELECT count(*) FROM part) AS products, (SELECT count(*) FROM orders) AS orders,
       (SELECT count(*) FROM lineitem) AS order_lines""",
)
def e11_counts(spark, sf):
    return spark.sql(
        """SELECT (SELECT count(*) FROM {products}) AS products, (SELECT count(*) FROM {orders}) AS orders,
                  (SELECT count(*) FROM {lines}) AS order_lines""",
        products=src.table(spark, sf, "part"),
        orders=src.table(spark, sf, "orders"),
        lines=src.table(spark, sf, "lineitem"),
    )


@query(
    "e13_pivot",
    f"""WITH {O} SELECT user_id, count(*) FILTER (WHERE tip = 0) AS tips_0, count(*) FILTER (WHERE tip = 1) AS tips_1
FROM o WHERE tip IS NOT NULL GROUP BY 1""",
)
def e13_pivot(spark, sf):
    return ft.tip_counts(src.orders(spark, sf))


_CONTINGENCY = """SELECT grouping_name, grp, no_tip, with_tip FROM (
  SELECT 'weekday' AS grouping_name, strftime(order_date, '%A') AS grp,
         count(*) FILTER (WHERE tip = 0) AS no_tip, count(*) FILTER (WHERE tip = 1) AS with_tip FROM ev GROUP BY 2
  UNION ALL SELECT 'hour', CAST(hour(order_date) AS VARCHAR),
         count(*) FILTER (WHERE tip = 0), count(*) FILTER (WHERE tip = 1) FROM ev GROUP BY 2
  UNION ALL SELECT 'weekday_hour', strftime(order_date, '%A_%H'),
         count(*) FILTER (WHERE tip = 0), count(*) FILTER (WHERE tip = 1) FROM ev GROUP BY 2)"""


def contingency_tables(spark, sf) -> dict[str, DataFrame]:
    clicks = src.clicks(spark, sf)
    t = F.col("order_date")
    return {
        "weekday": contingency(clicks, dates.day_name(t), "tip"),
        "hour": contingency(clicks, F.hour(t).cast("string"), "tip"),
        "weekday_hour": contingency(clicks, dates.weekday_hour_label(t), "tip"),
    }


@query("e14_contingency", f"WITH {CLICKS} {_CONTINGENCY}")
def e14_contingency(spark, sf):
    named = [
        table.withColumn("grouping_name", F.lit(name))
        for name, table in contingency_tables(spark, sf).items()
    ]
    return quality.report(named)


@query(
    "e15_profiles",
    f"""WITH {CLICKS}
SELECT 'weekday' AS profile, strftime(order_date, '%A') AS grp, CAST(isodow(order_date) - 1 AS INTEGER) AS pos,
       round(avg(tip), 9) AS tip_rate FROM ev GROUP BY 2, 3
UNION ALL SELECT 'hour', CAST(hour(order_date) AS VARCHAR), CAST(hour(order_date) AS INTEGER), round(avg(tip), 9)
 FROM ev GROUP BY 2, 3
UNION ALL SELECT 'date', strftime(order_date, '%Y-%m-%d'), CAST(isodow(order_date) - 1 AS INTEGER), round(avg(tip), 9)
 FROM ev GROUP BY 2, 3
UNION ALL SELECT 'week', concat(CAST(year(order_date) AS VARCHAR), '-W', lpad(CAST(weekofyear(order_date) AS VARCHAR), 2, '0')),
 0, round(avg(tip), 9) FROM ev GROUP BY 2, 3""",
)
def e15_profiles(spark, sf):
    """K7: tip rate by weekday (with sort position), hour, date (with weekday) and ISO week."""
    clicks = src.clicks(spark, sf)
    t = F.col("order_date")
    rate = F.round(F.avg("tip"), 9).alias("tip_rate")

    def profile(name, label, position):
        grouped = clicks.groupBy(label.alias("grp"), position.alias("pos")).agg(rate)
        return grouped.withColumn("profile", F.lit(name))

    return quality.report(
        [
            profile("weekday", dates.day_name(t), F.weekday(t)),
            profile("hour", F.hour(t).cast("string"), F.hour(t)),
            profile("date", F.to_date(t).cast("string"), F.weekday(t)),
            profile("week", dates.iso_week_label(t), F.lit(0)),
        ]
    )


@query(
    "e16_first_date",
    """SELECT min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders""",
)
def e16_first_date(spark, sf):
    return src.orders(spark, sf).agg(F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"))


@query(
    "e19_organic",
    f"""WITH {O}, {LINES}, f AS (SELECT order_id, bool_or(contains(lower(product_name), 'red')) AS x FROM d GROUP BY 1)
SELECT o.order_id, coalesce(f.x, false) AS order_contains_organic FROM o LEFT JOIN f USING (order_id)""",
)
def e19_organic(spark, sf):
    orders = src.orders(spark, sf).select("order_id")
    return ft.with_organic_flag(orders, src.order_lines(spark, sf), src.ORGANIC_STAND_IN)


# ---- chunks, order, top-k ------------------------------------------------------------


@query(
    "f6_chunks",
    f"""WITH u AS (SELECT DISTINCT o_custkey AS user_id FROM orders),
s AS (SELECT greatest(1, CAST(floor(count(*) * 0.1) AS BIGINT)) AS size FROM u)
SELECT user_id, CAST((row_number() OVER (ORDER BY user_id) - 1) // (SELECT size FROM s) + 1 AS INTEGER) AS chunk FROM u""",
)
def f6_chunks(spark, sf):
    return key_chunks(src.orders(spark, sf), "user_id", 0.1)


@query(
    "g2_most_recent",
    """SELECT o_orderkey AS order_id, o_orderdate AS order_date FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""",
)
def g2_most_recent(spark, sf):
    return (
        src.orders(spark, sf)
        .orderBy(F.desc("order_date"), F.desc("order_id"))
        .limit(1)
        .select("order_id", "order_date")
    )


@query(
    "g3_sorted_orders",
    """SELECT o_custkey AS user_id, o_orderdate AS order_date, o_orderkey AS order_id FROM orders
ORDER BY 1, 2, 3""",
)
def g3_sorted_orders(spark, sf):
    return src.orders(spark, sf).select("user_id", "order_date", "order_id").orderBy(
        "user_id", "order_date", "order_id"
    )


@query(
    "g4_rate_descending",
    f"""WITH {O}, {LINES} SELECT aisle, round(avg(tip) * 100, 9) AS tip_rate, count(tip) AS lines
FROM d JOIN o USING (order_id) GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def g4_rate_descending(spark, sf):
    # Lines are summed per order and aisle before the join with the tips.
    sums = src.order_lines(spark, sf).groupBy("order_id", "aisle").agg(F.count(F.lit(1)).alias("n"))
    tips = src.orders(spark, sf).filter(F.col("tip").isNotNull()).select("order_id", "tip")
    rate = F.sum(F.col("n") * F.col("tip")) / F.sum("n") * 100
    return (
        sums.join(tips, "order_id")
        .groupBy("aisle")
        .agg(F.round(rate, 9).alias("tip_rate"), F.sum("n").alias("lines"))
        .orderBy(F.desc("tip_rate"), "aisle")
    )


@query(
    "g5_order_by_ordinal",
    """SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS orders
FROM orders GROUP BY 1, 2 ORDER BY 1, 2""",
)
def g5_order_by_ordinal(spark, sf):
    return spark.sql(
        """SELECT bigint(year(order_date)) AS year, bigint(month(order_date)) AS month, count(*) AS orders
           FROM {o} GROUP BY 1, 2 ORDER BY 1, 2""",
        o=src.orders(spark, sf),
    )


@query(
    "g6_preview",
    """(SELECT o_orderkey AS order_id, o_orderdate AS order_date FROM orders ORDER BY 2, 1 LIMIT 4)
UNION (SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 4)""",
)
def g6_preview(spark, sf):
    return quality.preview(src.orders(spark, sf).select("order_id", "order_date"), ["order_date", "order_id"])


# ---- set operations --------------------------------------------------------------------


@query("h1_union_sets", f"WITH {O} SELECT order_id, tip FROM o")
def h1_union_sets(spark, sf):
    _, tips, template = tip_files(spark, sf)
    return tips.unionByName(template.drop("tip"), allowMissingColumns=True)


@query(
    "h3_drop_duplicates",
    f"""WITH {L} SELECT order_id, product_id, min(add_to_cart_order) AS first_position, count(*) AS copies
FROM l GROUP BY 1, 2""",
)
def h3_drop_duplicates(spark, sf):
    lines = src.order_products(spark, sf)
    return lines.groupBy("order_id", "product_id").agg(
        F.min("add_to_cart_order").alias("first_position"), F.count(F.lit(1)).alias("copies")
    )


@query(
    "m16_prediction_sets",
    f"""WITH {O} SELECT 'labelled' AS part, order_id, user_id, order_date, tip FROM o WHERE tip IS NOT NULL
UNION ALL SELECT 'scoring', order_id, user_id, order_date, tip FROM o
WHERE user_id IN (SELECT user_id FROM o WHERE tip IS NULL)""",
)
def m16_prediction_sets(spark, sf):
    sets = prediction_sets(*tip_files(spark, sf))
    named = [
        df.select(F.lit(name).alias("part"), "order_id", "user_id", "order_date", "tip")
        for name, df in sets.items()
    ]
    return quality.report(named)


# ---- scalar functions ------------------------------------------------------------------


@query(
    "i_time_functions",
    """SELECT event_id,
  date_trunc('millisecond', ts) AS from_millis, ts AS from_micros, strftime(ts, '%Y-%m-%d %H:%M:%S') AS micros_text,
  CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
  CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  CAST(dayofyear(ts) AS INTEGER) AS day_of_year, CAST(quarter(ts) AS INTEGER) AS quarter,
  CAST(isodow(ts) AS INTEGER) AS iso_weekday, CAST(strftime(ts, '%U') AS INTEGER) AS sunday_week,
  CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour,
  (epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) // 86400000000 AS days_since_start,
  CAST(ts AS DATE) AS date, strftime(ts, '%A') AS day_name,
  concat(CAST(year(ts) AS VARCHAR), '-W', lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0')) AS iso_week,
  strftime(ts, '%A_%H') AS weekday_hour, strftime(ts, '%m') AS month_part, strftime(ts, '%d') AS day_part,
  round(sin(2 * pi() * (isodow(ts) - 1) / 7), 9) AS weekday_sin,
  round(cos(2 * pi() * (isodow(ts) - 1) / 7), 9) AS weekday_cos
FROM events""",
)
def i_time_functions(spark, sf):
    events = src.table(spark, sf, "events")
    ts = F.col("ts")
    start = events.agg(F.min("ts").alias("m")).scalar()
    rows = events.withColumns(
        {"_ms": dates.millis(ts), "_us": dates.micros(ts), "weekday": F.weekday(ts)}
    )
    parts = dates.partition_parts(ts)
    sin, cos = cyclic("weekday", 7)
    return rows.select(
        "event_id",
        dates.from_millis("_ms").cast("timestamp_ntz").alias("from_millis"),
        dates.from_micros("_us").cast("timestamp_ntz").alias("from_micros"),
        dates.micros_text("_us").alias("micros_text"),
        dates.date_key(ts).alias("date_key"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.dayofyear(ts).alias("day_of_year"),
        F.quarter(ts).alias("quarter"),
        dates.iso_weekday(ts).alias("iso_weekday"),
        dates.sunday_week(ts).alias("sunday_week"),
        "weekday",
        F.hour(ts).alias("hour"),
        dates.whole_days_between(start, "ts").alias("days_since_start"),
        F.to_date(ts).alias("date"),
        dates.day_name(ts).alias("day_name"),
        dates.iso_week_label(ts).alias("iso_week"),
        dates.weekday_hour_label(ts).alias("weekday_hour"),
        parts["month"].alias("month_part"),
        parts["day"].alias("day_part"),
        F.round(sin, 9).alias("weekday_sin"),
        F.round(cos, 9).alias("weekday_cos"),
    )


@query(
    "i_text_functions",
    """SELECT p_partkey AS product_id, lower(p_name) AS name_lower, contains(lower(p_name), 'red') AS has_word,
  regexp_matches(p_brand, '^[a-zA-Z0-9_]+$') AS is_identifier, CAST(p_partkey AS VARCHAR) AS id_text,
  round(p_retailprice * 100, 2) AS scaled, TRY_CAST(p_brand AS BIGINT) AS brand_number,
  coalesce(TRY_CAST(replace(p_brand, 'Brand#', '') AS BIGINT), -1) AS brand_id
FROM part""",
)
def i_text_functions(spark, sf):
    from orderlens.functions.scalars import IDENTIFIER, number_or_null

    assert valid_identifier("f_orders")
    part = src.table(spark, sf, "part").withColumn("digits", F.regexp_replace("p_brand", "Brand#", ""))
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.lower("p_name").alias("name_lower"),
        contains_word("p_name", src.ORGANIC_STAND_IN).alias("has_word"),
        F.col("p_brand").rlike(IDENTIFIER).alias("is_identifier"),
        F.col("p_partkey").cast("string").alias("id_text"),
        F.round(F.col("p_retailprice") * 100, 2).alias("scaled"),
        number_or_null("p_brand").alias("brand_number"),
        F.coalesce(number_or_null("digits"), F.lit(-1)).cast("long").alias("brand_id"),
    )
