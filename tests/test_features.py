import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderlens.functions.holidays import dim_holiday, is_holiday
from orderlens.operators.skew import LIMITS, SkewLimits
from orderlens.plans import features as ft
from orderlens.plans.dims import dim_date
from orderlens.plans.normalise import denormalise, normalise, orders_with_tips, user_chunks
from orderlens.sources import stand_ins as src


@pytest.fixture(scope="module")
def frames(spark):
    """A third of the orders belong to one user, a third of the lines to one product."""
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    orders = [
        (
            i,
            1 if i % 3 == 0 else rnd.randrange(2, 9),
            base + dt.timedelta(hours=rnd.randrange(900)),
            rnd.choice([0, 1, None]),
        )
        for i in range(240)
    ]
    lines = [
        (o, 1 if n % 3 == 0 else rnd.randrange(2, 20), n + 1)
        for o in range(240)
        if o % 20
        for n in range(rnd.randrange(1, 6))
    ]
    o = spark.createDataFrame(orders, "order_id long, user_id long, order_date timestamp_ntz, tip int")
    named = spark.createDataFrame(lines, "order_id long, product_id long, add_to_cart_order int").select(
        "*",
        F.when(F.col("product_id") % 4 == 0, "Organic Kale").otherwise("Plain Rice").alias("product_name"),
        F.concat(F.lit("dep "), F.col("product_id") % 5).alias("department"),
    )
    return o.cache(), named.cache()


TIGHT = SkewLimits(1e-4, 20)


def rounded(df):
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, 9) for c in doubles}).select(sorted(df.columns))


def test_heavy_users_get_the_same_features(spark, frames):
    orders, lines = frames
    clusters = orders.select("user_id").distinct().withColumn("cluster", (F.col("user_id") % 4).cast("int"))
    plain = ft.feature_frame(orders, lines, 3, clusters=clusters, limits=LIMITS)
    tight = ft.feature_frame(orders, lines, 3, clusters=clusters, limits=TIGHT)
    assert rows(rounded(plain)) == rows(rounded(tight))
    assert plain.count() == 228  # orders without lines are dropped
    trend = [ft.trend_cycle_features(orders, 3, limits=x) for x in (LIMITS, TIGHT)]
    assert rows(rounded(trend[0])) == rows(rounded(trend[1]))


def test_group_sums_count_orders_once(spark, frames):
    orders, lines = frames
    frame = ft.feature_frame(orders, lines, 1, limits=TIGHT)
    want = {r["user_id"]: r["count"] for r in orders.groupBy("user_id").count().collect()}
    assert all(r["no_orders"] == want[r["user_id"]] for r in frame.collect())
    by_step = ft.with_order_count(orders, TIGHT)
    assert all(r["no_orders"] == want[r["user_id"]] for r in by_step.collect())


def test_rates_can_be_fitted_on_a_training_part(spark, frames):
    orders, lines = frames
    train = orders.filter("order_date < timestamp_ntz'2024-01-20'")
    rates = ft.TipRates.fit(train, lines)
    frame = ft.feature_frame(orders, lines, 2, rates=rates)
    overall = train.join(lines.select("order_id").distinct(), "order_id").agg(F.avg("tip") * 100).first()[0]
    got = {round(r["overall_tip_proba"], 9) for r in frame.collect()}
    assert got == {round(overall, 9)}
    leaky = ft.feature_frame(orders, lines, 2)
    assert {round(r["overall_tip_proba"], 9) for r in leaky.collect()} != got


def test_backfill_can_be_turned_off(spark):
    base = dt.datetime(2024, 1, 1)
    data = [(i, 1, base + dt.timedelta(days=i), t) for i, t in enumerate([None, None, 1, None, 0])]
    df = spark.createDataFrame(data, "order_id long, user_id long, order_date timestamp_ntz, tip int")
    with_fill = [r["tip_for_shifting"] for r in ft.lag_features(df, 1).orderBy("order_id").collect()]
    without = [r["tip_for_shifting"] for r in ft.lag_features(df, 1, backfill=False).orderBy("order_id").collect()]
    assert with_fill == [1, 1, 1, 1, 0]
    assert without == [None, None, 1, 1, 0]


def test_clusters(spark, sf_dir):
    orders = src.orders(spark, sf_dir)
    clusters = ft.cluster_users(orders, restarts=3)
    counts = ft.tip_counts(orders).join(clusters, "user_id")
    assert counts.count() == ft.tip_counts(orders).count()
    centres = counts.groupBy("cluster").agg(F.avg("tips_0").alias("a"), F.avg("tips_1").alias("b")).orderBy("cluster").collect()
    assert [c["cluster"] for c in centres] == [0, 1, 2, 3]
    assert [c["a"] for c in centres] == sorted(c["a"] for c in centres)
    # Every user is nearest to the centre of their own cluster.
    again = ft.cluster_users(orders, restarts=3)
    assert rows(again) == rows(clusters)
    stranger = spark.createDataFrame([(1, -5)], "order_id long, user_id long")
    assert ft.with_clusters(stranger, clusters).first()["cluster"] == "-1"


# Federal holidays with observed days, from the public calendar.
KNOWN_HOLIDAYS = {
    2021: "01-01 01-18 02-15 05-31 06-18 06-19 07-04 07-05 09-06 10-11 11-11 11-25 12-24 12-25 12-31",
    2022: "01-01 01-17 02-21 05-30 06-19 06-20 07-04 09-05 10-10 11-11 11-24 12-25 12-26",
    2024: "01-01 01-15 02-19 05-27 06-19 07-04 09-02 10-14 11-11 11-28 12-25",
}


def test_holidays(spark):
    days = dim_holiday(spark, 2021, 2024).select("holiday_date").distinct()
    predicate = (
        dim_date(spark, dt.date(2021, 1, 1), dt.date(2025, 1, 1))
        .filter(is_holiday("full_date"))
        .select("full_date")
    )
    assert rows(days) == rows(predicate)
    got = [r[0] for r in days.collect()]
    for year, text in KNOWN_HOLIDAYS.items():
        assert sorted(d.strftime("%m-%d") for d in got if d.year == year) == text.split()
    orders = spark.createDataFrame([(1, dt.datetime(2024, 7, 4, 9)), (2, dt.datetime(2024, 7, 5))], "order_id long, order_date timestamp_ntz")
    for flagged in (ft.holiday_lookup(orders, 2024, 2024), ft.temporal_features(orders)):
        assert [r["is_holiday"] for r in flagged.orderBy("order_id").collect()] == [True, False]


def test_calendar_defaults_and_guard(spark):
    year = dim_date(spark, today=dt.date(2020, 1, 10))
    assert year.count() == 365 + 9  # end is exclusive
    assert dim_date(spark, dt.date(2024, 5, 1), dt.date(2024, 1, 1)).count() == 1


def test_normalise_and_back(spark, frames):
    orders, lines = frames
    lines = lines.withColumn("aisle_id", F.col("product_id") % 3).withColumn("aisle", F.lit("a")).withColumn(
        "department_id", F.when(F.col("product_id") != 7, F.col("product_id") % 5)
    )
    tips = spark.createDataFrame([("1", "True"), ("2", "False"), ("3", "maybe")], "order_id string, tip string")
    tables = normalise(orders.drop("tip"), tips, lines)
    assert set(tables) == {"users", "departments", "aisles", "products", "orders", "order_products"}
    assert tables["departments"].filter("department_id is null").count() == 0
    flags = {r["order_id"]: r["tip_given"] for r in tables["orders"].collect()}
    assert (flags[1], flags[2], flags[3], flags[4]) == (True, False, None, None)
    assert orders_with_tips(orders, None).filter("tip_given is not null").count() == 0
    full = denormalise(orders.drop("tip"), lines, TIGHT)
    assert full.count() == lines.count() + 12
    assert rows(full) == rows(denormalise(orders.drop("tip"), lines))


def test_chunks_without_lines_keep_their_orders(spark, frames):
    orders, lines = frames
    only_first = lines.join(orders.filter("user_id = 1"), "order_id", "left_semi")
    chunked = user_chunks(orders.drop("tip"), only_first, 0.125, TIGHT)
    sizes = {r["user_chunk"]: r["count"] for r in chunked.groupBy("user_chunk").count().collect()}
    per_user = {r["user_id"]: r["count"] for r in orders.groupBy("user_id").count().collect()}
    assert sizes[1] == only_first.count()
    assert all(sizes[c] == per_user[c] for c in range(2, 9))
