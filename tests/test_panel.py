"""Heavy keys must give the same answers as plain windows and joins."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from orderlens.operators.panel import as_of, fill, group_sums, make_panel, shift
from orderlens.operators.skew import SkewLimits, find_heavy, salted_join


def skewed(spark, n=900, one_instant=False, nulls=0.4, no_time=0.0):
    """A third of the rows belong to key 1; instants repeat, values have gaps.

    ``one_instant`` may be True (all rows), or "mostly": two instants hold most rows.
    """
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data = []
    for i in range(n):
        key = 1 if i % 3 == 0 else rnd.choice([2, 3, 4, 5, None])
        at = base if one_instant is True else base + dt.timedelta(hours=rnd.randrange(60))
        if one_instant == "mostly" and rnd.random() < 0.8:
            at = base + dt.timedelta(hours=rnd.choice([20, 21]))
        if no_time and rnd.random() < no_time:
            at = None
        value = None if rnd.random() < nulls else rnd.randrange(100)
        data.append((key, at, i, value))
    return spark.createDataFrame(data, "k long, ts timestamp_ntz, id long, v int")


@pytest.mark.parametrize("no_time", [0.0, 0.2])
@pytest.mark.parametrize("one_instant", [False, True, "mostly"])
@pytest.mark.parametrize("min_rows", [20, 200, 10_000])
def test_shift_and_fill_equal_plain_windows(spark, one_instant, min_rows, no_time):
    df = skewed(spark, one_instant=one_instant, no_time=no_time)
    panel = make_panel(df, ["k"], "ts", "id", limits=SkewLimits(1e-4, min_rows))
    assert (panel.heavy is None) == (min_rows > 500)
    panel = shift(panel, "v", [1, 2, 4], ["l1", "l2", "l4"])
    panel = shift(panel, "v", [1, 3], ["n1", "n3"], ahead=True)
    panel = fill(panel, "v", "ff")
    panel = fill(panel, "v", "fb", backward=True)
    got = panel.result()

    w = Window.partitionBy("k").orderBy("ts", "id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    rest = w.rowsBetween(0, Window.unboundedFollowing)
    want = (
        df.withColumn("l1", F.lag("v", 1).over(w))
        .withColumn("l2", F.lag("v", 2).over(w))
        .withColumn("l4", F.lag("v", 4).over(w))
        .withColumn("n1", F.lead("v", 1).over(w))
        .withColumn("n3", F.lead("v", 3).over(w))
        .withColumn("ff", F.last("v", True).over(run))
        .withColumn("fb", F.first("v", True).over(rest))
        .withColumn("fb", F.coalesce("ff", "fb"))
    )
    for c in want.columns[4:]:
        want = want.withColumn(c, F.when(F.col("k").isNotNull(), F.col(c)))
    assert rows(got.select(want.columns)) == rows(want)


@pytest.mark.parametrize("no_time", [0.0, 0.3, 1.0])
@pytest.mark.parametrize("min_rows", [20, 10_000])
def test_group_sums_equal_plain_windows(spark, min_rows, no_time):
    df = skewed(spark, no_time=no_time)
    panel = make_panel(df, ["k"], "ts", "id", limits=SkewLimits(1e-4, min_rows))
    got = group_sums(panel, {"s": F.col("v"), "n": F.lit(1)}).result()
    w = Window.partitionBy("k")
    known = F.col("k").isNotNull()
    want = df.withColumn("s", F.when(known, F.sum("v").over(w))).withColumn("n", F.when(known, F.count("*").over(w)))
    assert rows(got.select(want.columns)) == rows(want)


def test_heavy_groups_are_really_cut(spark):
    panel = make_panel(skewed(spark), ["k"], "ts", "id", limits=SkewLimits(1e-4, 50))
    sizes = panel.rows.groupBy("k", "_block").count().filter("_block is not null")
    assert sizes.count() > 10
    assert sizes.agg(F.max("count")).first()[0] < 100
    for instant in (True, "mostly"):
        df = skewed(spark, one_instant=instant)
        one = make_panel(df, ["k"], "ts", "id", limits=SkewLimits(1e-4, 50))
        # Two light instants may share a stretch of time; a heavy one is always cut.
        sizes = one.rows.groupBy("k", "_block").count()
        assert sizes.agg(F.max("count")).first()[0] < (51 if instant is True else 100)


def test_heavy_key_table_is_bounded(spark):
    df = spark.range(100_000).select((F.col("id") % 97).alias("k"))
    heavy = find_heavy(df, ["k"], SkewLimits(0.005, 1))
    assert heavy.count() <= 200
    assert heavy.agg(F.sum("_pieces")).first()[0] <= 400


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    many = skewed(spark)
    one = spark.createDataFrame([(1, "a"), (2, "b"), (9, "z"), (1, "a2")], "k long, name string")
    got = salted_join(many, one, ["k"], how, ["id"], heavy="detect", limits=SkewLimits(1e-4, 30))
    assert rows(got) == rows(many.join(one, ["k"], how))


@pytest.mark.parametrize("instant", [False, "mostly"])
@pytest.mark.parametrize("min_rows", [20, 10_000])
def test_as_of_equals_range_join(spark, min_rows, instant):
    facts = skewed(spark, one_instant=instant)
    base = dt.datetime(2024, 1, 1)
    versions = []
    for k in (1, 2, 3):
        for j in range(12):
            start = base + dt.timedelta(hours=5 * j + k)
            end = start + dt.timedelta(hours=4 if j % 3 == 0 else 5)
            versions.append((k, start, None if j == 11 else end, f"{k}-{j}"))
    dim = spark.createDataFrame(
        versions, "k long, valid_from timestamp_ntz, valid_to timestamp_ntz, sk string"
    )
    got = as_of(facts, dim, "k", "ts", "valid_from", "valid_to", {"sk": "sk"}, limits=SkewLimits(1e-4, min_rows))
    d = dim.withColumnRenamed("k", "dk")
    want = facts.join(
        d,
        F.expr("k = dk and ts >= valid_from and ts < coalesce(valid_to, timestamp_ntz'9999-12-31')"),
        "left",
    ).select("k", "ts", "id", "v", "sk")
    assert rows(got) == rows(want)


def test_as_of_moves_only_what_is_used(spark):
    """Unused columns of the facts are dropped before the shuffle; what is kept is the same, also beside odd names."""
    facts = spark.createDataFrame(
        [(1, "2024-01-05", "x", 7), (1, "2024-01-01", "y", 8), (2, "2024-01-05", "z", 9), (None, "2024-01-05", None, 1)],
        "k long, day string, payload string, _kind int",
    ).withColumn("ts", F.to_timestamp_ntz("day"))
    dim = spark.createDataFrame([(1, "2024-01-02", None, "a")], "k long, f string, t string, sk string").select(
        "k", F.to_timestamp("f").alias("valid_from"), F.to_timestamp("t").alias("valid_to"), "sk"
    )
    got = as_of(facts, dim, "k", "ts", "valid_from", "valid_to", {"sk": "sk"}, heavy=None)
    assert got.columns == [*facts.columns, "sk"] and dict(got.dtypes)["ts"] == "timestamp_ntz"
    assert sorted((r["payload"] or "", r["_kind"], r["sk"]) for r in got.collect()) == [("", 1, None), ("x", 7, "a"), ("y", 8, None), ("z", 9, None)]
    plan = got.select("k", "sk")._jdf.queryExecution().optimizedPlan().toString()
    assert "_fact_payload" not in plan and "xxhash64" not in plan


def test_ids_are_packed_without_loss(spark):
    from orderlens.functions.scalars import packed_id, unpacked_id

    ids = ["0" * 32, "d41d8cd98f00b204e9800998ecf8427e", "D41D8CD98F00B204E9800998ECF8427E", "", "user-1", "x" * 15, "x" * 16, "g" * 32, "äöü", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string").withColumn("p", packed_id("id")).withColumn("back", unpacked_id("p"))
    got = df.collect()
    assert all(r["id"] == r["back"] for r in got)
    assert len({bytes(r["p"]) for r in got if r["p"] is not None}) == len(ids) - 1
    assert [len(r["p"]) for r in got[:2]] == [16, 16]
