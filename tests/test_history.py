import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderlens.operators.history import history_from_changes, open_versions, snapshot_step
from orderlens.operators.latest import latest_by_key, latest_by_rank, newer_than_target, upsert
from orderlens.operators.skew import SkewLimits
from orderlens.plans.facts import BROADCAST_VERSIONS, point_in_time_key, small_enough

BASE = dt.datetime(2024, 1, 1)
EMPTY = "k long, a int, scd_id string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def changes(spark, n=300, deletes=0.15):
    """Key 1 holds a third of the changes; some share an instant."""
    rnd = random.Random(11)
    out = []
    for i in range(n):
        k = 1 if i % 3 == 0 else rnd.randrange(2, 9)
        op = "d" if rnd.random() < deletes else "u"
        out.append((k, BASE + dt.timedelta(hours=rnd.randrange(80)), op, i, i % 17))
    return spark.createDataFrame(out, "k long, ts timestamp_ntz, op string, id long, a int")


@pytest.mark.parametrize("min_rows", [20, 10_000])
def test_history_from_changes(spark, min_rows):
    log = changes(spark)
    got = history_from_changes(log, "k", "ts", "op", "id", ["a"], SkewLimits(1e-4, min_rows))
    newest = {}
    for r in log.collect():
        at = (r["k"], r["ts"])
        if at not in newest or newest[at]["id"] < r["id"]:
            newest[at] = r
    want = []
    for k in {k for k, _ in newest}:
        times = sorted(t for key, t in newest if key == k)
        for t, until in zip(times, [*times[1:], None]):
            if newest[(k, t)]["op"] != "d":
                want.append((k, newest[(k, t)]["a"], t, until))
    assert rows(got.drop("scd_id")) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert got.select("scd_id").distinct().count() == len(want)


def test_run_by_run_snapshots_equal_one_pass_history(spark):
    log = changes(spark, 120, deletes=0.0)
    want = history_from_changes(log, "k", "ts", "op", "id", ["a"])
    history = spark.createDataFrame([], EMPTY)
    for (t,) in sorted(tuple(r) for r in log.select("ts").distinct().collect())[::1]:
        state = latest_by_key(log.filter(F.col("ts") <= F.lit(t)), ["k"], ["ts", "id"])
        source = state.select("k", "a", F.col("ts").alias("updated_at"))
        history = snapshot_step(history, source, "k", "updated_at")
        # Materialise between runs, as a table would.
        history = spark.createDataFrame(history.collect(), history.schema)
    assert rows(history.select(want.columns)) == rows(want)


def test_missing_keys_are_closed_and_can_return(spark):
    now = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    schema = "k long, a int, updated_at timestamp_ntz"
    first = spark.createDataFrame([(1, 1, BASE), (2, 1, BASE)], schema)
    second = spark.createDataFrame([(1, 1, BASE)], schema)
    third = spark.createDataFrame([(1, 1, BASE), (2, 5, dt.datetime(2024, 4, 1))], schema)
    h1 = snapshot_step(spark.createDataFrame([], EMPTY), first, "k", "updated_at")
    kept = snapshot_step(h1, second, "k", "updated_at", invalidate_missing=False)
    assert open_versions(kept).count() == 2
    h2 = snapshot_step(h1, second, "k", "updated_at", True, now)
    assert [r["valid_to"] for r in h2.filter("k = 2").collect()] == [dt.datetime(2024, 3, 1)]
    h3 = snapshot_step(h2, third, "k", "updated_at", True, now)
    assert sorted((r["a"], r["valid_to"] is None) for r in h3.filter("k = 2").collect()) == [
        (1, False),
        (5, True),
    ]


@pytest.mark.parametrize("broadcast", [None, True, False])
def test_point_in_time_strategies_agree(spark, broadcast):
    log = changes(spark)
    history = history_from_changes(log, "k", "ts", "op", "id", ["a"])
    facts = log.select("k", "id", (F.col("ts") - F.expr("INTERVAL 30 MINUTE")).alias("at"))
    got = point_in_time_key(facts, history, "k", "at", "sk", broadcast, limits=SkewLimits(1e-4, 40))
    d = history.select(F.col("k").alias("dk"), F.col("scd_id").alias("sk"), "valid_from", "valid_to")
    want = facts.join(
        d, F.expr("k = dk and at >= valid_from and (valid_to is null or at < valid_to)"), "left"
    ).select("k", "id", "at", "sk")
    assert rows(got.select(want.columns)) == rows(want)


@pytest.mark.parametrize("broadcast", [None, True, False])
def test_overlapping_versions_mean_the_same_on_both_paths(spark, broadcast):
    day = [dt.datetime(2024, 1, d) for d in range(1, 10)]
    dim = spark.createDataFrame(
        [(1, "a", day[0], None), (1, "b", day[2], None), (1, "c", day[4], day[5]), (2, "d", day[0], day[1]),
         (2, "e", day[0], day[3]), (3, "f", None, None)],
        "k long, scd_id string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    facts = spark.createDataFrame(
        [(1, day[1]), (1, day[3]), (1, day[4]), (1, day[6]), (2, day[2]), (2, day[5]), (3, day[2]), (None, day[2]), (1, None)],
        "k long, valid_from timestamp_ntz",  # a fact column of this name must survive
    )
    got = point_in_time_key(facts, dim, "k", "valid_from", "sk", broadcast, limits=SkewLimits(1e-4, 2))
    assert rows(got.select("k", "valid_from", "sk")) == sorted(
        [(1, day[1], "a"), (1, day[3], "b"), (1, day[4], "c"), (1, day[6], None), (2, day[2], "e"), (2, day[5], None),
         (3, day[2], None), (None, day[2], None), (1, None, None)],
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )


def test_broadcast_needs_a_small_dimension(spark):
    few = spark.range(100).select((F.col("id") % 50).alias("k"))
    many = spark.range(BROADCAST_VERSIONS + 1).select(F.lit(1).alias("k"))
    assert small_enough(few, "k")
    assert not small_enough(many, "k")


def test_latest_variants_agree_and_upsert_replaces(spark):
    log = changes(spark)
    assert rows(latest_by_key(log, ["k"], ["ts", "id"])) == rows(latest_by_rank(log, ["k"], ["ts", "id"]))
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, load int")
    delta = spark.createDataFrame([(2, "c", 2), (3, "d", 2)], "k long, v string, load int")
    assert rows(upsert(target, delta, ["k"], ["load"])) == [(1, "a", 1), (2, "c", 2), (3, "d", 2)]


def test_newer_than_target_takes_all_when_empty(spark):
    log = changes(spark)
    assert newer_than_target(log, log.limit(0), "ts").count() == log.count()
    assert newer_than_target(log, log, "ts").count() == 0
