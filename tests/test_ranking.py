import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from orderlens.operators.ranking import (
    border_rows,
    global_rank,
    key_chunks,
    time_series_folds,
    with_test_fold,
)


def dated(spark, n=400, one_day=False):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    data = [
        (i, base + dt.timedelta(minutes=0 if one_day else rnd.randrange(20) * 720))
        for i in range(n)
    ]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "id long, ts timestamp_ntz").repartition(5)


def test_global_rank_equals_row_number(spark):
    df = dated(spark)
    want = df.withColumn("position", F.row_number().over(Window.orderBy("ts", "id")) - 1)
    assert rows(global_rank(df, ["ts", "id"])) == rows(want)


@pytest.mark.parametrize("one_day", [False, True])
def test_border_rows(spark, one_day):
    df = dated(spark, one_day=one_day)
    ordered = [(r["ts"], r["id"]) for r in df.orderBy("ts", "id").collect()]
    wanted = [0, 7, 199, 399]
    assert border_rows(df, "ts", "id", wanted) == [(p, *ordered[p]) for p in wanted]


@pytest.mark.parametrize("n,folds", [(400, 3), (401, 5), (17, 4)])
def test_folds_follow_the_positional_rule(spark, n, folds):
    df = dated(spark, n)
    total, borders = time_series_folds(df, "ts", "id", folds)
    assert total == n
    test = n // (folds + 1)
    order = [r["id"] for r in df.orderBy("ts", "id").collect()]
    want = {}
    for pos, key in enumerate(order):
        first = n - folds * test
        want[key] = 0 if pos < first else (pos - first) // test + 1
    got = {r["id"]: r["fold"] for r in with_test_fold(df, "ts", "id", borders).collect()}
    assert got == want


def test_too_few_rows_for_folds(spark):
    with pytest.raises(ValueError):
        time_series_folds(dated(spark, 3), "ts", "id", 5)


@pytest.mark.parametrize("n,share", [(23, 0.1), (5, 0.1), (100, 0.34)])
def test_key_chunks(spark, n, share):
    df = spark.range(n * 3).select((F.col("id") % n * 7).alias("u"))
    size = max(1, int(n * share))
    want = {i * 7: i // size + 1 for i in range(n)}
    assert {r["u"]: r["chunk"] for r in key_chunks(df, "u", share).collect()} == want
