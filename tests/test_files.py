import os
import tempfile
from unittest import mock

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderlens.functions.scalars import latest_of, text_to_bool, valid_identifier
from orderlens.operators.latest import without_deleted
from orderlens.plans.dims import product_snapshot_input
from orderlens.plans.staging import stg_order_products, stg_orders, stg_products
from orderlens.schemas import BUSINESS_KEYS, ENTITIES, entity_schema, lake_schema, staging_schema
from orderlens.session import scratch_path, shared_dir
from orderlens.sinks.exports import append_relational
from orderlens.sources import files
from orderlens.sources.changes import bootstrap


@pytest.fixture
def work():
    return tempfile.mkdtemp(prefix="run-")


def test_schemas():
    for name in ENTITIES:
        assert lake_schema(name).fieldNames()[-2:] == ["_op", "_ts_ms"]
        assert staging_schema(name).fieldNames()[-1] == "load_ts"
        assert set(BUSINESS_KEYS[name]) <= set(entity_schema(name).fieldNames())
    with pytest.raises(KeyError):
        entity_schema("unknown")


def test_unknown_table_is_refused(spark, work):
    with pytest.raises(KeyError):
        files.read_lake_table(spark, work, "unknown")


def test_headers(spark, work):
    with open(f"{work}/a.csv", "w") as f:
        f.write(",Order ID, Tip \n0,7,True\n1,8,\n")
    df = files.clean_header(spark.read.csv(f"{work}/a.csv", header=True))
    assert df.columns == ["order_id", "tip"]
    assert files.normalised_name(" 1st Col-Name ") == "_1st_col_name"
    with open(f"{work}/tips.csv", "w") as f:
        f.write(",order_id,tip\n0,7,True\n1,8,False\n2,9,\n")
    assert rows(files.read_tips(spark, f"{work}/tips.csv")) == [(7, 1), (8, 0), (9, None)]


def test_seed_quotes(spark, work):
    with open(f"{work}/aisles.csv", "w") as f:
        f.write('aisle_id,aisle,_op,_ts_ms,load_ts\n1,"soap, ""fine""",c,0,1970-01-01 00:00:00\n')
    seed = files.read_seed(spark, f"{work}/aisles.csv", "aisles")
    assert seed.select("aisle_id", "aisle", "_op", F.unix_millis("_ts_ms")).first()[:] == (1, 'soap, "fine"', "c", 0)
    assert seed.schema.fieldNames() == staging_schema("aisles").fieldNames()


def test_projection_reaches_the_scan(spark, sf_dir, capsys):
    files.read_columns(spark, f"{sf_dir}/orders.parquet", ["o_orderkey"]).filter("o_orderkey > 5").explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "GreaterThan(o_orderkey,5)" in plan


def test_scalars(spark):
    df = spark.createDataFrame([("True",), ("False",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(text_to_bool("t")).collect()] == [True, False, None, None]
    times = spark.sql("select cast(null as timestamp) a, timestamp'2024-01-02' b, timestamp'2024-01-01' c")
    assert str(times.select(latest_of("a", "b", "c")).first()[0]).startswith("2024-01-02")
    assert str(times.select(latest_of("a")).first()[0]).startswith("1970-01-01")
    assert valid_identifier("f_orders") and not valid_identifier("f; drop") and not valid_identifier("")
    ops = spark.createDataFrame([(1, "c"), (2, "d"), (3, None)], "k int, op_type string")
    assert rows(without_deleted(ops)) == [(1, "c")]


def stage(spark, table, data):
    return files.staged(spark.createDataFrame(data, lake_schema(table)))


def test_staging_keeps_the_newest_change(spark):
    raw = stage(spark, "orders", [(1, 1, 0, None, "c", 1), (1, 1, 0, True, "u", 3), (1, 1, 0, False, "u", 2)])
    assert [r["tip_given"] for r in stg_orders(raw).collect()] == [True]
    raw = stage(spark, "order_products", [(1, 2, 1, "c", 1), (1, 2, 1, "c", 1), (1, 3, 2, "c", 1)])
    assert stg_order_products(raw).count() == 2


def test_product_snapshot_takes_each_part_by_its_own_time(spark):
    products = stage(spark, "products", [(1, "old", 1, 1, "c", 0), (1, "new", 1, 1, "u", 50), (2, "gone", 1, 1, "d", 9), (3, "loose", None, 8, "c", 4)])
    aisles = stage(spark, "aisles", [(1, "a0", "c", 0), (1, "a1", "u", 90)])
    departments = stage(spark, "departments", [(1, "d0", "c", 0)])
    staged = stg_products(products, aisles, departments)
    got = product_snapshot_input(staged).withColumn("effective_last_updated_ts", F.unix_millis("effective_last_updated_ts"))
    assert rows(got) == [
        (1, "new", 1, "a1", 1, "d0", 90),
        (3, "loose", None, None, None, None, 4),
    ]
    assert product_snapshot_input(staged, drop_deleted=False).count() == 3


def test_bootstrap_is_valid_from_the_epoch(spark):
    row = bootstrap(spark.createDataFrame([(1,)], entity_schema("users"))).select("_op", F.unix_millis("_ts_ms"), F.unix_millis("load_ts")).first()
    assert tuple(row) == ("c", 0, 0)


def test_scratch_paths_are_fresh_and_shared(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))


def test_relational_append_options():
    """The writer's options; no database is reached in tests."""
    df = mock.MagicMock()
    writer = df.repartition.return_value.write.format.return_value.mode.return_value
    writer.option.return_value = writer.options.return_value = writer
    append_relational(df, "jdbc:x", "public.order_products", {"user": "u"}, "order_id BIGINT")
    options = dict(c.args for c in writer.option.call_args_list)
    assert options == {
        "url": "jdbc:x",
        "dbtable": "public.order_products",
        "batchsize": 50_000,
        "createTableColumnTypes": "order_id BIGINT",
    }
    writer.save.assert_called_once()
    df.repartition.assert_called_once_with(8)


def test_jsonl_change_files(spark, work):
    os.makedirs(f"{work}/lake/users")
    with open(f"{work}/lake/users/a.jsonl", "w") as f:
        f.write('{"user_id": 3, "_op": "c", "_ts_ms": 9}\n')
    files.stream_change_files(spark, f"{work}/lake", "users").writeStream.format("parquet").option("path", f"{work}/out").option(
        "checkpointLocation", f"{work}/state"
    ).trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(f"{work}/out")) == [(3, "c", 9)]
