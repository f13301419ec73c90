"""Exports: marts as Parquet, predictions as CSV, relational append, user chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.functions.scalars import valid_identifier
from orderlens.sinks.lake import by_partition


def export_mart(spark: SparkSession, schema: str, mart: str, path: str) -> None:
    """A whole mart as Parquet. Bad names raise ``ValueError``, unknown marts ``LookupError``."""
    for name in (schema, mart):
        if not valid_identifier(name):
            raise ValueError(f"not a valid name: {name!r}")
    if not spark.catalog.tableExists(f"{schema}.{mart}"):
        raise LookupError(f"no mart {schema}.{mart}")
    spark.table(f"{schema}.{mart}").write.mode("overwrite").parquet(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """``order_id, tip`` with a header, one file per partition."""
    df.select("order_id", "tip").write.mode("overwrite").option("header", True).csv(path)


# Rows per insert.
INSERT_ROWS = {"orders": 10_000, "products": 10_000, "order_products": 50_000}


def append_relational(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column_types: str | None = None,
    batch_rows: int | None = None,
    writers: int = 8,
) -> None:
    """Append to a relational table over JDBC with a bounded number of connections."""
    writer = (
        df.repartition(writers)  # not coalesce: that would compute the whole stage in so few tasks
        .write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_rows or INSERT_ROWS.get(table.split(".")[-1], 10_000))
        .options(**(properties or {}))
    )
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.save()


def write_user_chunks(chunked: DataFrame, path: str) -> None:
    """One folder per user chunk; a large chunk is split over several tasks and files."""
    (
        by_partition(chunked, ["user_chunk"])
        .write.mode("overwrite")
        .partitionBy("user_chunk")
        .parquet(path)
    )


def read_user_chunks(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All chunks as one frame with only the wanted columns."""
    return spark.read.parquet(path).select(*columns)
