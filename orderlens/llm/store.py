"""Tables and binary files in the folder that driver and executors share.

Scratch tables cut lineage (they are re-read, not recomputed, when an executor is lost). Binary files are
written by tasks under names that no other attempt uses; a Parquet manifest, committed by Spark, lists the
files of the attempts that counted, so what a lost or repeated attempt left behind is never read.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from orderlens.session import release, scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_FOLDERS: ContextVar[tuple[list[str], ...]] = ContextVar("_FOLDERS", default=())


def prepare(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package when the session started elsewhere."""
    env, have = spark.sparkContext.environment, os.environ.get("PYTHONPATH", "")
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", have)) if x)


def fresh(spark: SparkSession, label: str) -> str:
    """A new folder of the shared store as a full address."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, label))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return found.makeQualified(path).toString()


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end; those with ``keep`` then belong to the block around it, if any.

    What is still read afterwards must be such a table.
    """
    folders: list[str] = []
    before = _FOLDERS.set((*_FOLDERS.get(), folders))
    try:
        yield
    finally:
        _FOLDERS.reset(before)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str, keep: bool = False, codec: str | None = None) -> DataFrame:
    """The same rows, written once and re-read; ``keep``: the table outlives the innermost ``temporary``."""
    spark, schema = df.sparkSession, df.schema
    path = fresh(spark, label)
    if blocks := _FOLDERS.get()[: -1 if keep else None]:
        blocks[-1].append(path)
    df.write.parquet(path, compression=codec)
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores where a column of the frame has it already."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def added(df: DataFrame, name: str) -> str:
    """The name of a column to add; an error where the frame has it already."""
    if unused(df, name) != name:
        raise ValueError(f"the input has a column {name}: name another one for the result")
    return name


def _open(address: str):
    return pafs.FileSystem.from_uri(address)


def put(folder: str, name: str, data: bytes) -> str:
    """Write one file under a name of its own; its address."""
    address = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    system, path = _open(address)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(data)
    return address


def get(address: str) -> bytes:
    system, path = _open(address)
    with system.open_input_stream(path, compression=None) as src:
        return src.read()


def mapped(address: str, kind: str) -> np.ndarray:
    """The file as an array: mapped where the store is a local or mounted folder, else read."""
    system, path = _open(address)
    if isinstance(system, pafs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.empty(0, kind)
    return np.frombuffer(get(address), dtype=kind)
