"""Connected components of an edge table by alternating large-star and small-star steps.

Each step replaces edges by edges to smaller neighbours; it ends with every node linked to the smallest node of
its component, after a number of steps that grows with the logarithm of the component's size. Minima are taken
by aggregates, so a node with very many neighbours is combined on the map side. Every step is written to the
shared folder; the driver sees one sum per step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.store import written


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """edges (a, b) of any ordered type; result: node, root for every node that has an edge, root included."""
    edges = written(edges.where("a <> b").select("a", "b").distinct(), label)
    before = None
    while True:
        state = tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint"))).first())
        if state == before or not state[0]:
            break
        before = state
        edges = written(_small(_large(edges).where("a <> b").distinct()).where("a <> b").distinct(), label)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots).distinct()
    return written(found, label)
