"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import staged


def _stored(edges: DataFrame, rows: int | None) -> DataFrame:
    """A staged edge table; ``rows``: a bound of its rows, so that a small one is a few files."""
    if rows is not None:
        edges = edges.coalesce(max(8, rows // 250_000))
    return staged(edges, "edges")


def _is_forest(edges: DataFrame, rows: int) -> bool:
    """Whether every node has one edge, to a root."""
    if rows != edges.select("hi").distinct().count():
        return False
    return edges.join(edges.select(F.col("hi").alias("lo")), "lo", "left_semi").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b`` longs): the smallest node that
    it can reach. Every round is a staged table of at most as many edges as there were; the number of
    rounds grows with the logarithm of the longest path."""
    now = _stored(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), None)
    rows = now.count()
    while rows and not _is_forest(now, rows):
        both = now.selectExpr("hi AS u", "lo AS v").unionByName(now.selectExpr("lo AS u", "hi AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        now = _stored(small.unionByName(root.select("hi", F.col("m").alias("lo"))).distinct(), rows)
        rows = now.count()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
