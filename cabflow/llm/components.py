"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import release, stage


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))), F.lit(0))
    ).first()
    return row[0], row[1]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour of a node to the least one: larger neighbours (large star), or
    smaller ones and the node itself (small star).  A busy node is reduced to its minimum by
    an aggregate, so its links never meet in one task."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    near = both.join(least, "a")
    if large:
        out = near.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        near = near.where(F.col("b") < F.col("a"))
        up = near.select(F.col("b").alias("a"), F.col("least").alias("b"))
        out = up.unionByName(near.select("a", F.col("least").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component_id`` (least id reachable) of every id with a link to another.

    ``links`` has the columns ``a`` and ``b``; direction, repeats and loops do not matter.  Each
    round is written to the shared folder.  Ends after a number of rounds that grows with the
    logarithm of the longest path.
    """
    spark = links.sparkSession
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(spark, edges.distinct(), "links")
    before = None
    now = _fingerprint(edges)
    while now != before and now[0]:
        before = now
        edges = stage(spark, _star(_star(edges, large=True), large=False), "links")
        now = _fingerprint(edges)
        # The tables that this round sent to the tasks.
        release(spark)
    centres = edges.select(F.col("b").alias("id")).distinct().withColumn("component_id", F.col("id"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(centres)
