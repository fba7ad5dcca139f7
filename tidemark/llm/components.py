"""Connected components of an edge table, as Spark jobs only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) of every node of ``edges`` (``a``, ``b``).

    Large-star and small-star rounds (each hangs a node's neighbours on the
    least of them) until nothing changes.  A node's many edges meet it through
    a partially aggregated minimum and a join that the engine may split; each
    round is written to the shared folder, and only two sums of it come to the
    driver.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = base.stored(now, "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        down = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = base.stored(down.union(least).distinct(), "edges")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))
