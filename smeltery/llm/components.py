"""Connected components of a graph given as links, by alternating large and small stars.

Each round moves every node's larger neighbours, then its smaller ones, to the smallest node around it. Rounds are
grouped joins that Spark splits where one node holds many links; nothing is gathered on the driver but a count
and a checksum. Each round ends in a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link nodes to the smallest node around ``u``: its larger neighbours, or itself and its smaller ones."""
    back = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    if large:
        around = links.select(F.explode(F.array(F.struct("u", "v"), back)).alias("l")).select("l.*")
        moved = F.col("v") > F.col("u")
    else:
        around = links  # u > v holds for every link
        moved = F.col("v") != F.col("m")
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = around.join(least, "u")
    out = joined.where(moved).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and its ``component``, the smallest node it reaches, for every node of ``links`` (a, b) but the smallest."""
    ordered = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    now = written(ordered.distinct(), "links")
    state = _state(now)
    while True:
        now = written(_star(_star(now, large=True), large=False), "links")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
