"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialize


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the component's least node.

    Alternating large-star and small-star steps: each node hands its larger neighbours, then its
    smaller ones, to the least neighbour it knows, until every edge points at a root. All state is
    edges in stored tables (never more than the input has), so a lost executor costs one step; the
    driver sees one (count, checksum) per step."""
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "components")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")),
                                                               F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("e"))
                 .select(F.col("e.x").alias("u"), F.col("e.y").alias("v")).filter("u <> v").distinct())
        now = materialize(small, "components")
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
    return row[0], row[1]
