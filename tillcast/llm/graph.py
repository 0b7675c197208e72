"""Connected components as Spark joins, by contracting the graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import durable


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(v, label)``: the smallest vertex id that ``v`` reaches.

    Vertices are ordered by a hash of their id.  Each round maps every vertex to the first of
    itself and its neighbours and rewrites the links by that map; loops go.  The image of a
    connected graph stays connected, and since the order is random, descending paths are short:
    a star takes two rounds, a chain about log n.  Neighbour minima combine map-side; a hub's
    links meet its one map row in a join that AQE may split.  Each round is cut by a
    checkpoint.  Vertices without a link are not returned."""
    def ordered(c):
        return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id")).alias(c)

    edges = durable(links.where(F.col("a") != F.col("b")).select(ordered("a"), ordered("b"))
                    .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = durable(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
                     .select("v", F.least("v", "m").alias("m")))
        steps.append(to)
        x = to.select(F.col("v").alias("a"), F.col("m").alias("a2"))
        y = to.select(F.col("v").alias("b"), F.col("m").alias("b2"))
        edges = durable(edges.join(x, "a").join(y, "b").where("a2 <> b2")
                        .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct())
    if not steps:
        return edges.select(F.col("a.id").alias("v"), F.col("b.id").alias("label"))
    roots = steps[0].select("v", F.col("m").alias("root"))
    for to in steps[1:]:
        roots = (roots.join(to.select(F.col("v").alias("root"), "m"), "root", "left")
                 .select("v", F.coalesce("m", "root").alias("root")))
    roots = durable(roots.select("v.id", "root"))
    least = roots.groupBy("root").agg(F.min("id").alias("label"))
    return durable(roots.join(least, "root").select(F.col("id").alias("v"), "label"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
