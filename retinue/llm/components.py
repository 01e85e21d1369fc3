"""Connected components of a graph that may have very large hubs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.operators.staging import settle


#: Edges that one task of a round handles.
TASK_EDGES = 200_000


def _shape(stars: DataFrame) -> tuple[int, int]:
    """How many edges there are, and how many keep them from being separate stars.

    Disjoint stars have one edge for each ``a``, and no ``b`` is an ``a`` as well.
    """
    sources = stars.groupBy("a").agg(F.count("*").alias("edges"))
    inner = stars.select(F.col("b").alias("a")).distinct().join(sources, "a", "left_semi")
    edges, several = sources.agg(F.sum("edges"), F.sum((F.col("edges") > 1).cast("int"))).first()
    return edges or 0, (several or 0) + inner.count()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of ``edges`` (``a``, ``b``).

    Large-star and small-star rounds: each links the neighbours of a node to the smallest
    of them, until the edges are stars around the smallest nodes. Minima combine on the map
    side and no node's neighbours are ever gathered; the joins go back to written tables,
    so that adaptive execution can split a hub. A chain of n edges needs about log n rounds.
    Written tables have a file for each ``TASK_EDGES`` edges: rounds on few edges are short.
    """
    greater = F.greatest("a", "b").alias("a")
    smaller = F.least("a", "b").alias("b")
    stars = settle(edges.where("a <> b").select(greater, smaller).distinct())
    count, loose = _shape(stars)
    while loose:
        few = lambda df, n=count: settle(df.coalesce(1 + 2 * n // TASK_EDGES))
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = few(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")))
        large = few(
            both.join(lowest, "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .distinct()
        )
        lowest = few(large.groupBy("a").agg(F.min("b").alias("low")))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        stars = few(small.unionByName(lowest.withColumnRenamed("low", "b")).distinct())
        count, loose = _shape(stars)
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    members = stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
    return settle(members.coalesce(1 + 2 * count // TASK_EDGES))
