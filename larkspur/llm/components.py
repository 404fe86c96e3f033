"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import with_values
from .tables import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("size"))
    least = materialize(least, "least")
    return with_values(both, least, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size"))
    least = materialize(least, "least")
    moved = with_values(edges, least, ["u"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id of `links` (columns a, b).

    Null ends and self links are left out.  Each round is two joins on small integer rows, in which the
    many rows of a root are not gathered, and is written to the shared folder; rounds grow with the
    logarithm of the longest chain and end when a round changes no edge.
    """
    ends = (F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialize(links.where("a <> b").select(*ends).distinct(), "links")
    n = edges.count()
    while True:
        # keep rows (u, v) with u > v: large-star over both directions, then small-star
        large = materialize(_large_star(edges).where("u > v").distinct(), "large")
        star = _small_star(large).where("u > v").distinct()
        after = materialize(star, "star")
        m = after.count()
        # both are sets: of one size and with no new edge, they are equal
        if m == n and after.join(edges, ["u", "v"], "left_anti").isEmpty():
            break
        edges, n = after, m
    parts = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return parts.union(roots)
