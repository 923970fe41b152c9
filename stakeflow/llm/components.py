"""Connected components of an undirected graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeflow.llm.common import removed, with_side, written

#: Edges of a file.
EDGES = 250_000


def components(edges: DataFrame) -> DataFrame:
    """id and component (its smallest id) of every node of ``edges`` (a, b: long); loops and repeats are allowed.

    Alternating large and small stars: each round links every node's larger neighbours, then its smaller ones, to its
    smallest neighbour, until nothing changes. Minima are aggregated and joined, so no node's neighbours are gathered.
    """
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        before, last = now, e
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = with_side(both, least, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # few edges are few files
        e = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(1 + now[0] // EDGES))
        removed(last)
