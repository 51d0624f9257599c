"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesselflow.llm import _common as C


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in `links` (a, b: long); component is the least id that links reach.

    Each round replaces the links of a node by links to the least of its neighbours, until nothing changes; the number
    of rounds grows with the logarithm of the longest chain. Minima are aggregated before rows are dealt out, and the
    join back is one that Spark splits where a node has very many links. No links give no rows.
    """
    edges = C.stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = C.stage(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == before:
            break
        before = now
    # A fixed point is a set of stars: every node has one link, to the least id of its component.
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
