"""Connected components of links, as DataFrame operations that keep no group in one place.

Alternates two rewritings of the links until nothing changes: every node hands its larger neighbours
its smallest one, then its smaller neighbours likewise. Both need the smallest neighbour of a node
only, an aggregate, and the links themselves, so a node with very many links is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

MOST_ROUNDS = 60


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """Of links (u, v) of longs: node, component (its smallest node), for every node of a link."""
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = materialize(links, "links")
    before = _state(links)
    for _ in range(MOST_ROUNDS):
        both = links.union(links.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(low, "u")
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", "m").toDF("u", "v")).where("u <> v").distinct()
        old, links = links, materialize(small, "links")
        discard(old)
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components have not settled")
    # Now every link goes from a node to the smallest node of its component.
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select("v", "v").distinct()).toDF("node", "component").distinct()
