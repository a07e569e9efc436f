"""Connected components of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import materialize


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (columns ``a``, ``b``);
    ``component`` is the smallest node that can be reached.

    Large-star and small-star steps take turns until the links no longer change.
    Each round is written to the shared folder, which cuts the lineage and
    survives lost executors. Every step replaces the links of a node by links to
    its smallest neighbour, so their number never grows; minima are combined
    before the shuffle, and a node with very many links is only a skewed join
    key, which adaptive execution splits. Null ends and self links are left out;
    no links give no rows.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        after = materialize(small, "links")
        changed = after.exceptAll(edges).limit(1).count() + edges.exceptAll(after).limit(1).count()
        edges = after
        if not changed:
            break
    else:
        raise RuntimeError(f"links still change after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
