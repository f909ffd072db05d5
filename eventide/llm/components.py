"""Connected components of links, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import saved


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One step: every node hands its smallest neighbour to the larger (or to the smaller) ones.

    The smallest neighbour is combined before the exchange and joined back, so a
    node with very many links is no group of its own.
    """
    both = links.select("a", "b")
    if large:
        both = both.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lows = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    told = both.join(lows.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
    if large:
        out = told.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = told.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            lows.select("a", F.col("low").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(``node``, ``component``) of all nodes of the links (``a``, ``b``); the smallest node names its component.

    Each round is written to the shared folder, so that plans stay short and a
    lost executor costs one round. Nodes without a link to another are left out.
    """
    links = saved(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    for k in range(rounds):
        links = saved(_stars(_stars(links, True), False), f"round{k}")
        # Converged when all links are stars around their smallest node: sizes and sums stay.
        state = links.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if before == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
