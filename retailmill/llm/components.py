"""Connected components of a graph of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmill.llm.common import Scratch


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b) links between longs -> (v, label): the smallest vertex that each linked
    vertex reaches, one row per vertex.

    Alternates two steps until the links stop changing: every vertex ties its larger
    neighbours to its smallest one, then its smaller ones likewise. Stars are what is
    left; each round works on links alone, and about halves their paths. A neighbourhood
    is only ever reduced by ``min``, so a hub of any size is split over tasks.
    """
    scratch = Scratch(links.sparkSession)
    now = scratch.written(
        links.where("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links"
    )
    old = _sum(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.where("v != u").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").where("u != m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        after = scratch.written(small.unionByName(low.select("v", F.col("m").alias("u"))).distinct(), "links")
        now, new = after, _sum(after)
        scratch.discard(keep=1)
        if old == new:
            break
        old = new
    else:
        raise RuntimeError(f"links still changed after {most_rounds} rounds")
    ends = now.select("v", F.col("u").alias("label"))
    return ends.unionByName(now.select(F.col("u").alias("v"), F.col("u").alias("label")).distinct())


def _sum(links: DataFrame) -> tuple:
    """Tells tables of links apart whatever their order."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def joined_up(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (v, label) after further (a, b) links: only the labels that these tie are worked on."""
    def label_of(side: str) -> DataFrame:
        return labels.select(F.col("v").alias(side), F.col("label").alias(f"label_{side}"))

    met = links.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left")
    met = met.select("a", "b", F.coalesce("label_a", "a").alias("x"), F.coalesce("label_b", "b").alias("y"))
    ends = met.select(F.col("a").alias("v"), F.col("x").alias("label")).unionByName(
        met.select(F.col("b").alias("v"), F.col("y").alias("label"))
    )
    tied = components(met.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(
        F.col("v").alias("label"), F.col("label").alias("least")
    )
    known = labels.unionByName(ends).distinct().join(tied, "label", "left")
    return known.select("v", F.coalesce("least", "label").alias("label"))
