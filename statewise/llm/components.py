"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.workspace import settle


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One half step: neighbours are tied to the smallest of them."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where(F.col("b") < F.col("a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.withColumn("least", F.least("a", "least"))
    tied = both.join(least, "a")
    if large:
        tied = tied.where(F.col("b") > F.col("a"))
        found = tied.select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        found = tied.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return found.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``a, least`` for every end of a link: the smallest id of its component.

    Large-star and small-star steps alternate until nothing changes, which is
    after about the logarithm of the longest chain. Each step is a table in the
    shared folder; only a count and a checksum reach the driver. Links from an
    id to itself and NULL ends are ignored.
    """
    links = links.select("a", "b").where(F.col("a") != F.col("b")).distinct()
    before = None
    while True:
        links = settle(_star(_star(links, large=True), large=False), "links")
        check = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        now = tuple(links.agg(F.count("*"), check).first())
        if now == before:
            break
        before = now
    least = links.groupBy("b").agg(F.lit(1).alias("_"))
    return links.select("a", F.col("b").alias("least")).unionByName(
        least.select(F.col("b").alias("a"), F.col("b").alias("least"))
    )
