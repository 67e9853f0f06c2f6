"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import staged


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of a link (a, b).

    Rounds grow with the logarithm of a chain's length.  Minima are aggregated
    before the shuffle, and a hub's links are joined with skew splits, so a node
    with very many links is spread.  Each round is staged; only two numbers per
    round reach the driver.
    """
    e = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = staged(e, "star")
    before = None
    while True:
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (r["n"], r["h"]) == before:
            break
        before = (r["n"], r["h"])
        if not r["n"]:
            break
        e = staged(_small_star(_large_star(e).distinct()).distinct(), "star")
    roots = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
