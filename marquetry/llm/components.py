"""Connected components of a link table by alternating star contractions, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """links (u, v) -> (u, v): each node but the least of its component, with that least node.

    Every step's links are written to the shared folder; the driver sees only counts.
    """
    now = stored(links.filter("u <> v").distinct())
    state = None
    while True:
        following = stored(_small_star(_large_star(now)).filter("u <> v").distinct())
        told = following.agg(F.count("*").alias("n"), F.expr("coalesce(bit_xor(xxhash64(u, v)), 0)").alias("x"), F.countDistinct("u").alias("nodes"), F.count(F.expr("case when v = u then 1 end"))).first()
        roots = following.select(F.col("v").alias("r")).distinct().join(following, F.col("r") == F.col("u"), "left_semi").limit(1).count() if told["n"] == told["nodes"] else 1
        if not roots or (told["n"], told["x"]) == state:
            return following
        state, now = (told["n"], told["x"]), following
