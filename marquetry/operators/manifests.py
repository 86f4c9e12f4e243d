"""Joining the branches' successes, merging manifests and comparing them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def success_join(prompts: DataFrame, references: DataFrame) -> DataFrame:
    """Samples for which both branches succeeded."""
    return prompts.join(references, "sample_id")


def merge(old: DataFrame, chosen: DataFrame, new: DataFrame, key: str = "episode_index") -> DataFrame:
    """Rows of chosen keys are replaced by new ones, or taken out where there is none; other rows stay."""
    return old.join(chosen.select(key).distinct(), key, "left_anti").unionByName(new.join(chosen.select(key).distinct(), key, "left_semi"))


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that stand on one side only, with that side."""
    a = left.select(key).distinct().withColumn("_l", F.lit(1))
    b = right.select(key).distinct().withColumn("_r", F.lit(1))
    met = a.join(b, key, "full_outer").filter("_l is null or _r is null")
    return met.select(key, F.when(F.col("_r").isNull(), "left").otherwise("right").alias("side"))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that stand on several rows, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def first_of(df: DataFrame, keys: list[str], order: str, last: bool = False) -> DataFrame:
    """The first (or last) row of each key in order; ties are broken by the whole row. One aggregate, no sort."""
    whole = F.struct(order, *(c for c in df.columns if c != order))
    pick = (F.max if last else F.min)(whole).alias("_row")
    return df.groupBy(*keys).agg(pick).select(*(F.col(f"_row.{c}").alias(c) for c in df.columns))
