"""Reading the given tables, and standing their rows in for episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as episodes: source, index, length and domain."""
    return table(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), F.col("doc_id").alias("episode_index"), F.col("n_chars").alias("length"), F.col("lang").alias("domain"))
