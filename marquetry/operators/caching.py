"""Looking work up in checkpoint tables before doing it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def look_up(samples: DataFrame, candidates: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """samples (sample_id), candidates (sample_id, cache_key, priority), checkpoints (sample_id, cache_key, payload).

    Left join with ordered keys: the hit of lowest priority wins. Adds cache_key, payload, and
    `migrate` where an older key hit, so that the result must be written again under the first.
    """
    hits = candidates.join(checkpoints, ["sample_id", "cache_key"])
    best = hits.groupBy("sample_id").agg(F.min(F.struct("priority", "cache_key", "payload")).alias("hit"))
    first = candidates.groupBy("sample_id").agg(F.min("priority").alias("first"))
    joined = samples.join(best, "sample_id", "left").join(first, "sample_id", "left")
    return joined.select(*samples.columns, F.col("hit.cache_key").alias("cache_key"), F.col("hit.payload").alias("payload"), F.coalesce(F.col("hit.priority") > F.col("first"), F.lit(False)).alias("migrate"))


def reference_state(samples: DataFrame, products: DataFrame, failures: DataFrame, force: bool = False) -> DataFrame:
    """samples (sample_id, cache_key) with `state`: hit, failed (a failure recorded under the same key) or miss."""
    if force:
        return samples.withColumn("state", F.lit("miss"))
    keys = ["sample_id", "cache_key"]
    good = products.select(*keys).distinct().withColumn("_good", F.lit(True))
    bad = failures.select(*keys).distinct().withColumn("_bad", F.lit(True))
    joined = samples.join(good, keys, "left").join(bad, keys, "left")
    return joined.select(*samples.columns, F.when(F.col("_good"), "hit").when(F.col("_bad"), "failed").otherwise("miss").alias("state"))


def work_set(samples: DataFrame, done: DataFrame) -> DataFrame:
    """Samples not in `done` under their key."""
    return samples.join(done, ["sample_id", "cache_key"], "left_anti")
