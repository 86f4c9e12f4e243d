"""Making the package importable where tasks run, and bounding what they hold."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])
#: Bytes of an Arrow batch, so that workers' memory does not depend on how long rows are.
BATCH_BYTES = 2 << 20


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it; a cluster that ships it needs nothing."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])
    return spark
