"""Working on new rows only: a stream that ends when all that is there has been read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def new_rows(spark: SparkSession, path: str, schema: str, checkpoint: str, work: Callable[[DataFrame, int], None]) -> int:
    """Give every Parquet file below path that no earlier call has seen to work(batch, number); the number of batches done."""
    stream = spark.readStream.schema(schema).parquet(path)
    query = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p["numInputRows"])
