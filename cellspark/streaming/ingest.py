"""Incremental ingestion: files that arrive are tagged, filtered or counted as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def ingest(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], partition_by: str = "prefix", files_per_trigger: int = 1000):
    """Run transform over all Parquet files below source that earlier calls have not seen, and append to sink.

    The checkpoint keeps what has been read and written, so a call that was cut off is carried on without doubles.
    Returns the finished streaming query.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    query = transform(stream).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).partitionBy(partition_by).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
