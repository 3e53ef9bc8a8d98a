"""Incremental ingestion with Structured Streaming, an extension: each run takes the files that are new since the last
one, stops when there are none left, and resumes from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ingest_new_files(spark: SparkSession, source: str, schema: T.StructType | str, target: str, checkpoint: str, key: str = "document_id") -> int:
    """New JSON line files below ``source`` as Parquet below ``target``, a folder a batch: a batch that is run again
    after a failure replaces its own folder, so rows neither repeat nor get lost. Returns the batches run."""
    batches = 0

    def write(batch: DataFrame, number: int) -> None:
        nonlocal batches
        batches += 1
        batch.dropDuplicates([key]).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).json(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    return batches


def windowed_counts(events: DataFrame, lateness: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events (ts, event_type) by type and tumbling window; with a watermark, so that state is bounded on a stream."""
    return events.withWatermark("ts", lateness).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), "event_type", "n")
