"""An extension: windowed counts over an event stream, with a watermark for late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(event_type, start, n, total) by tumbling window; the same on a batch and on a stream."""
    source = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events  # watermarks need a time zone
    return source.groupBy("event_type", F.window("ts", width).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select("event_type", F.col("w.start").alias("start"), "n", "total")
