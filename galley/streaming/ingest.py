"""Structured Streaming around the batch plans (an extension; the batch plans do not need it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import SCAN_DDL


def landing(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Scan documents as they land in a folder."""
    df = spark.readStream.schema(SCAN_DDL).option("multiLine", "true").option("maxFilesPerTrigger", files_per_trigger).json(path)
    return df.withColumnRenamed("full articles", "full_articles").withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1)).withColumn("seen", F.current_timestamp())


def once_per_scan(stream: DataFrame, key: str = "file", late: str = "1 day") -> DataFrame:
    """Repeats of a scan within the watermark are dropped."""
    return stream.withWatermark("seen", late).dropDuplicatesWithinWatermark([key])


def run_batches(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Apply a batch plan to every micro-batch; the checkpoint makes it resumable."""
    w = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def event_counts(events: DataFrame, size: str = "1 hour", ts: str = "ts", late: str | None = None) -> DataFrame:
    """(start, event_type, n) per window; with ``late`` on a stream, late rows are dropped after it."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp"))
    e = e.withWatermark(ts, late) if late else e
    return e.groupBy(F.window(ts, size).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
