"""The same operators over streams, and event-time windows (extensions; the batch operators have the semantics)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import stem


def text_stream(spark: SparkSession, folder: str, *, files_per_batch: int = 1000) -> DataFrame:
    """doc_id, text of text files as they arrive."""
    rows = spark.readStream.option("pathGlobFilter", "*.txt").option("maxFilesPerTrigger", files_per_batch).option("wholetext", True).text(folder)
    return rows.select(stem(F.col("_metadata.file_name")).alias("doc_id"), F.col("value").alias("text"))


def run_per_batch(stream: DataFrame, operator: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Applies a per-document operator to each micro-batch; a batch that runs again replaces its own output."""

    def write(batch: DataFrame, number: int) -> None:
        operator(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, *, width: str = "1 hour", slide: str | None = None, late: str | None = None) -> DataFrame:
    """event_type, window_start, n, total per tumbling or sliding window; ``late``: the watermark of a stream."""
    rows = events.withWatermark("ts", late) if late else events
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    out = rows.groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select("event_type", F.col("window.start").alias("window_start"), "n", "total")


def sessions(events: DataFrame, *, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """user_id, session_start, n per session window."""
    rows = events.withWatermark("ts", late) if late else events
    out = rows.groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("session_start"), "n")
