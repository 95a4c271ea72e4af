"""Streaming counterparts: incremental stages, resumable de-duplication, growing caches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream; files seen by the checkpoint are skipped."""
    r = spark.readStream.schema(schema).format("parquet")
    return (r.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else r).load(path)


def first_seen(rows: DataFrame, keys: Sequence[str], event_time: str | None = None, late: str = "1 day") -> DataFrame:
    """Each key once.  With an event time the state is bounded by the watermark."""
    if event_time is None:
        return rows.dropDuplicates(list(keys))
    return rows.withWatermark(event_time, late).dropDuplicatesWithinWatermark(list(keys))


def run_available(rows: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what is there now, then stop; a rerun goes on where this one ended."""
    q = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def windowed_counts(rows: DataFrame, event_time: str, key: str, size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts per event-time window and key, late rows within the watermark included."""
    return rows.withWatermark(event_time, late).groupBy(F.window(event_time, size), key).agg(F.count("*").alias("n"))
