"""File streams of records: quality control, windowed usage totals and idempotent publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import qc


def record_stream(spark: SparkSession, path: str, schema, max_files: int = 64) -> DataFrame:
    """Records of Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def usage_by_window(events: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Events per window and type; state of windows older than the watermark is dropped."""
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    grouped = timed.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return grouped.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def publish(records: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Valid and quarantined records of each micro-batch, under its number: a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        judged = qc.with_errors(batch)
        for name, hit in (("valid", F.size("errors") == 0), ("quarantine", F.size("errors") > 0)):
            judged.where(hit).write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
