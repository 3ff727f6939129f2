"""Incremental quality metrics: windowed counts and sums of a stream of measurements."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindrel.runtime import shared_folder


def windowed(events: DataFrame, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Count, sum and extremes of ``value`` per event type and window; works on batches and streams alike."""
    source = events
    if events.isStreaming:  # event time of a stream has to be a timestamp with a zone
        source = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    w = source.groupBy(F.window("ts", width), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.min("value").alias("least"), F.max("value").alias("most")
    )
    return w.select(F.col("window.start").alias("window_start"), "event_type", "n", "total", "least", "most")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of each user, ended by a pause of ``gap``."""
    s = events.groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def run_to_table(spark: SparkSession, path: str, schema, width: str, late: str = "1 hour", folder: str | None = None) -> DataFrame:  # noqa: ANN001
    """Run the windowed stream over the files at ``path`` as far as they go and read its table.

    State and table live in ``folder``; the same folder given again goes on where the last run ended, as does a run whose executor is
    lost. Without one, a new folder in the shared folder is taken. Each batch writes the windows that it changed, and writes
    them again if it is repeated; the newest of each window counts. Windows older than the watermark leave the state.
    """
    folder = folder or f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    pattern = f"{path[:-1]}[{path[-1]}]"  # as a pattern, as a plain path has to be a folder
    stream = windowed(spark.readStream.schema(schema).parquet(pattern), width, late)
    write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/table/batch={n}")
    query = (
        stream.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()
    rows = spark.read.parquet(f"{folder}/table")
    newest = Window.partitionBy("window_start", "event_type").orderBy(F.desc("batch"))
    return rows.withColumn("k", F.row_number().over(newest)).where("k = 1").drop("k", "batch")
