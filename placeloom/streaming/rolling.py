"""Sensor averages as files arrive, and upserts batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placeloom.operators.fill import upsert_plan


def hourly(events: DataFrame, ts: str, key: str, value: str, late: str = "2 hours") -> DataFrame:
    """Average and count by hour and key; state is dropped once the watermark has passed. For streams and tables."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.window(ts, "1 hour").alias("w"), key).agg(F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("hour"), key, "mean_value", "n")


def hourly_stream(means: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Appends each hour to Parquet files once the watermark has passed it: its state goes then, and later rows for it are dropped.

    once: all that is there, then the stream ends; hours that the watermark has not passed stay in the checkpoint.
    """
    writer = means.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def upsert_stream(updates: DataFrame, target: DataFrame, key: str, fields: Sequence[str], path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Writes each batch's change set under its number: a batch that runs again replaces what it wrote.

    A cell that an earlier batch filled is not filled again: what batches before this one wrote counts as the target's.
    once: all that is there, then the stream ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        changes = upsert_plan(target, batch, key, fields)
        if number:
            spark = batch.sparkSession
            schema = changes.select(key, "field").schema.add("batch", "long")
            done = spark.read.option("basePath", path).schema(schema).parquet(path).where(F.col("batch") < number)
            changes = changes.join(done, [key, "field"], "left_anti")
        changes.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = updates.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
