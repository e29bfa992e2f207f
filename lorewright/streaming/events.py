"""Structured Streaming over events: late data, windows, first occurrences, resume by state."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorewright.session import shared_folder

SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, per_trigger: int = 1000) -> DataFrame:
    """A stream over Parquet files of events."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def first_events(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each event once, within the watermark."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def hourly(events: DataFrame, delay: str = "1 hour", width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts and sums per window and type."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return events.withWatermark("ts", delay).groupBy(w.alias("w"), "event_type").agg(
        F.count("*").alias("events"), F.sum("value").alias("total")
    ).select(F.col("w.start").alias("start"), "event_type", "events", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions per user, closed after a gap."""
    return events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("events")).select(
        F.col("s.start").alias("start"), F.col("s.end").alias("end"), "user_id", "events"
    )


def running_totals(events: DataFrame) -> DataFrame:
    """Per type the running count and total, by custom state that survives restarts."""

    def update(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for b in batches:
            n, total = n + len(b), total + float(b["value"].fillna(0.0).sum())
        state.update((n, total))
        yield pd.DataFrame({"event_type": [key[0]], "events": [n], "total": [total]})

    return events.groupBy("event_type").applyInPandasWithState(
        update, "event_type string, events bigint, total double", "events bigint, total double", "update", "NoTimeout"
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop; the next run resumes where this ended."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def drained(result: DataFrame, mode: str = "complete") -> DataFrame:
    """A stream's result over all that is there now, as a table in the shared folder.

    ``complete`` keeps the last state of every group, ``append`` all rows given out, ``update`` the last row
    of each batch for its groups, with the batch's number in ``batch``. State and result
    lie in the shared folder, so a lost executor costs its tasks only.
    """
    spark = result.sparkSession
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def keep(rows: DataFrame, batch: int) -> None:
        if mode == "complete":
            rows.write.mode("overwrite").parquet(f"{home}/out")
        else:
            rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{home}/out/batch_no={batch}")

    kept = result.schema if mode == "complete" else result.withColumn("batch", F.lit(0).cast("bigint")).schema
    q = result.writeStream.foreachBatch(keep).option("checkpointLocation", f"{home}/state").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(kept).parquet(f"{home}/out")
