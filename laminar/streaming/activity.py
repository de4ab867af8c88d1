"""Per-user daily activity, as a stream and as its batch twin.

The stream aggregates tumbling one-day windows under a watermark; rows later than
the watermark are dropped. It runs in **update** mode: append mode would not emit
the last, still-open day. Update mode may emit a key more than once across
micro-batches, so each batch is written to its own folder and the reader keeps
the newest version of each (window, user).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from laminar.session import new_area, path_exists
from laminar.sinks.partitioned import write_frame
from laminar.streaming.ledger import Ledger
from laminar.streaming.source import event_stream, finish, prefer_rocksdb_state

VALUE = "decimal(12,2)"
ACTIVITY_SCHEMA = ("window_start timestamp, window_end timestamp, user_id string, event_count bigint, "
                   "view_count bigint, purchase_count bigint, total_value decimal(22,2)")


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col("event_type") == "view").alias("view_count"),
        F.count_if(F.col("event_type") == "purchase").alias("purchase_count"),
        F.sum(F.col("value").cast(VALUE)).alias("total_value"),
    ]


def _shape(df: DataFrame) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                     F.col("user_id").cast("string").alias("user_id"),
                     "event_count", "view_count", "purchase_count", "total_value")


def daily_activity(events: DataFrame) -> DataFrame:
    """Batch twin: the same windows and measures over a static frame."""
    ev = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return _shape(ev.groupBy(F.window("ts", "1 day"), "user_id").agg(*_measures()))


def run_daily_activity(spark: SparkSession, folder: str, out: str | None = None,
                       delay: str = "1 hour", max_bytes_per_trigger: int | None = None,
                       allow_late: bool = False) -> str:
    """Run over all files present; raises if the watermark dropped rows (unless allowed)."""
    prefer_rocksdb_state(spark)
    area = out or new_area(spark, "stream-activity")
    stream = event_stream(spark, folder, max_bytes_per_trigger=max_bytes_per_trigger)
    agg = _shape(stream.withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), "user_id").agg(*_measures()))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, overwritten on a retry: re-running a batch is idempotent.
        batch.write.mode("overwrite").parquet(f"{area}/data/batch_id={batch_id}")

    q = (agg.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", f"{area}/_checkpoint").trigger(availableNow=True).start())
    finish(q, allow_late)
    return f"{area}/data"


def run_bounded_activity(spark: SparkSession, folder: str, out: str, table: str = "events.parquet",
                         max_bytes_per_trigger: int = 1 << 30, delay: dt.timedelta = dt.timedelta(hours=1)) -> dict[int, dict]:
    """Daily activity by batches of bounded size, with no row dropped.

    The measures add up, so a batch writes its partial sums to a folder of its own
    (overwritten if it runs again) and ``merged_activity`` adds the batches. No state is
    kept, files may come in any order, and a late row counts in its window like any other;
    late rows (behind the largest event time of earlier batches less ``delay``) are also
    kept in ``out/late``. Returns the ledger of the batches.
    """
    ledger = Ledger(spark, f"{out}/ledger")

    def write_batch(batch: DataFrame, number: int) -> None:
        events = batch.observe(seen := Observation(), F.max("ts").alias("t"))
        rows = write_frame(daily_activity(events), f"{out}/data/batch_id={number}")
        latest, late = ledger.latest_time(number), 0
        if latest is not None:
            late = write_frame(batch.where(F.col("ts") < F.lit(latest - delay)), f"{out}/late/batch_id={number}")
        ledger.write(number, done=True, rows=rows, late=late, latest=ledger.later(number, seen.get["t"] if rows else None))

    stream = event_stream(spark, folder, table, max_bytes_per_trigger)
    query = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", f"{out}/_checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return ledger.batches()


def merged_activity(spark: SparkSession, out: str) -> DataFrame:
    """The sum of all batches' partial sums per (window, user)."""
    if not path_exists(spark, f"{out}/data"):
        return spark.createDataFrame([], ACTIVITY_SCHEMA)
    parts = spark.read.schema(ACTIVITY_SCHEMA).parquet(f"{out}/data")
    return parts.groupBy("window_start", "window_end", "user_id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("event_count", "view_count", "purchase_count")],
        F.sum("total_value").cast("decimal(22,2)").alias("total_value"))


def latest_versions(spark: SparkSession, path: str) -> DataFrame:
    """Newest emitted version of each (window, user): max over (batch_id, measures)."""
    if not path_exists(spark, path):         # no batch ran
        return spark.createDataFrame([], ACTIVITY_SCHEMA)
    emitted = spark.read.parquet(path)
    measures = ["event_count", "view_count", "purchase_count", "total_value"]
    newest = emitted.groupBy("window_start", "window_end", "user_id").agg(
        F.max(F.struct("batch_id", *measures)).alias("_v"))
    return newest.select("window_start", "window_end", "user_id", *[F.col(f"_v.{m}").alias(m) for m in measures])
