"""Streaming ingest into the raw layer with duplicate suppression.

Collectors deliver at least once, so the same event can arrive more than once.
``dropDuplicatesWithinWatermark`` keeps the first copy of each event id and
forgets ids once the watermark has passed them, so state stays bounded by the
watermark delay instead of growing with all ids ever seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laminar.session import new_area
from laminar.streaming.source import event_stream, finish, prefer_rocksdb_state

EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value", "props", "ts")


def dedup_events(events: DataFrame, delay: str = "1 hour", key: str = "event_id") -> DataFrame:
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def run_dedup_ingest(spark: SparkSession, folder: str, out: str | None = None, copies: int = 2,
                     delay: str = "1 hour", max_bytes_per_trigger: int | None = None,
                     allow_late: bool = False) -> str:
    """Ingest the events landing in ``folder`` (delivered ``copies`` times each) into a
    parquet folder, once, and return that folder. Checkpointed under the shared root,
    so a restarted run resumes after the last committed batch. Raises if the watermark
    dropped rows (unless allowed)."""
    prefer_rocksdb_state(spark)
    area = out or new_area(spark, "stream-ingest")
    streams = [event_stream(spark, folder, max_bytes_per_trigger=max_bytes_per_trigger).select(*EVENT_COLUMNS)
               for _ in range(max(1, copies))]
    arriving = streams[0]
    for s in streams[1:]:
        arriving = arriving.unionByName(s)
    q = (dedup_events(arriving, delay).writeStream.format("parquet")
         .option("path", f"{area}/data").option("checkpointLocation", f"{area}/_checkpoint")
         .outputMode("append").trigger(availableNow=True).start())
    finish(q, allow_late)
    return f"{area}/data"
