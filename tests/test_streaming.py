"""Streams equal their batch twins on the driver events."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from laminar.streaming.activity import daily_activity, latest_versions, run_daily_activity
from laminar.streaming.ingest import run_dedup_ingest


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedup_ingest_keeps_each_event_once(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = spark.read.parquet(run_dedup_ingest(spark, SF_SMALL, copies=3))
    assert out.count() == events.count() == events.select("event_id").distinct().count()


def test_daily_activity_stream_equals_batch(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    streamed = latest_versions(spark, run_daily_activity(spark, SF_SMALL))
    batch = daily_activity(events)
    cols = batch.columns
    assert rows(streamed.select(*cols)) == rows(batch)
    assert streamed.agg(F.sum("event_count")).first()[0] == events.count()
