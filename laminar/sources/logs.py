"""Log-file source: JSON lines read with an explicit schema (no inference pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_LOG_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

MALFORMED = "malformed_line"


def read_event_log(spark: SparkSession, path: str, schema: T.StructType = EVENT_LOG_SCHEMA) -> DataFrame:
    """Malformed lines become NULL rows with their text in ``malformed_line``, instead of
    failing the day."""
    kept = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    return (spark.read.schema(kept).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", MALFORMED).json(path))


# Events land as gzip JSON lines. A gzip file is read whole by one task, so the
# writer caps the lines per file and a large day spreads over many files.
LOG_LINES_PER_FILE = 1_000_000


def land_event_log(events: DataFrame, path: str, lines_per_file: int = LOG_LINES_PER_FILE) -> str:
    """Write events as collector-style log files (gzip JSON lines, one folder per day)."""
    out = events.select(*EVENT_LOG_SCHEMA.fieldNames()).withColumn("ts", F.col("ts").cast("timestamp"))
    (out.withColumn("dt", F.date_format("ts", "yyyy-MM-dd")).hint("rebalance", "dt")
        .write.mode("overwrite").partitionBy("dt").option("compression", "gzip")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("maxRecordsPerFile", str(lines_per_file)).json(path))
    return path


def daily_event_summary(log: DataFrame) -> DataFrame:
    """Per day and event type: events, distinct users and summed value (exact decimal).

    Malformed lines (NULL timestamp) are kept under a NULL day rather than dropped."""
    return log.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("dt"), "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("user_id").alias("users"),
        F.sum(F.col("value").cast("decimal(12,2)")).alias("total_value"),
    )
