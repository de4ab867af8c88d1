"""Event stream source: a file source over a landing folder or table, with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from laminar.session import is_directory

# Large streaming state belongs off the JVM heap; used unless the session picked a provider.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LateRowsError(RuntimeError):
    """A stream dropped rows that came after its watermark."""


def prefer_rocksdb_state(spark: SparkSession) -> None:
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if not current or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB_PROVIDER)


def event_stream(spark: SparkSession, folder: str, table: str = "events.parquet",
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Events of ``folder/table``, which is one Parquet file or a folder of them; ``ts``
    typed as an instant (watermarks need TIMESTAMP, the files carry timestamp_ntz).

    There is no cap per trigger by default: a run takes all files present in one batch, so
    the result does not depend on how the rows are spread over files. With a byte cap,
    files that arrive in a later batch can lie behind the watermark; ``finish`` then fails.
    """
    path = f"{folder.rstrip('/')}/{table}"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if is_directory(spark, path):
        raw = reader.parquet(path)
    else:                                   # a file stream reads folders: take this file of its folder
        raw = reader.option("pathGlobFilter", table).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def late_rows(query: StreamingQuery, seen: dict[int, int]) -> int:
    """Rows dropped by the watermark so far; ``seen`` holds them per batch."""
    for p in query.recentProgress:
        seen[p["batchId"]] = max(seen.get(p["batchId"], 0), sum(
            s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", [])))
    return sum(seen.values())


def finish(query: StreamingQuery, allow_late: bool = False) -> int:
    """Wait for the query to end; returns the rows its watermark dropped, or raises for them."""
    seen: dict[int, int] = {}
    while not query.awaitTermination(1):
        late_rows(query, seen)
    dropped = late_rows(query, seen)
    if dropped and not allow_late:
        raise LateRowsError(f"{dropped} rows came after the watermark and were dropped; "
                            "give the stream a longer delay or a larger batch")
    return dropped
