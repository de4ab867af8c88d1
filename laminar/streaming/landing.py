"""A stream into the raw layer: day partitions written exactly once, by bounded batches.

The batches have a byte bound, and no state is kept between them but the ledger's few lines,
so the order in which files arrive does not matter and nothing is dropped:

- Within a batch, copies of a key become one row by an aggregate with a map-side partial
  step, so a key delivered very often is no hot task. Across batches, rows whose key is
  already in the target are left out by an anti-join that reads only the batch's own days
  (a copy carries its original's event time). Rows without a key are all kept.
- A row behind the watermark (the largest event time of earlier batches less ``delay``) is
  landed like any other, and noted in the late table, whose days a daily run has to redo.
- Files are written apart, then renamed into their day folders under the batch's number. The
  ledger names them first. A batch that runs again, after a failure or a lost checkpoint
  commit, removes its own files and no others before it writes.

Rows without an event time go to the folder of no day, where copies are dropped within a
batch only. A day is fed either by a stream or by ``land``, which replaces the day's folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.schemas import TableSpec, conform
from laminar.sinks import files
from laminar.sinks.partitioned import write_frame
from laminar.sources.tables import table_path
from laminar.streaming.ledger import Ledger
from laminar.streaming.source import event_stream

EVENT_TIME = "event_time"


@dataclass(frozen=True)
class Landing:
    """Where a stream lands: a raw table under ``root``, with its checkpoint, ledger and late rows."""
    root: str
    spec: TableSpec
    key: str
    delay: dt.timedelta = dt.timedelta(hours=1)

    @property
    def area(self) -> str:
        return f"{self.root.rstrip('/')}/_landing/{self.spec.name}"

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, f"{self.area}/ledger")


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """Each key once (of different rows the least, so that a rerun keeps the same one). Rows
    without a key are groups of their own, so all of it is one aggregate over one scan."""
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    copies = rows.withColumn("_alone", alone).groupBy(key, "_alone").agg(
        F.min(F.struct(*[c for c in rows.columns if c != key])).alias("_row"))
    return copies.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def land_batch(batch: DataFrame, number: int, to: Landing) -> None:
    """Land one batch: contract columns, ``dt`` and ``event_time``."""
    spark = batch.sparkSession
    ledger, table = to.ledger(spark), table_path(to.root, to.spec)
    for name in (ledger.entry(number) or {}).get("files", []):
        files.remove(spark, f"{table}/{name}")
    stage = f"{to.area}/stage/{number}"
    files.remove(spark, stage)
    latest = ledger.latest_time(number)

    staged = conform(batch, to.spec).columns
    rows = batch.select(*staged, F.col(EVENT_TIME).cast("timestamp").alias(EVENT_TIME))
    write_frame(one_per_key(rows, to.key), f"{stage}/once", spread=False)
    once = spark.read.schema(rows.schema).parquet(f"{stage}/once")
    seen = once.agg(F.max(EVENT_TIME).alias("t"), F.collect_set("dt").alias("days")).first()      # days of one batch
    present = [f"{table}/dt={d}" for d in seen["days"] if files.names(spark, f"{table}/dt={d}")]
    new = once
    if present:
        landed = spark.read.schema(to.spec.full_schema).option("basePath", table).parquet(*present)
        new = once.join(landed.where(F.col(to.key).isNotNull()).select(to.key, "dt"), [to.key, "dt"], "left_anti")
    write_frame(new.select(*rows.columns), f"{stage}/new", spread=False)
    new = spark.read.schema(rows.schema).parquet(f"{stage}/new")
    count = write_frame(conform(new, to.spec), f"{stage}/out", ("dt",))

    late, late_path = 0, f"{to.area}/late/batch={number}"
    files.remove(spark, late_path)
    if latest is not None:
        behind = new.where(F.col(EVENT_TIME) < F.lit(latest - to.delay))
        late = write_frame(behind, late_path)
    days = [d for d in files.names(spark, f"{stage}/out") if d.startswith("dt=")]
    moves = {f"{d}/b{number:010d}-{n}": f"{stage}/out/{d}/{n}" for d in days
             for n in files.names(spark, f"{stage}/out/{d}") if not n.startswith((".", "_"))}
    entry = {"files": sorted(moves), "rows": count, "late": late, "latest": ledger.later(number, seen["t"])}
    ledger.write(number, done=False, **entry)
    for name, source in moves.items():
        files.move(spark, source, f"{table}/{name}")
    ledger.write(number, done=True, **entry)
    files.remove(spark, stage)


def run_landing(spark: SparkSession, folder: str, shape: Callable[[DataFrame], DataFrame], to: Landing,
                table: str = "events.parquet", max_bytes_per_trigger: int = 1 << 30) -> dict[int, dict]:
    """Land all files present in ``folder/table``, in batches of at most the given bytes (one
    file at least). ``shape`` turns source rows into contract columns, ``dt`` and ``event_time``.
    Returns the ledger. A later run takes the files that came since."""
    stream = event_stream(spark, folder, table, max_bytes_per_trigger)
    query = (stream.writeStream.foreachBatch(lambda batch, number: land_batch(shape(batch), number, to))
             .option("checkpointLocation", f"{to.area}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return to.ledger(spark).batches()


def late_rows(spark: SparkSession, to: Landing) -> DataFrame:
    """Rows that came behind the watermark, with the batch that brought them."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in to.spec.full_schema.fields)}, {EVENT_TIME} timestamp"
    if not files.names(spark, f"{to.area}/late"):
        return spark.createDataFrame([], f"{schema}, batch int")
    return spark.read.schema(f"{schema}, batch int").parquet(f"{to.area}/late")


def days_to_redo(spark: SparkSession, to: Landing) -> list[str]:
    """Days that got rows after the watermark had passed them."""
    return sorted(r["dt"] for r in late_rows(spark, to).select("dt").distinct().collect())
