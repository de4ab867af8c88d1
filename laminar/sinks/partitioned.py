"""Partition-overwrite writes.

``mode("overwrite")`` with ``partitionOverwriteMode=dynamic`` replaces only the
partitions present in the written frame, so rerunning a day is idempotent and
never erases other days. The option is set on the writer itself (path form), so
it does not depend on the session's configuration.

Before the write, a REBALANCE on the partition columns lets AQE size the write
tasks: small days are coalesced into one task, and a day holding a large share of
the rows is split across several tasks (and files) instead of one straggler. The
hash it uses is deterministic, so a retried task after a lost executor writes the
same rows. The written row count is observed on the write itself, not by a second
job over the lineage.

A write's shuffle files go when it ends. A large range is written in passes of whole days
(``day_passes``), so that its shuffles are on disk for a share of the days at a time.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from laminar.schemas import TableSpec, conform
from laminar.sources.tables import pointers, table_path

TABLE_CODEC = "zstd"                 # of warehouse tables: about 0.72 of their bytes under Snappy
PASS_BYTES = 32 << 20                # stored bytes whose days are shuffled in one pass
MAX_PASSES = 16                      # beyond these the passes grow, so the work stays in proportion


def day_passes(stored: int) -> int:
    """The number of passes for so many stored bytes."""
    return max(1, min(MAX_PASSES, math.ceil(stored / PASS_BYTES)))


def day_bucket(day: Column, passes: int) -> Column:
    """The pass of a day (of NULL as well), as an integer under ``passes``."""
    return F.pmod(F.xxhash64(day), F.lit(passes)).cast("int")


def write_frame(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                compression: str = "snappy", max_records_per_file: int = 5_000_000,
                dynamic: bool = True, spread: bool = True, sort_by: Sequence[str] = ()) -> int:
    """Write ``df`` to ``path``; returns the number of rows written.

    With ``dynamic`` only the partitions present in ``df`` are replaced, else the whole table.
    Without ``spread`` the rows are written where they are: for a frame that ends in an
    aggregate, whose shuffle has spread it already, or that is read from the folders of the
    same partitions, as then a task has files of few of them. With ``sort_by`` rows of like values come
    together and are sorted, so that a reader's filter on them skips the pages without any.
    """
    return int(_write(df, path, partition_by, fmt, compression, max_records_per_file, dynamic,
                      spread=spread, sort_by=sort_by).get("rows", 0))


def _write(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet",
           compression: str = "snappy", max_records_per_file: int = 5_000_000, dynamic: bool = True,
           written_days: bool = False, spread: bool = True, sort_by: Sequence[str] = ()) -> dict:
    """The write, with row count (and optionally the set of days) observed on it."""
    obs = Observation("written")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if written_days:
        metrics.append(F.collect_set(partition_by[0]).alias("days"))     # at most one entry per day
    together = partition_by or sort_by
    out = df.hint("rebalance", *together) if spread or sort_by else df
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    # Observed behind the exchange, in the tasks that write: a map stage that runs again
    # after a lost executor is not counted twice.
    out = out.observe(obs, *metrics)
    writer = (out.write.mode("overwrite").format(fmt).option("compression", compression)
              .option("maxRecordsPerFile", str(max_records_per_file)))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    with _sized(df.sparkSession, bool(partition_by)):
        writer.save(path)
    return _observed(obs)


# Settings of one write, by whether it is partitioned. A write of one folder makes files of
# the advisory size. A partitioned write of small days costs per file, and every day is in
# one task anyway, so its tasks may be small.
WRITE_CONF = {
    False: {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"},
    True: {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
           # Else a shuffle's files stay until the driver happens to collect garbage.
           "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"},
}
_lock = threading.Lock()
_active: dict[str, list] = {}                 # setting -> [value before, writes that hold it]


@contextmanager
def _sized(spark, partitioned: bool):
    """Hold the write's settings while it runs; concurrent writes share them."""
    conf = WRITE_CONF[partitioned]
    with _lock:
        for key, value in conf.items():
            _active.setdefault(key, [spark.conf.get(key, None), 0])[1] += 1
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            for key in conf:
                _active[key][1] -= 1
                if _active[key][1] == 0:
                    before = _active.pop(key)[0]
                    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _observed(obs: Observation) -> dict:
    """Metrics seen by the write. When partition pruning leaves no input at all, no
    task reports metrics and the observation stays empty: that is zero rows."""
    try:
        return dict(obs.get)
    except Exception as exc:  # py4j: empty metrics row cannot be converted
        if "assertion failed" in str(exc):
            return {}
        raise


def _folder_of(spark, column: str, value: str) -> str:
    """The folder name Spark gives a partition value (it escapes some characters)."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{column}={utils.escapePathName(value)}"


NO_DAY = "__HIVE_DEFAULT_PARTITION__"          # folder of rows whose day is NULL or empty


def _day_folders(spark, table_dir: str, column: str = "dt") -> list[str]:
    """The day folder names under a table folder (one listing call on the driver)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(table_dir)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(f"{column}=")]


def _delete(spark, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_table(df: DataFrame, root: str, spec: TableSpec, day: str | None = None,
                day_range: tuple[str | None, str | None] | None = None, **kwargs) -> int:
    """Conform to the table contract (strict casts), then partition-overwrite it.

    With a run ``day`` (day-partitioned tables), that day's folder is replaced
    outright, even when the day now has no rows: a dynamic partition overwrite
    writes nothing for an empty day and would keep the rows of an earlier run.
    With a ``day_range`` (a backfill; ``None`` ends are open), the days written are
    replaced and the range's other day folders of this table are removed, for the
    same reason.
    """
    out = conform(df, spec)
    kwargs.setdefault("compression", TABLE_CODEC)
    path = table_path(root, spec)
    if pointers(df.sparkSession, path):
        # A plain write would lie unread beside the published version of its day.
        if day is None:
            raise ValueError(f"{spec.qualified} has published days: publish each day, or retire them first")
        from laminar.sinks.publish import publish_day
        return publish_day(out, root, spec, day, **kwargs)
    if spec.partition_by != ("dt",) or (day is None and day_range is None):
        return write_frame(out, path, spec.partition_by, **kwargs)
    if day is not None:
        one_day = out.where(F.col("dt") == F.lit(day)).drop("dt")
        return write_frame(one_day, f"{path}/dt={day}", **kwargs)
    return write_range(out, path, "dt", day_range, **kwargs)


def write_range(df: DataFrame, path: str, column: str, day_range: tuple[str | None, str | None] = (None, None),
                passes: int = 1, **kwargs) -> int:
    """Write days of ``column`` and clear the range's other day folders.

    With ``passes`` the days are dealt to so many writes, one after the other. The frame is
    planned for each of them, with its days as a filter: one that reads stored days, and keeps
    them apart, reads each day once.

    Only folders that were there before the write can go, and only those that the write
    did not replace. Names are compared as Spark writes them. The folder of rows without
    a day is never removed, and nothing is if the write's observation did not arrive,
    unless the frame is empty.
    """
    spark = df.sparkSession
    before = _day_folders(spark, path, column)
    rows, written, unseen = 0, set(), False
    for i in range(passes):
        part = df if passes == 1 else df.where(day_bucket(F.col(column), passes) == i)
        seen = _write(part, path, (column,), written_days=True, **kwargs)
        rows += int(seen.get("rows", 0))
        written |= set(seen.get("days") or [])
        unseen = unseen or ("days" not in seen and not part.isEmpty())
    if unseen:
        return rows
    first, last = day_range
    kept = {_folder_of(spark, column, d) for d in written} | {f"{column}={NO_DAY}"}
    for folder in set(before) - kept:
        d = folder[len(column) + 1:]
        if (first is None or d >= first) and (last is None or d <= last):
            _delete(spark, f"{path}/{folder}")
    return rows


def land(df: DataFrame, root: str, spec: TableSpec, day: str | None = None, **kwargs) -> int:
    """Land extracted rows in the raw layer, stamped with the run day when given
    (then the day's folder is replaced, as for any one-day write)."""
    if day is not None:
        df = df.withColumn("dt", F.lit(day))
    return write_table(df, root, spec, day, **kwargs)
