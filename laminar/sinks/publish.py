"""A day published at once: written apart, confirmed, then switched to.

A run's rows of a day go to a version folder of their own under the table
(``_versions/dt=<day>/``, hidden from plain reads of the table). When the rows read back
are as many as were written, a pointer (``_published/dt=<day>.v<n>``) is renamed into place,
and the catalog's partition, if the table is in the catalog, is set to the new folder. So a
run that fails leaves the earlier rows, and a reader sees the old day or the new one, never
none and never both. Pointers of all days are found by one listing; the newest of a day wins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.schemas import TableSpec, conform
from laminar.sinks import files
from laminar.sinks.partitioned import write_frame
from laminar.sources.tables import POINTERS, VERSIONS, pointers, table_path


class PublishError(RuntimeError):
    """A day could not be published; its earlier rows stay."""


def publish_day(df: DataFrame, root: str, spec: TableSpec, day: str, **kwargs) -> int:
    """Replace a day of a day-partitioned table by the rows of ``df`` with that ``dt`` (or all
    of them, if it has none); returns the rows written."""
    if spec.partition_by != ("dt",):
        raise ValueError(f"{spec.qualified} is not partitioned by day")
    spark, table = df.sparkSession, table_path(root, spec)
    rows = df.where(F.col("dt") == F.lit(day)) if "dt" in df.columns else df.withColumn("dt", F.lit(day))
    version = pointers(spark, table).get(day, (0, ""))[0] + 1
    folder = f"{VERSIONS}/dt={day}/v{version:06d}-{uuid.uuid4().hex[:8]}"
    written = write_frame(conform(rows, spec).drop("dt"), f"{table}/{folder}", **kwargs)
    found = spark.read.schema(spec.schema).parquet(f"{table}/{folder}").count()       # from the footers
    if found != written:
        raise PublishError(f"{spec.qualified} {day}: {written} rows written, {found} read back")
    if not files.publish_text(spark, f"{table}/{POINTERS}/dt={day}.v{version:06d}", folder):
        raise PublishError(f"{spec.qualified} {day}: version {version} was published by another run")
    if spark.catalog.tableExists(spec.qualified):
        spark.sql(f"ALTER TABLE {spec.qualified} ADD IF NOT EXISTS PARTITION (dt = '{day}')")
        spark.sql(f"ALTER TABLE {spec.qualified} PARTITION (dt = '{day}') SET LOCATION '{table}/{folder}'")
        spark.catalog.refreshTable(spec.qualified)
    return written


def retire(spark: SparkSession, root: str, spec: TableSpec) -> list[str]:
    """Remove what no pointer needs: earlier versions, versions that were never published, and
    plain folders of published days. For use when no reader of an earlier version is left."""
    table = table_path(root, spec)
    current = pointers(spark, table)
    gone = []
    for name in files.names(spark, f"{table}/{POINTERS}"):
        day, version = name[len("dt="):].rsplit(".v", 1)
        if int(version) < current[day][0]:
            files.remove(spark, f"{table}/{POINTERS}/{name}")
    kept = {folder for _, folder in current.values()}
    for day_folder in files.names(spark, f"{table}/{VERSIONS}"):
        for version in files.names(spark, f"{table}/{VERSIONS}/{day_folder}"):
            if f"{VERSIONS}/{day_folder}/{version}" not in kept:
                gone.append(f"{VERSIONS}/{day_folder}/{version}")
    gone += [f"dt={d}" for d in current if files.names(spark, f"{table}/dt={d}")]
    for folder in gone:
        files.remove(spark, f"{table}/{folder}")
    return gone
