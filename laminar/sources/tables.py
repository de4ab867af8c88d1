"""Reads of written warehouse tables.

Paths are read with the contract's schema so the ``dt`` partition stays a STRING
(inference would turn it into a DATE). A one-day read opens only that day's
folder (``basePath`` keeps ``dt`` as a column), so a daily run lists one
directory, not every day the table has ever had. Range reads filter on ``dt``,
which Spark applies as a partition filter.

Days published by version (``sinks.publish``) are read from the folder their newest pointer
names, in place of the plain day folder; one listing finds all pointers of a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.schemas import TableSpec
from laminar.session import path_exists
from laminar.sinks import files


def table_path(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/{spec.database}.db/{spec.name}"


POINTERS, VERSIONS = "_published", "_versions"


def pointers(spark: SparkSession, table: str) -> dict[str, tuple[int, str]]:
    """Published days of a table: day -> (version, folder under the table)."""
    newest: dict[str, int] = {}
    for name in files.names(spark, f"{table}/{POINTERS}"):
        if name.startswith("dt=") and ".v" in name:
            day, version = name[len("dt="):].rsplit(".v", 1)
            newest[day] = max(newest.get(day, 0), int(version))
    return {d: (v, files.read_text(spark, f"{table}/{POINTERS}/dt={d}.v{v:06d}")) for d, v in newest.items()}


def _versions(spark: SparkSession, spec: TableSpec, table: str, folders: Sequence[str]) -> DataFrame:
    reader = spark.read.schema(spec.full_schema).option("basePath", f"{table}/{VERSIONS}")
    return reader.parquet(*[f"{table}/{f}" for f in sorted(folders)])


def _all_days(spark: SparkSession, spec: TableSpec, table: str, first: str | None, last: str | None) -> DataFrame:
    """Plain day folders, and published days in place of theirs."""
    published = pointers(spark, table) if spec.partition_by == ("dt",) else {}
    if not published:
        return spark.read.schema(spec.full_schema).parquet(table)
    chosen = [f for d, (_, f) in published.items() if (first is None or d >= first) and (last is None or d <= last)]
    plain = [f"{table}/{n}" for n in files.names(spark, table) if n.startswith("dt=") and n[len("dt="):] not in published]
    parts = [_versions(spark, spec, table, chosen)] if chosen else []
    if plain:
        parts.append(spark.read.schema(spec.full_schema).option("basePath", table).parquet(*plain))
    if not parts:
        return spark.createDataFrame([], spec.full_schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_table(spark: SparkSession, root: str, spec: TableSpec, day: str | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """``SELECT cols FROM t [WHERE dt = day]``; a day that was never written is empty."""
    base = table_path(root, spec)
    reader = spark.read.schema(spec.full_schema)
    if day is None:
        df = _all_days(spark, spec, base, None, None)
    else:
        day_path = f"{base}/dt={day}"
        published = pointers(spark, base).get(day)
        if published:
            df = _versions(spark, spec, base, [published[1]])
        elif path_exists(spark, day_path):
            df = reader.option("basePath", base).parquet(day_path)
        else:
            df = spark.createDataFrame([], spec.full_schema)
        df = df.where(F.col("dt") == F.lit(day))
    if columns is not None:
        df = df.select(*columns)
    return df


def read_days(spark: SparkSession, root: str, spec: TableSpec, first: str | None, last: str | None) -> DataFrame:
    """All partitions in an inclusive day range (string order equals day order)."""
    if first is not None and first == last:
        return read_table(spark, root, spec, first)
    df = _all_days(spark, spec, table_path(root, spec), first, last)
    if first is not None:
        df = df.where(F.col("dt") >= F.lit(first))
    if last is not None:
        df = df.where(F.col("dt") <= F.lit(last))
    return df
