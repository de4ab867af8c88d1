"""The stored user numbers and per-day bitmaps of active users (see ``operators.distinct``).

``numbers`` only grows: a run appends the users it meets first, and a run that dies after that finds
them numbered when it runs again. ``bitmaps`` has one folder per day, replaced by each run of the day,
so days may come in any order and again. One run at a time: two at once could give a number twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.functions.parsing import resolve_run_date
from laminar.operators import distinct
from laminar.schemas import DWD_ORDER_INFO
from laminar.session import configure, new_area, path_exists
from laminar.sinks.partitioned import write_frame, write_range
from laminar.sources.tables import read_table

KEY = "category_id"
BITMAPS = f"dt string, {KEY} string, chunk bigint, bitmap binary"


def _place(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/dws.db/active_users_{name}"


def numbers(spark: SparkSession, root: str) -> DataFrame:
    path = _place(root, "numbers")
    if path_exists(spark, path):
        return spark.read.schema(distinct.NUMBERS).parquet(path)
    return spark.createDataFrame([], distinct.NUMBERS)


def bitmaps(spark: SparkSession, root: str) -> DataFrame:
    path = _place(root, "bitmaps")
    if path_exists(spark, path):
        return spark.read.schema(BITMAPS).parquet(path)
    return spark.createDataFrame([], BITMAPS)


def _number(spark: SparkSession, root: str, detail: DataFrame) -> DataFrame:
    """All numbers, after those of the users that ``detail`` brings first are appended."""
    known = numbers(spark, root)
    area = new_area(spark, "new-users")
    if write_frame(distinct.unnumbered(detail, known), area):
        base = known.agg(F.coalesce(F.max("number"), F.lit(0)).cast("bigint")).first()[0]
        new = spark.read.schema("user_id string, _bucket int").parquet(area)
        distinct.numbered(new, base).write.mode("append").parquet(_place(root, "numbers"))
    return numbers(spark, root)


def update(spark: SparkSession, root: str, detail: DataFrame, day: str | None = None) -> int:
    """Take up order detail: the given ``day``, or all days in it (replacing every stored day).
    Returns the number of bitmaps written."""
    configure(spark)
    if day is not None:
        detail = detail.where(F.col("dt") == F.lit(day))
    found = distinct.daily_bitmaps(detail, _number(spark, root, detail), (KEY,))
    found = found.select(*spark.createDataFrame([], BITMAPS).columns)
    if day is None:
        return write_range(found, _place(root, "bitmaps"), "dt")
    return write_frame(found.drop("dt"), f"{_place(root, 'bitmaps')}/dt={day}")


def run_day(spark: SparkSession, root: str, day: str | None = None) -> int:
    """One day (default: yesterday) from the written order detail."""
    day = resolve_run_date(day)
    return update(spark, root, read_table(spark, root, DWD_ORDER_INFO, day), day)
