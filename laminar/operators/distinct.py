"""Exact distinct user counts that add up over days: per-day bitmaps over dense user numbers.

COUNT(DISTINCT) of a week cannot be made from the counts of its days. Bitmaps can: users get dense
numbers once, each (day, keys) keeps the set of its users as bitmaps of 32,768 numbers a chunk, and
any union of days or keys is an OR, counted at the end. Weeks, months and trailing windows then read
the bitmaps only, never the detail.

Scale
- Users are numbered by bucket: ranks inside a bucket, bucket totals (at most ``buckets`` rows) make
  the offsets. So no task sees all users, and the numbers have no gaps that would thin the bitmaps.
- Detail is reduced to different (day, keys, user) before it meets the numbers, so a hot user is one
  row per day and keys. A day costs at most users / 8 bytes per key.
- Bitmaps are combined in the map tasks before each shuffle.

Defined results: rows without a user or a day count nowhere; a NULL key is a key of its own. Repeated
rows count once. Empty input gives no rows. Columns not named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NUMBERS = "user_id string, number bigint"
BUCKETS = 256


def unnumbered(rows: DataFrame, known: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(user_id, _bucket) of the users that have no number yet. To be written before ``numbered``,
    which reads it twice."""
    users = rows.where("user_id IS NOT NULL").select("user_id").distinct()
    return (users.join(known, "user_id", "left_anti")
            .withColumn("_bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")))


def numbered(new: DataFrame, base: int) -> DataFrame:
    """(user_id, number): ``base + 1`` and on, without gaps."""
    sizes = new.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)      # one row per bucket
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("user_id"))
    return (new.withColumn("_rank", rank).join(F.broadcast(offsets), "_bucket")
            .select("user_id", (F.lit(base) + F.col("_before") + F.col("_rank")).cast("bigint").alias("number")))


def daily_bitmaps(rows: DataFrame, numbers: DataFrame, by: Sequence[str]) -> DataFrame:
    """(dt, keys, chunk, bitmap) of the users of each day and keys."""
    seen = rows.where("user_id IS NOT NULL AND dt IS NOT NULL").select("dt", *by, "user_id").distinct()
    placed = seen.join(numbers, "user_id").withColumn("chunk", F.bitmap_bucket_number("number"))
    return (placed.groupBy("dt", *by, "chunk")
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")))


def _counted(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Distinct users per keys: chunks are united, then their sizes add up."""
    united = bitmaps.groupBy(*keys, "chunk").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias("active_users"))


def by_period(bitmaps: DataFrame, by: str, periods: Sequence[str] = ("week", "month")) -> DataFrame:
    """(period, period_start, level, ``by``, active_users): per value of ``by`` (level ``by``) and over
    all of them (level ``all``, value NULL)."""
    start = {p: F.date_trunc(p, F.col("dt").cast("date")).cast("date") for p in periods}
    value, none = F.col(by), F.lit(None).cast(bitmaps.schema[by].dataType)
    groups = F.array(*[F.struct(F.lit(p).alias("period"), s.alias("period_start"), F.lit(level).alias("level"), v.alias(by))
                       for p, s in start.items() for level, v in ((by, value), ("all", none))])
    each = bitmaps.select(F.explode(groups).alias("_g"), "chunk", "bitmap").select("_g.*", "chunk", "bitmap")
    return _counted(each, "period", "period_start", "level", by)


def trailing(bitmaps: DataFrame, days: int = 7) -> DataFrame:
    """(dt, active_users) per day that has rows: different users of that day and the ``days - 1`` before."""
    daily = bitmaps.groupBy(F.col("dt").cast("date").alias("_day"), "chunk").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    until = F.explode(F.sequence("_day", F.date_add("_day", days - 1)))
    each = daily.select(until.alias("_until"), (F.col("_day")).alias("_from"), "chunk", "bitmap")
    # A day has rows if one of its own bitmaps is among those that reach it.
    united = each.groupBy("_until", "chunk").agg(F.bitmap_or_agg("bitmap").alias("bitmap"),
                                                 F.max(F.col("_from") == F.col("_until")).alias("_own"))
    return (united.groupBy("_until").agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias("active_users"),
                                         F.max("_own").alias("_own"))
            .where("_own").select(F.date_format("_until", "yyyy-MM-dd").alias("dt"), "active_users"))
