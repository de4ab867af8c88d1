"""Serving kept up by increments: what one day changes, and how the state takes it up.

The state has one row per user: the orders per order date (``dates``) and the sums per
category (``categories``), both as maps. Every count in it can be added to and taken from, so
days may be applied in any order, applied again with other rows, or arrive late: what is
applied is the difference between a day's new and its earlier contribution. From the order
dates before and after, the change of the daily trend follows exactly (first days, days that
follow a day with orders), whatever the age of an order.

A user's row holds one entry per order date and per category, so it is bounded by the calendar
and the categories, not by the number of orders.

Order detail has no NULL user, order id, category or amount (the detail layer sees to it);
orders without an order date do not count, as in the full rebuild.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("user_id", "category_id", "order_date")
AMOUNT = "decimal(38,2)"
CHANGE = f"user_id string, category_id string, order_date date, n bigint, amount {AMOUNT}, bad bigint"
SUMS = f"struct<n:bigint,amount:{AMOUNT},bad:bigint>"
STATE = (f"user_id string, dates map<date,bigint>, categories map<string,{SUMS}>, before array<date>, bucket int")
TREND = f"stat_date date, orders bigint, amount {AMOUNT}, active bigint, new bigint, retained bigint"


def contribution(detail: DataFrame, bad_statuses: Sequence[str]) -> DataFrame:
    """Order detail reduced to one row per (day, user, category, order date). The partial
    aggregate runs in the map tasks, so a hot user is a few rows in the shuffle."""
    dated = detail.where("order_date IS NOT NULL")
    return dated.groupBy("dt", *KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum("final_amount").cast(AMOUNT).alias("amount"),
        F.count_if(F.col("order_status").isin(*bad_statuses)).alias("bad"))


def difference(new: DataFrame, old: DataFrame, waiting: DataFrame) -> DataFrame:
    """What applying ``new`` in place of ``old`` changes, with the changes that were waiting
    for their order date; keys that do not change are left out."""
    minus = old.select(*KEYS, *[(-F.col(c)).alias(c) for c in ("n", "amount", "bad")])
    cols = (*KEYS, "n", "amount", "bad")
    both = new.select(*cols).unionByName(minus).unionByName(waiting.select(*cols))
    summed = both.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("amount").cast(AMOUNT).alias("amount"),
                                     F.sum("bad").alias("bad"))
    return summed.where("n <> 0 OR amount <> 0 OR bad <> 0")


def bucket_of(user: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")


def _per_user(changes: DataFrame) -> DataFrame:
    """One row per changed user: the change per date and per category, as maps. All steps
    keep the distribution by user, so there is one shuffle."""
    rows = changes.repartition("user_id")
    dates = rows.groupBy("user_id", "order_date").agg(F.sum("n").alias("n"))
    dates = dates.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("order_date", "n"))).alias("d_dates"))
    cats = rows.groupBy("user_id", "category_id").agg(
        F.struct(F.sum("n").alias("n"), F.sum("amount").cast(AMOUNT).alias("amount"), F.sum("bad").alias("bad")).alias("s"))
    cats = cats.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("category_id", "s"))).alias("d_categories"))
    return dates.join(cats, "user_id")


def apply_changes(state: DataFrame, changes: DataFrame, buckets: int) -> DataFrame:
    """The state's rows after ``changes``. ``before`` holds the earlier order dates of a user
    that changed and is NULL for one that did not. A user without orders is left out later
    (``live``): the row stays in this version, as its trend has still to be taken back."""
    delta = _per_user(changes)
    no_dates = F.create_map().cast("map<date,bigint>")
    no_sums = F.create_map().cast(f"map<string,{SUMS}>")
    joined = state.drop("before", "bucket").join(delta, "user_id", "full")

    def added(key, x, y):
        def part(c, zero):
            return F.coalesce(x[c], zero) + F.coalesce(y[c], zero)
        nil, money = F.lit(0).cast("bigint"), F.lit(0).cast(AMOUNT)
        return F.struct(part("n", nil).alias("n"), part("amount", money).cast(AMOUNT).alias("amount"),
                        part("bad", nil).alias("bad"))

    zero = F.lit(0).cast("bigint")
    dates = F.map_filter(F.map_zip_with(
        F.coalesce("dates", no_dates), F.coalesce("d_dates", no_dates),
        lambda k, x, y: F.coalesce(x, zero) + F.coalesce(y, zero)), lambda k, v: v != 0)
    sums = F.map_filter(F.map_zip_with(
        F.coalesce("categories", no_sums), F.coalesce("d_categories", no_sums), added), lambda k, v: v["n"] != 0)
    changed = F.col("d_dates").isNotNull()
    return joined.select(
        "user_id", F.when(changed, dates).otherwise(F.col("dates")).alias("dates"),
        F.when(changed, sums).otherwise(F.col("categories")).alias("categories"),
        F.when(changed, F.coalesce(F.map_keys("dates"), F.array().cast("array<date>"))).alias("before"),
        bucket_of(F.col("user_id"), buckets).alias("bucket"))


def live(state: DataFrame) -> DataFrame:
    return state.where(F.size("dates") > 0)


def trend_change(changes: DataFrame, changed_users: DataFrame) -> DataFrame:
    """Per order date, what ``changes`` add to the trend. ``changed_users`` are the state's
    rows with ``before``."""
    def marks(dates: Column, sign: int) -> Column:
        def of(d):
            count = F.lit(sign).cast("bigint")
            none = F.lit(0).cast("bigint")
            return F.struct(d.alias("stat_date"), count.alias("active"),
                            F.when(d == F.array_min(dates), count).otherwise(none).alias("new"),
                            F.when(F.array_contains(dates, F.date_sub(d, 1)), count).otherwise(none).alias("retained"))
        return F.transform(dates, of)

    # Only dates that differ, and the days after them, can change; the sum drops the rest.
    both = F.concat(marks(F.map_keys("dates"), 1), marks(F.col("before"), -1))
    people = changed_users.select(F.explode(both).alias("m")).groupBy("m.stat_date").agg(
        *[F.sum(f"m.{c}").alias(c) for c in ("active", "new", "retained")])
    sums = changes.groupBy(F.col("order_date").alias("stat_date")).agg(
        F.sum("n").alias("orders"), F.sum("amount").cast(AMOUNT).alias("amount"))
    zero = F.lit(0).cast("bigint")
    return sums.join(people, "stat_date", "full").select(
        "stat_date", F.coalesce("orders", zero).alias("orders"),
        F.coalesce("amount", F.lit(0).cast(AMOUNT)).alias("amount"),
        *[F.coalesce(c, zero).alias(c) for c in ("active", "new", "retained")])


def apply_trend(trend: DataFrame, change: DataFrame) -> DataFrame:
    """The trend's days after a change: one row per order date that has orders."""
    sums = [F.sum(c).alias(c) for c in ("orders", "active", "new", "retained")]
    added = trend.unionByName(change).groupBy("stat_date").agg(F.sum("amount").cast(AMOUNT).alias("amount"), *sums)
    return added.where("orders <> 0")


def user_totals(state: DataFrame) -> DataFrame:
    """One row per user for ``serving.behavior_rows``."""
    sums = F.map_values("categories")
    entries = F.transform(F.map_entries("categories"), lambda e: F.struct(
        (-e["value"]["n"]).alias("k1"), (-e["value"]["amount"]).alias("k2"), e["key"].alias("k3")))
    zero = F.lit(0).cast("bigint")
    return live(state).select(
        "user_id", F.aggregate(sums, zero, lambda s, x: s + x["n"]).alias("total_orders"),
        F.aggregate(sums, F.lit(0).cast(AMOUNT), lambda s, x: (s + x["amount"]).cast(AMOUNT))
        .cast("decimal(20,2)").alias("total_amount"),
        F.array_min(F.map_keys("dates")).alias("first_order_date"),
        F.array_max(F.map_keys("dates")).alias("last_order_date"),
        F.aggregate(sums, zero, lambda s, x: s + x["bad"]).alias("bad_orders"),
        F.array_min(entries)["k3"].alias("preferred_category"))


def trend_days(trend: DataFrame) -> DataFrame:
    """One row per day for ``serving.trend_rows``."""
    return trend.select("stat_date", F.col("orders").alias("total_orders"),
                        F.col("amount").cast("decimal(20,2)").alias("total_amount"), F.col("orders").alias("_n"),
                        F.col("active").alias("active_users"), F.col("new").alias("new_users"), "retained")
