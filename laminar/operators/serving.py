"""Serving layer (ADS): user behaviour analysis and daily sales trend.

Both read the order detail: distinct users do not add up across days, so the
daily summaries cannot serve them. Each reads the detail once. Orders are first
reduced to aggregated keys (user and category, or day and buyer), and any window
runs over those reduced rows only, so no window sorts a user's or a day's orders
in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.functions.rounding import half_up_units

# Fixed values of the behaviour model (ours): lifecycle day limits, risk shares,
# frequency window and cap (DECIMAL(5,2) holds at most 999.99).
NEW_WITHIN_DAYS = 30
ACTIVE_WITHIN_DAYS = 30
DORMANT_WITHIN_DAYS = 90
FREQUENCY_WINDOW_DAYS = 30
FREQUENCY_CAP_UNITS = 99999          # 999.99 in hundredths
RATE_CAP_UNITS = 99999               # 9.9999 in ten-thousandths (DECIMAL(5,4))


def _ts(value: str) -> Column:
    return F.lit(value).cast("timestamp")


def user_behavior(orders: DataFrame, as_of: str, bad_statuses: Sequence[str],
                  run_ts: str | None = None) -> DataFrame:
    """One row per user over detail orders dated on or before ``as_of``.

    ``preferred_category``: most orders, then larger amount, then smaller category id,
    taken with ``min(struct(-orders, -amount, category))``: a plain aggregate, so a
    heavy user is pre-aggregated map-side instead of sorted in one task.
    ``risk_level`` is the share of orders whose status is in ``bad_statuses``.
    """
    as_of_d = F.lit(as_of).cast("date")
    o = orders.where(F.col("order_date") <= as_of_d)
    per_cat = o.groupBy("user_id", "category_id").agg(
        F.count("order_id").alias("n"),
        F.sum("final_amount").alias("amt"),
        F.min("order_date").alias("first_d"),
        F.max("order_date").alias("last_d"),
        F.count_if(F.col("order_status").isin(*bad_statuses)).alias("bad"),
    )
    per_user = per_cat.groupBy("user_id").agg(
        F.sum("n").cast("bigint").alias("total_orders"),
        F.sum("amt").cast("decimal(20,2)").alias("total_amount"),
        F.min("first_d").alias("first_order_date"),
        F.max("last_d").alias("last_order_date"),
        F.sum("bad").cast("bigint").alias("bad_orders"),
        F.min(F.struct((-F.col("n")).alias("k1"), (-F.col("amt")).alias("k2"),
                       F.col("category_id").alias("k3"))).alias("_pref"),
    )
    return behavior_rows(per_user.withColumn("preferred_category", F.col("_pref.k3")), as_of, run_ts)


def behavior_rows(per_user: DataFrame, as_of: str, run_ts: str | None = None) -> DataFrame:
    """The serving rows from one row per user: ``total_orders, total_amount, first_order_date,
    last_order_date, bad_orders, preferred_category``."""
    as_of_d = F.lit(as_of).cast("date")
    n = F.col("total_orders")
    since_first = F.datediff(as_of_d, F.col("first_order_date"))
    since_last = F.datediff(as_of_d, F.col("last_order_date"))
    freq_units = F.least(half_up_units(n * FREQUENCY_WINDOW_DAYS, since_first + 1, 2), F.lit(FREQUENCY_CAP_UNITS))
    bad = F.col("bad_orders")
    return per_user.select(
        "user_id", "total_orders", "total_amount",
        (F.col("total_amount").cast("double") / n.cast("double")).alias("avg_order_amount"),
        "first_order_date", "last_order_date",
        (freq_units.cast("double") / F.lit(100.0)).alias("order_frequency"),
        F.when(since_first <= NEW_WITHIN_DAYS, "new")
         .when(since_last <= ACTIVE_WITHIN_DAYS, "active")
         .when(since_last <= DORMANT_WITHIN_DAYS, "dormant")
         .otherwise("churned").alias("user_lifecycle"),
        "preferred_category",
        F.when(bad * 2 > n, "high").when(bad * 5 > n, "medium").otherwise("low").alias("risk_level"),
        _ts(run_ts or f"{as_of} 00:00:00").alias("create_time"),
    )


def sales_trend(orders: DataFrame, run_ts: str) -> DataFrame:
    """One row per order day, partitioned by (year, month), from one pass over the orders.

    ``retention_rate`` = share of the previous *calendar* day's buyers who buy again;
    ``growth_rate`` = amount change on the previous calendar day. Both are NULL when
    that day has no orders, and the growth is NULL outside what DECIMAL(5,4) holds.

    Plan: orders are reduced to one row per (day, buyer) (partial aggregate
    map-side). A window per buyer over those rows marks the buyer's first day and
    days that follow a day with orders; a buyer has at most one row per calendar
    day, so no window partition grows with the number of orders, however skewed.
    A second aggregate gives one row per day, and the previous calendar day is read
    with a one-day RANGE frame over the day number. That frame has no partition key,
    but it runs over the per-day rows (at most one per calendar day), not over
    orders. A missing day leaves the frame empty (NULL), which ``lag`` would not.
    """
    o = orders.where(F.col("order_date").isNotNull())
    per_buyer_day = o.groupBy(F.col("order_date").alias("stat_date"), "user_id").agg(
        F.count("order_id").alias("_orders"),
        F.sum("final_amount").alias("_amount"),
        F.count("final_amount").alias("_amount_n"),
    )
    by_buyer = Window.partitionBy("user_id").orderBy("stat_date")
    flagged = per_buyer_day.select(
        "*",
        (F.row_number().over(by_buyer) == 1).alias("_first_day"),
        (F.lag("stat_date").over(by_buyer) == F.date_sub("stat_date", 1)).alias("_returned"),
    )
    daily = flagged.groupBy("stat_date").agg(
        F.sum("_orders").cast("bigint").alias("total_orders"),
        F.sum("_amount").cast("decimal(20,2)").alias("total_amount"),
        F.sum("_amount_n").alias("_n"),
        F.count(F.lit(1)).alias("active_users"),
        F.count_if("_first_day").alias("new_users"),
        F.count_if("_returned").alias("retained"),
    )
    return trend_rows(daily, run_ts)


def trend_rows(daily: DataFrame, run_ts: str) -> DataFrame:
    """The serving rows from one row per day: ``stat_date, total_orders, total_amount, _n``
    (amounts counted), ``active_users, new_users, retained``."""
    previous_day = Window.orderBy(F.unix_date("stat_date")).rangeBetween(-1, -1)
    j = daily.select("*", F.max("active_users").over(previous_day).alias("prev_users"),
                     F.max("total_amount").over(previous_day).alias("prev_amount"))
    cents = lambda c: (F.col(c) * 100).cast("bigint")  # noqa: E731 - exact: two decimal places
    retention_units = half_up_units(F.col("retained"), F.col("prev_users"), 4)
    growth_units = half_up_units(cents("total_amount") - cents("prev_amount"), cents("prev_amount"), 4)
    growth = F.when(F.abs(growth_units) <= RATE_CAP_UNITS, growth_units.cast("double") / F.lit(10000.0))
    return j.select(
        "stat_date",
        "total_orders",
        "total_amount",
        (F.col("total_amount").cast("double") / F.col("_n").cast("double")).alias("avg_order_amount"),
        F.col("new_users").cast("bigint").alias("new_users"),
        F.col("active_users").cast("bigint").alias("active_users"),
        (retention_units.cast("double") / F.lit(10000.0)).alias("retention_rate"),
        growth.alias("growth_rate"),
        _ts(run_ts).alias("create_time"),
        F.year("stat_date").alias("year"),
        F.month("stat_date").alias("month"),
    )
