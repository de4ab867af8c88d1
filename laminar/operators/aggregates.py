"""Detail -> summary (DWD -> DWS): per-user and per-product daily statistics.

Every aggregate is keyed by ``dt`` as well, so one job computes any number of
days. Spark plans a partial (map-side) aggregate before the shuffle, so a hot
user or product sends one partial row per map task, not its raw rows. The
distinct-user count shuffles on (keys, user_id) first, which spreads a hot
product over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _mean(sum_col: str, count_col: str):
    """Exact decimal sum divided once as a double (the same value on every engine)."""
    return F.col(sum_col).cast("double") / F.col(count_col).cast("double")


def user_daily_stats(orders: DataFrame, logins: DataFrame | None = None) -> DataFrame:
    """One row per (day, user) with orders.

    ``logins`` (``dt, user_id, login_count``, one row per key) is left-joined;
    absent logins count 0. Without a login source the count stays 0. Both sides are
    aggregated to the (dt, user_id) grain before the join, and the join reuses the
    aggregate's hash partitioning, so it adds no shuffle of its own.
    """
    stats = orders.groupBy("dt", "user_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("final_amount").alias("total_amount"),
        F.count("final_amount").alias("_amount_n"),
        F.min("create_time").alias("first_order_time"),
        F.max("create_time").alias("last_order_time"),
    )
    if logins is not None:
        stats = stats.join(logins.select("dt", "user_id", "login_count"), ["dt", "user_id"], "left")
        login_count = F.coalesce(F.col("login_count").cast("bigint"), F.lit(0).cast("bigint"))
    else:
        login_count = F.lit(0).cast("bigint")
    return _user_stats(stats, login_count)


def user_daily_stats_one_pass(activity: DataFrame, is_order: Column, is_login: Column) -> DataFrame:
    """The same rows as ``user_daily_stats(orders, logins)`` when orders and logins are
    rows of one table (``dt, user_id, order_id, final_amount, create_time``), told
    apart by ``is_order`` and ``is_login``.

    One conditional aggregate per (day, user) replaces two aggregates and their join,
    so the table is read once. A (day, user) is kept when it has an order row.
    """
    order = lambda c: F.when(is_order, F.col(c))
    stats = activity.where(is_order | is_login).groupBy("dt", "user_id").agg(
        F.count_if(is_order).alias("_order_rows"),
        F.count(order("order_id")).alias("order_count"),
        F.sum(order("final_amount")).alias("total_amount"),
        F.count(order("final_amount")).alias("_amount_n"),
        F.min(order("create_time")).alias("first_order_time"),
        F.max(order("create_time")).alias("last_order_time"),
        F.count_if(is_login).alias("login_count"),
    ).where(F.col("_order_rows") > 0)
    return _user_stats(stats, F.col("login_count").cast("bigint"))


def _user_stats(stats: DataFrame, login_count: Column) -> DataFrame:
    return stats.select(
        "user_id",
        login_count.alias("login_count"),
        "order_count",
        "total_amount",
        _mean("total_amount", "_amount_n").alias("avg_order_amount"),
        "first_order_time", "last_order_time",
        F.col("dt").cast("date").alias("stat_date"),
        "dt",
    )


def product_daily_stats(orders: DataFrame) -> DataFrame:
    """One row per (day, product, name, category)."""
    stats = orders.groupBy("dt", "product_id", "product_name", "category_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.sum("final_amount").alias("total_amount"),
        F.sum("unit_price").alias("_price_sum"),
        F.count("unit_price").alias("_price_n"),
        F.countDistinct("user_id").alias("unique_users"),
    )
    return stats.select(
        "product_id", "product_name", "category_id", "order_count", "total_quantity",
        "total_amount",
        _mean("_price_sum", "_price_n").alias("avg_price"),
        "unique_users",
        F.col("dt").cast("date").alias("stat_date"),
        "dt",
    )
