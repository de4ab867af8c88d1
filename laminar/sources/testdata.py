"""Driver tables (TPC-H-like parquet) bound to the raw-layer contracts.

The warehouse's raw layer is fed by an operational database. Here the operational
data is the driver's ``customer`` / ``orders`` / ``lineitem`` / ``part`` / ``events``
tables; the functions below derive the raw user and order records from them by a
fixed rule, including a deterministic share of dirty rows so that every cleaning
path runs. All work is Spark: scans with column pruning, joins and projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.schemas import MONEY

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the binding (see FIXTURES.md): base day for user records,
# modulus rules for dirty rows, market segment -> status.
USER_BASE_DAY = "1995-01-01"
USER_DAY_SPAN = 2000
SEGMENT_STATUS = (("BUILDING", "active"), ("MACHINERY", "vip"), ("AUTOMOBILE", "premium"),
                  ("FURNITURE", "inactive"))          # HOUSEHOLD and anything else -> NULL
USER_TIME_OF_DAY = "10:30:00"
VERSION_DAYS = 200
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown driver table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


def ods_users(customer: DataFrame) -> DataFrame:
    """Raw user records, one per customer, landed on their creation day (``dt``)."""
    k = F.col("c_custkey")
    base = F.date_add(F.lit(USER_BASE_DAY).cast("date"), (k % USER_DAY_SPAN).cast("int"))

    def stamp(days: int):
        return F.concat(F.date_format(F.date_add(base, days), DAY_FORMAT), F.lit(" " + USER_TIME_OF_DAY))

    seg = F.col("c_mktsegment")
    status = None
    for segment, value in SEGMENT_STATUS:
        status = F.when(seg == segment, value) if status is None else status.when(seg == segment, value)
    return customer.select(
        _null_when(k % 97 == 0, k.cast("string")).alias("user_id"),
        F.col("c_name").alias("username"),
        _null_when(k % 7 == 0, F.concat(F.col("c_name"), F.lit("@example.com"))).alias("email"),
        _null_when(k % 20 == 0, F.lpad(k.cast("string"), 11, "0")).alias("phone"),
        F.when(k % 101 == 0, F.lit("bad-date")).otherwise(stamp(0)).alias("register_time"),
        stamp(30).alias("last_login_time"),
        status.otherwise(F.lit(None)).alias("status"),
        stamp(0).alias("create_time"),
        stamp(30).alias("update_time"),
        F.date_format(base, DAY_FORMAT).alias("dt"),
    )


def user_versions(customer: DataFrame) -> DataFrame:
    """Versions of the user records: one to four per user, ``VERSION_DAYS`` apart from the day of the
    last login. The third changes the status, the fourth the address; the second repeats the first."""
    first = ods_users(customer)
    k = F.pmod(F.col("_key"), F.lit(4)).cast("int")
    i = F.col("_i")
    keyed = first.withColumn("_key", F.substring_index("username", "#", -1).cast("bigint"))
    each = keyed.select("*", F.explode(F.sequence(F.lit(0), k)).alias("_i"))
    return each.select(
        "user_id",
        F.when(i >= 3, F.concat("username", F.lit("@new.example.com"))).otherwise(F.col("email")).alias("email"),
        F.when(i >= 2, F.lit("suspended")).otherwise(F.col("status")).alias("status"),
        (F.col("update_time").cast("timestamp") + F.make_dt_interval(i * VERSION_DAYS)).alias("update_time"))


def ods_orders(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Raw order records: one per line item (lineitem ⨝ orders ⨝ part).

    Join strategy is left to the planner: ``orders`` and ``part`` grow with the
    data, so neither is forced into a broadcast; AQE converts a join to a
    broadcast only when the measured side is below the threshold.
    """
    return ods_orders_of_lines(order_lines(lineitem, orders), part)


def order_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items with their order (lineitem ⨝ orders), as the raw order records need them."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    od = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey).drop("o_orderkey")


def order_day() -> Column:
    """The day a line's raw order record lands on (the day part of the order time)."""
    return F.substring(F.date_format("o_orderdate", TS_FORMAT), 1, len(DAY_FORMAT))


def ods_orders_of_lines(lines: DataFrame, part: DataFrame) -> DataFrame:
    """Raw order records of ``order_lines`` and their parts."""
    pt = part.select("p_partkey", "p_name", "p_retailprice")
    j = lines.join(pt, lines.l_partkey == pt.p_partkey)
    okey, pkey = F.col("l_orderkey"), F.col("l_partkey")
    order_time = F.date_format("o_orderdate", TS_FORMAT)
    return j.select(
        _null_when((okey + pkey) % 101 == 0, okey.cast("string")).alias("order_id"),
        _null_when(F.col("o_custkey") % 97 == 0, F.col("o_custkey").cast("string")).alias("user_id"),
        pkey.cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(pkey % 59 == 0, F.lit(0)).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        F.when(pkey % 53 == 0, F.lit(0).cast(MONEY))
         .otherwise(F.col("l_extendedprice").cast(MONEY)).alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
        order_time.alias("order_time"),
        _null_when(F.col("o_orderstatus") == "P", F.date_format("l_shipdate", TS_FORMAT)).alias("payment_time"),
        order_time.alias("create_time"),
        order_day().alias("dt"),
    )


def load_ods(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "ods_user_info": ods_users(table(spark, sf_dir, "customer")),
        "ods_order_info": ods_orders(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"),
                                     table(spark, sf_dir, "part")),
    }


def typed_events(events: DataFrame) -> DataFrame:
    """Events with an instant-typed ``ts`` (parquet gives timestamp_ntz) and a day."""
    return events.select(
        "event_id", "user_id", "event_type", "value", "props",
        F.col("ts").cast("timestamp").alias("ts"),
        F.date_format("ts", DAY_FORMAT).alias("dt"),
    )


def orders_from_purchases(events: DataFrame) -> DataFrame:
    """``purchase`` events as detail orders (order id, user, amount, time, day)."""
    return event_activity(events).where(F.col("event_type") == "purchase").drop("event_type")


def logins_from_views(events: DataFrame) -> DataFrame:
    """``view`` events as logins, pre-aggregated to one row per (day, user)."""
    ev = typed_events(events).where(F.col("event_type") == "view")
    return (ev.groupBy("dt", F.col("user_id").cast("string").alias("user_id"))
              .agg(F.count(F.lit(1)).alias("login_count")))


def event_activity(events: DataFrame) -> DataFrame:
    """Events in the shape of detail orders, with their type kept (purchases are the
    orders, views the logins), for the one-pass daily user statistics."""
    ev = typed_events(events)
    return ev.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").cast(MONEY).alias("final_amount"),
        F.col("ts").alias("create_time"),
        "dt",
        "event_type",
    )


def raw_orders_from_purchases(events: DataFrame) -> DataFrame:
    """``purchase`` events as raw order records (contract columns, day) with their event time."""
    ev = typed_events(events).where(F.col("event_type") == "purchase")
    when, none = F.date_format("ts", TS_FORMAT), F.lit(None).cast("string")
    amount = F.col("value").cast(MONEY)
    return ev.select(
        F.col("event_id").cast("string").alias("order_id"), F.col("user_id").cast("string").alias("user_id"),
        none.alias("product_id"), none.alias("product_name"), F.lit(1).alias("quantity"), amount.alias("unit_price"),
        amount.alias("total_amount"), F.lit("completed").alias("order_status"), none.alias("payment_method"),
        when.alias("order_time"), none.alias("payment_time"), when.alias("create_time"), "dt", F.col("ts").alias("event_time"))
