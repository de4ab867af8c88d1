"""Dimensions, the behaviour fact, and masked serving of user data.

Broadcast is explicit only for tables whose size is fixed by definition (the 25
nations and 5 regions). Product and customer dimensions grow with the data, so
their joins are left to the planner: AQE broadcasts them when their measured size
is under the threshold and sort-merges them otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.functions.masking import hash_email, mask_phone
from laminar.functions.rules import DEFAULT_CATEGORY, keyword_classifier
from laminar.schemas import MONEY
from laminar.session import new_area
from laminar.sinks.partitioned import write_frame

# Fixed values (ours): fixed-date public holidays as MM-dd, used when no holiday
# calendar is supplied: New Year's Day, Labour Day, National Day.
FIXED_HOLIDAYS = ("01-01", "05-01", "10-01")

# Meteorological seasons by month.
SEASONS = (((3, 4, 5), "spring"), ((6, 7, 8), "summer"), ((9, 10, 11), "autumn"))
WINTER = "winter"


def date_dimension(days: DataFrame, holidays: DataFrame | None = None,
                   fixed_holidays: Sequence[str] = FIXED_HOLIDAYS) -> DataFrame:
    """One row per date in ``days`` (a frame with a DATE column ``full_date``).

    ``week`` is the ISO week, ``weekday`` runs 1 = Monday ... 7 = Sunday. A date is a
    holiday when it is in ``holidays`` (column ``holiday_date``) or, without that
    frame, when its month-day is one of ``fixed_holidays``.
    """
    d = F.col("full_date")
    weekday = (F.weekday(d) + 1).cast("int")
    season = None
    for months, name in SEASONS:
        cond = F.month(d).isin(*months)
        season = F.when(cond, name) if season is None else season.when(cond, name)
    base = days.select("full_date")
    if holidays is not None:
        hol = holidays.select(F.col("holiday_date").alias("full_date")).distinct() \
                      .withColumn("_holiday", F.lit(True))
        base = base.join(hol, "full_date", "left")
        is_holiday = F.coalesce(F.col("_holiday"), F.lit(False))
    else:
        is_holiday = F.date_format(d, "MM-dd").isin(*fixed_holidays)
    return base.select(
        F.date_format(d, "yyyyMMdd").alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.weekofyear(d).alias("week"), F.dayofmonth(d).alias("day"),
        weekday.alias("weekday"),
        (weekday >= 6).alias("is_weekend"),
        is_holiday.alias("is_holiday"),
        season.otherwise(WINTER).alias("season"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("weekday_name"),
    )


def date_span(dates: DataFrame, column: str) -> DataFrame:
    """Every calendar day between the min and max of ``column`` (one aggregate row
    exploded into days; the row count is the calendar span, not the data size)."""
    lo, hi = F.min(column), F.max(column)
    return (dates.agg(lo.alias("lo"), hi.alias("hi"))
                 .where(F.col("lo").isNotNull())
                 .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date")))


def product_dimension(part: DataFrame, category_rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Product dimension from the part master, with the rule-derived category."""
    return part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        keyword_classifier("p_name", category_rules).alias("category_id"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_type"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").cast(MONEY).alias("list_price"),
    )


def one_row_per_product(products: DataFrame) -> DataFrame:
    """``(product_id, category_id)`` with each product once: of repeated rows the one with
    the least category, so a lookup never multiplies orders."""
    return products.groupBy("product_id").agg(F.min("category_id").alias("category_id"))


def written_lookup(products: DataFrame) -> DataFrame:
    """``one_row_per_product`` written under the shared root and read back.

    With the aggregate in the join's own stage, no exchange stands directly below the join on
    that side, and AQE cannot split a hot product's orders. Read from files, the dimension
    has its own exchange and the split works.
    """
    lookup = one_row_per_product(products)
    path = new_area(products.sparkSession, "product-lookup")
    write_frame(lookup, path)
    return products.sparkSession.read.schema(lookup.schema).parquet(path)


def write_lookup_table(products: DataFrame, name: str, path: str, buckets: int | None = None) -> str:
    """The deduplicated dimension as a catalog table bucketed by product: joins with it do not
    shuffle it. There are as many buckets as shuffle partitions (fewer would be shuffled again).
    """
    spark = products.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One task per bucket, so one file per bucket.
    rows = one_row_per_product(products).repartition(buckets, "product_id")
    (rows.write.bucketBy(buckets, "product_id").sortBy("product_id").mode("overwrite").option("path", path)
     .saveAsTable(name))
    return name


HOT_SHARE = 0.001             # of the orders; fewer than 1 / HOT_SHARE products can hold more
SPREAD = 1024                 # places for the rows of hot products and of none


def hot_products(orders: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """Products that hold more than ``share`` of the orders: fewer than ``1 / share`` rows."""
    per_product = orders.where("product_id IS NOT NULL").groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    least = int(share * orders.count())
    return per_product.where(F.col("n") > least).select("product_id")


def with_category(orders: DataFrame, lookup: DataFrame, share: float = HOT_SHARE, into: str = "_dim_category") -> DataFrame:
    """``orders`` with the product's category (NULL if it has none), ``lookup`` being a bucketed
    dimension that is not shuffled.

    A join whose one side is bucketed cannot be split by AQE, so the rows of hot products are
    taken out of it: they get their category from a broadcast of those products (fewer than
    ``1 / share``), and in the join they carry a key of their own that matches nothing and
    spreads them. Orders without a product are spread the same way.
    """
    spark = orders.sparkSession
    hot = hot_products(orders, share).join(lookup, "product_id").select("product_id", F.col("category_id").alias("_hot"))
    path = new_area(spark, "hot-products")
    write_frame(hot, path)
    hot = spark.read.schema(hot.schema).parquet(path)
    tagged = orders.join(F.broadcast(hot), "product_id", "left")
    apart = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*[F.col(c) for c in orders.columns]), F.lit(SPREAD)).cast("string"))
    keyed = tagged.withColumn("_key", F.when(F.col("_hot").isNotNull() | F.col("product_id").isNull(), apart)
                              .otherwise(F.col("product_id")))
    dim = lookup.select(F.col("product_id").alias("_key"), F.col("category_id").alias("_cold"))
    joined = keyed.join(dim, "_key", "left")
    return joined.select(*orders.columns, F.coalesce("_hot", "_cold").alias(into))


def sales_by_category(dwd_orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines, amount and products per category, the category looked up in the
    product dimension ``(product_id, category_id)``; a product not in it is OTHER.

    Orders are reduced to one row per product first (partial aggregate map-side),
    so the lookup joins products to products: a product holding a large share of the
    orders does not skew it, and the join does not grow with the orders.
    """
    per_product = dwd_orders.groupBy("product_id").agg(
        F.count("order_id").alias("_lines"), F.sum("final_amount").alias("_amount"))
    looked_up = per_product.join(one_row_per_product(products), "product_id", "left")
    return looked_up.groupBy(F.coalesce("category_id", F.lit(DEFAULT_CATEGORY)).alias("category_id")).agg(
        F.sum("_lines").cast("bigint").alias("order_lines"),
        F.sum("_amount").cast("decimal(20,2)").alias("total_amount"),
        F.count("product_id").alias("products"),
    )


USER_VERSION_ORDER = ("update_time", "create_time", "dt")


def latest_users(dwd_users: DataFrame) -> DataFrame:
    """Current row per user: latest update_time, then create_time, then day.

    ``max(struct(order keys..., other columns...))`` is an ordinary aggregate with a
    map-side partial step, so a user with very many versions is reduced before the
    shuffle instead of sorted inside one task.
    """
    rest = [c for c in dwd_users.columns if c not in ("user_id",) + USER_VERSION_ORDER]
    keys = [c for c in USER_VERSION_ORDER if c in dwd_users.columns]
    latest = dwd_users.groupBy("user_id").agg(F.max(F.struct(*keys, *rest)).alias("_v"))
    return latest.select("user_id", *[F.col(f"_v.{c}").alias(c) for c in rest + keys])


def geography(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customer -> nation -> region. Nation and region have a fixed size (25 and 5 rows)."""
    geo = (nation.select("n_nationkey", "n_name", "n_regionkey")
                 .join(F.broadcast(region.select("r_regionkey", "r_name")),
                       F.col("n_regionkey") == F.col("r_regionkey")))
    return (customer.select(F.col("c_custkey").cast("string").alias("user_id"), "c_nationkey")
                    .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
                    .select("user_id", F.col("r_name").alias("region"), F.col("n_name").alias("nation")))


def sales_by_geography(dwd_orders: DataFrame, geo: DataFrame) -> DataFrame:
    """Order lines, amount and buyers by region and nation, with region subtotals and
    a grand total (ROLLUP); ``grouping_level`` = grouping_id(region, nation).

    Orders are reduced to one row per buyer before the geography join (partial
    aggregate map-side), so a buyer holding a large share of the orders neither
    skews the join nor reaches it row by row. A buyer has one geography row, so the
    buyer count of a group is a plain count of these rows: no distinct count runs
    under the ROLLUP (which would expand every detail row once per grouping set).
    """
    per_buyer = dwd_orders.groupBy("user_id").agg(
        F.count("order_id").alias("_lines"), F.sum("final_amount").alias("_amount"))
    known = per_buyer.join(geo, "user_id", "left")          # a buyer without geography stays, as UNKNOWN
    place = [F.coalesce(c, F.lit("UNKNOWN")).alias(c) for c in ("region", "nation")]
    by_nation = known.groupBy(*place).agg(
        F.sum("_lines").alias("_lines"), F.sum("_amount").alias("_amount"), F.count(F.lit(1)).alias("_buyers"))
    # The ROLLUP expands its input once per grouping set; here that input is one
    # row per nation, not per order or buyer.
    return by_nation.rollup("region", "nation").agg(
        F.sum("_lines").cast("bigint").alias("order_lines"),
        F.sum("_amount").cast("decimal(20,2)").alias("total_amount"),
        F.sum("_buyers").cast("bigint").alias("buyers"),
        F.grouping_id().cast("bigint").alias("grouping_level"),
    )


def orders_with_region(dwd_orders: DataFrame, geo: DataFrame) -> DataFrame:
    """Detail orders tagged with the buyer's region (to partition by day and region)."""
    return dwd_orders.join(geo.select("user_id", "region"), "user_id", "left") \
                     .withColumn("region", F.coalesce("region", F.lit("UNKNOWN")))


PROPS_SCHEMA = "k INT"


def behavior_fact(events: DataFrame) -> DataFrame:
    """User-behaviour fact: typed events with their JSON properties parsed."""
    props = F.from_json("props", PROPS_SCHEMA)
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        ts.alias("event_ts"),
        F.to_date(ts).alias("event_date"),
        "value",
        props.getField("k").alias("prop_k"),
        F.date_format(ts, "yyyy-MM-dd").alias("dt"),
    )


def masked_users(dwd_users: DataFrame, salt: str) -> DataFrame:
    """Users with the e-mail replaced by its SHA-256 and the phone masked to its last 4.
    There is no default salt: without a secret one the digest of a guessed address is known."""
    return dwd_users.select(
        "user_id", "username",
        hash_email("email", salt).alias("email_sha256"),
        mask_phone("phone").alias("phone_masked"),
        "status", "is_active", "user_level", "dt",
    )
