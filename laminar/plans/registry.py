"""Registered warehouse queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one runs over the whole driver tables of the given scale. The DuckDB twin
of every query is in ``laminar.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from laminar.operators import reports
from laminar.plans.context import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

ORDER_PREVIEW_COLUMNS = ("order_id", "user_id", "product_name", "total_amount", "order_status")
USER_PREVIEW_COLUMNS = ("user_id", "username", "email", "status")


def _layer(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Warehouse(spark, sf_dir), name)
    run.__name__ = name
    return run


def preview_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five raw orders per day (the load-check preview), in a defined order."""
    return reports.preview_top_k(Warehouse(spark, sf_dir).ods_order_info, ORDER_PREVIEW_COLUMNS, 5)


def preview_users_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three raw users per day."""
    return reports.preview_top_k(Warehouse(spark, sf_dir).ods_user_info, USER_PREVIEW_COLUMNS, 3)


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = Warehouse(spark, sf_dir).staged(("dt", "order_id", "user_id", "product_id", "product_name", "total_amount"))
    return reports.layer_row_counts({
        "dwd_user_info": ("DWD", wh.dwd_user_info),
        "dwd_order_info": ("DWD", wh.dwd_order_info),
        "dws_user_daily_stats": ("DWS", wh.dws_user_daily_stats),
        "dws_product_daily_stats": ("DWS", wh.dws_product_daily_stats),
    })


# ---------------------------------------------------------------- data quality
# Accuracy bounds bound to the driver data (orders span 1995-2001; the default
# lower bound 2020-01-01 would flag every row).
DQ_AS_OF = "2001-01-01"
DQ_MIN_DATE = "1996-01-01"


def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import quality
    layers = Warehouse(spark, sf_dir).staged().layers()
    out = None
    for name in quality.CHECKED_TABLES:
        part = quality.completeness(layers[name], name)
        out = part if out is None else out.unionByName(part)
    return out


def dq_user_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import quality
    wh = Warehouse(spark, sf_dir)
    return quality.user_consistency(wh.ods_user_info, wh.dwd_user_info)


def dq_order_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import quality
    from laminar.operators.transforms import valid_order
    return quality.order_retention_one_pass(Warehouse(spark, sf_dir).ods_order_info, valid_order())


RECONCILED = ("product_id", "final_amount", "order_status")


def dq_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders lost, invented and changed between the detail layer and a copy of it with faults
    planted by a fixed rule in the orders of March days."""
    from pyspark.sql import functions as F
    from laminar.operators import reconcile
    from laminar.session import new_area
    from laminar.sinks.partitioned import write_frame
    detail = Warehouse(spark, sf_dir).dwd_order_info.select("dt", "order_id", *RECONCILED)
    path = new_area(spark, "reconciled-orders")
    write_frame(detail, path)
    detail = spark.read.schema(detail.schema).parquet(path)
    place = F.pmod(F.col("order_id").cast("bigint"), F.lit(97))
    march = F.substring("dt", 6, 2) == "03"
    copy = detail.where(~(march & (place == 7))).select(
        "dt", F.when(march & (place == 13), F.concat(F.lit("x"), F.col("order_id"))).otherwise(F.col("order_id")).alias("order_id"),
        "product_id", "final_amount", F.when(march & (place == 11), F.lit(None)).otherwise(F.col("order_status")).alias("order_status"))
    return reconcile.differences(detail, copy, "dt", ["order_id"], RECONCILED)


def dq_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import quality
    return quality.accuracy(Warehouse(spark, sf_dir).dwd_order_info, DQ_AS_OF, DQ_MIN_DATE)


def dq_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import quality
    return quality.findings(Warehouse(spark, sf_dir).staged().layers(), DQ_AS_OF, DQ_MIN_DATE)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import quality
    return quality.report(Warehouse(spark, sf_dir).staged().layers(), DQ_AS_OF, DQ_MIN_DATE)


def dq_findings_persisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings written as the findings table (partitioned by check day) and read back."""
    from laminar.operators import quality
    from laminar.plans.jobs import persist_findings, read_findings
    from laminar.session import new_area
    found = quality.findings(Warehouse(spark, sf_dir).staged().layers(), DQ_AS_OF, DQ_MIN_DATE)
    return read_findings(spark, persist_findings(found, new_area(spark, "dq")))


# ---------------------------------------------------------------- write path
def etl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every raw day, backfill detail + summary in one job per table, rerun the
    latest day, and read the four tables back by their catalog names as per-day row counts.

    The rerun must leave every count unchanged (idempotent, and other days kept), and the
    written days must be partitions of the catalog tables.
    """
    from pyspark.sql import functions as F

    from laminar.functions.rules import SCALE_CATEGORY_RULES
    from laminar.plans import catalog, daily
    from laminar.schemas import (DWD_ORDER_INFO, DWD_USER_INFO, DWS_PRODUCT_DAILY_STATS,
                                 DWS_USER_DAILY_STATS, ODS_ORDER_INFO, ODS_USER_INFO)
    from laminar.session import new_area
    from laminar.sinks import files
    from laminar.sinks.partitioned import land
    from laminar.sources.tables import read_table

    wh = Warehouse(spark, sf_dir)
    root = new_area(spark, "roundtrip")
    # Databases of this run alone: the session's own tables stay as they are.
    mine = f"roundtrip_{root.rsplit('-', 1)[-1]}_"
    catalog.create_tables(spark, root, mine)
    daily._concurrently(lambda: land(wh.ods_user_info, root, ODS_USER_INFO),
                        lambda: [land(part, root, ODS_ORDER_INFO) for part in wh.ods_order_parts(f"{root}/lines")])
    files.remove(spark, f"{root}/lines")          # the landed days hold its rows
    daily.run(spark, root, daily.Days.every(), SCALE_CATEGORY_RULES)
    latest = read_table(spark, root, ODS_ORDER_INFO).agg(F.max("dt")).first()[0]
    if latest is not None:
        daily.run_daily(spark, root, latest, category_rules=SCALE_CATEGORY_RULES)
    written = (DWD_USER_INFO, DWD_ORDER_INFO, DWS_USER_DAILY_STATS, DWS_PRODUCT_DAILY_STATS)
    catalog.register(spark, written, prefix=mine)
    back = {spec.name: spark.table(mine + spec.qualified) for spec in written}
    counts = reports.layer_row_counts({
        "dwd_user_info": ("DWD", back["dwd_user_info"]),
        "dwd_order_info": ("DWD", back["dwd_order_info"]),
        "dws_user_daily_stats": ("DWS", back["dws_user_daily_stats"]),
        "dws_product_daily_stats": ("DWS", back["dws_product_daily_stats"]),
    })
    found = materialised_counts(counts, root)
    catalog.drop_databases(spark, mine)           # the tables are external: no file goes with them
    return found


def materialised_counts(counts: DataFrame, root: str) -> DataFrame:
    """Counts written and read back, so that they outlive the catalog entries they came from."""
    from laminar.sinks.partitioned import write_frame
    write_frame(counts, f"{root}/counts")
    return counts.sparkSession.read.schema(counts.schema).parquet(f"{root}/counts")


# ---------------------------------------------------------------- tier B: serving and date dimension
LOGIN_SOURCE = "events"            # purchase events are orders, view events are logins
ADS_AS_OF = "2001-08-01"
ADS_BAD_STATUSES = ("P",)
ADS_RUN_TS = "2001-08-01 00:00:00"
TREND_RUN_TS = "2001-08-02 00:00:00"


def login_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily user statistics with logins, orders and logins both read from the events
    in one pass (``user_daily_stats_one_pass``)."""
    from pyspark.sql import functions as F

    from laminar.operators.aggregates import user_daily_stats_one_pass
    from laminar.sources import testdata
    activity = testdata.event_activity(Warehouse(spark, sf_dir).table(LOGIN_SOURCE))
    kind = F.col("event_type")
    return user_daily_stats_one_pass(activity, kind == "purchase", kind == "view")


def active_users_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct buyers per week and month, by category and over all, from stored bitmaps alone."""
    from laminar.operators import distinct
    return distinct.by_period(_stored_bitmaps(spark, sf_dir), "category_id")


def active_users_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct buyers of the seven days up to each day, from stored bitmaps alone."""
    from laminar.operators import distinct
    return distinct.trailing(_stored_bitmaps(spark, sf_dir), 7)


def _stored_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.plans import active_users
    from laminar.session import new_area
    root = new_area(spark, "active-users")
    active_users.update(spark, root, Warehouse(spark, sf_dir).dwd_order_info.select("dt", "category_id", "user_id"))
    return active_users.bitmaps(spark, root)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import dims
    return dims.date_dimension(dims.date_span(Warehouse(spark, sf_dir).dwd_order_info, "order_date"))


def ads_user_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import serving
    return serving.user_behavior(Warehouse(spark, sf_dir).dwd_order_info, ADS_AS_OF, ADS_BAD_STATUSES, ADS_RUN_TS)


def ads_sales_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import serving
    return serving.sales_trend(Warehouse(spark, sf_dir).dwd_order_info, TREND_RUN_TS)


def _applied_day_by_day(spark: SparkSession, sf_dir: str, daily_runs: int) -> tuple[str, DataFrame]:
    """A serving state under a fresh root: the history in one update, the last days one by one,
    and one old day applied again. Also the order detail it was made from."""
    from laminar.plans import incremental
    from laminar.session import new_area
    from laminar.sinks.partitioned import write_frame
    root = new_area(spark, "serving-state")
    columns = ["order_id", "user_id", "category_id", "order_date", "final_amount", "order_status", "dt"]
    orders = Warehouse(spark, sf_dir).dwd_order_info.select(*columns)
    write_frame(orders, f"{root}/detail", sort_by=("dt",))       # a day's update skips the other days' pages
    detail = spark.read.schema(orders.schema).parquet(f"{root}/detail")
    days = sorted(r["dt"] for r in detail.select("dt").distinct().collect())       # the calendar
    alone = days[-daily_runs:]
    options = {"bad_statuses": ADS_BAD_STATUSES, "buckets": 16}
    if days[:-daily_runs]:
        incremental.update(spark, root, detail, days[0], days[-daily_runs - 1], **options)
    for day in alone + days[len(days) // 2:len(days) // 2 + 1]:
        incremental.update(spark, root, detail, day, **options)
    return root, detail


def ads_user_behavior_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour table kept up by daily updates over the last 30 days of data."""
    from laminar.operators import serving
    from laminar.plans import incremental
    root, detail = _applied_day_by_day(spark, sf_dir, 30)
    if detail.isEmpty():
        return serving.user_behavior(detail, ADS_AS_OF, ADS_BAD_STATUSES, ADS_RUN_TS)
    return incremental.user_behavior(spark, root, ADS_RUN_TS, ADS_AS_OF)


def ads_sales_trend_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales trend kept up by daily updates over the last seven days of data."""
    from laminar.plans import incremental
    return incremental.sales_trend(spark, _applied_day_by_day(spark, sf_dir, 7)[0], TREND_RUN_TS)


def ads_sales_trend_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales trend written by month, first with every order a year later, then as it
    is: the rerun must leave no month of the first write."""
    from pyspark.sql import functions as F

    from laminar.operators import serving
    from laminar.schemas import ADS_SALES_TREND_ANALYSIS as SPEC
    from laminar.session import new_area
    from laminar.sinks.partitioned import write_table
    from laminar.sources.tables import read_table
    staged = Warehouse(spark, sf_dir).staged(("dt", "order_id", "user_id", "order_time", "total_amount"))
    orders, root = staged.dwd_order_info, new_area(spark, "trend")
    later = orders.withColumn("order_date", F.date_add("order_date", 366))
    for o in (later, orders):
        write_table(serving.sales_trend(o, TREND_RUN_TS), root, SPEC, dynamic=False)
    rates = [F.col(c).cast("double").alias(c) for c in ("retention_rate", "growth_rate")]
    return read_table(spark, root, SPEC).select("stat_date", "total_orders", "total_amount", "new_users", "active_users",
                                                *rates, "year", "month")


def orders_by_region_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail orders written as compressed ORC by month and region, read back and summed."""
    from pyspark.sql import functions as F

    from laminar.operators import dims
    from laminar.session import new_area
    from laminar.sinks.partitioned import write_frame
    wh = Warehouse(spark, sf_dir)
    geo = dims.geography(wh.table("customer"), wh.table("nation"), wh.table("region"))
    tagged = dims.orders_with_region(wh.dwd_order_info, geo).withColumn("month", F.date_format("order_date", "yyyy-MM"))
    path = new_area(spark, "orc")
    write_frame(tagged, path, ("month", "region"), fmt="orc", compression="zstd")
    back = spark.read.schema(tagged.schema).orc(path)
    return back.groupBy("month", "region").agg(F.count(F.lit(1)).alias("order_lines"),
                                               F.sum("final_amount").cast("decimal(20,2)").alias("total_amount"))


# ---------------------------------------------------------------- tier C: dimensions, fact, masking
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.functions.rules import SCALE_CATEGORY_RULES
    from laminar.operators import dims
    return dims.product_dimension(Warehouse(spark, sf_dir).table("part"), SCALE_CATEGORY_RULES)


def product_category_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail orders categorised through the product dimension, summed per category
    (the lookup runs at the product grain, after a per-product aggregate)."""
    from laminar.functions.rules import SCALE_CATEGORY_RULES
    from laminar.operators import dims
    wh = Warehouse(spark, sf_dir)
    dim = dims.product_dimension(wh.table("part"), SCALE_CATEGORY_RULES)
    return dims.sales_by_category(wh.dwd_order_info, dim)


def dwd_order_info_by_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order detail with its category looked up in the product dimension; the dimension
    lists every product twice, which must not multiply orders."""
    from laminar.operators.transforms import clean_orders
    wh = Warehouse(spark, sf_dir)
    dim = dim_product(spark, sf_dir)
    return clean_orders(wh.ods_order_info, products=dim.unionByName(dim))


def dwd_order_info_by_lookup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the dimension kept as a table bucketed by product, which the join does
    not shuffle. The table's catalog entry has a name of its own and goes with the query."""
    from laminar.operators import dims
    from laminar.operators.transforms import clean_orders
    from laminar.session import new_area
    wh = Warehouse(spark, sf_dir)
    dim = dim_product(spark, sf_dir)
    path = new_area(spark, "product-table")
    name = dims.write_lookup_table(dim.unionByName(dim), "laminar_lookup_" + path.rsplit("-", 1)[-1], path)
    out = clean_orders(wh.ods_order_info, lookup=name)
    spark.sql(f"DROP TABLE {name}")             # external: its files stay for the query
    return out


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import dims
    return dims.latest_users(Warehouse(spark, sf_dir).dwd_user_info)


USER_ATTRIBUTES = ("email", "status")


def dim_user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension with the validity of each version."""
    from laminar.operators import versions
    from laminar.sources import testdata
    wh = Warehouse(spark, sf_dir)
    return versions.validity(testdata.user_versions(wh.table("customer")), "user_id", "update_time", USER_ATTRIBUTES)


def orders_with_user_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail orders with the buyer's status and address at order time."""
    from laminar.operators import versions
    from laminar.session import new_area
    from laminar.sinks.partitioned import write_frame
    history, path = dim_user_history(spark, sf_dir), new_area(spark, "user-history")
    write_frame(history, path)
    orders = Warehouse(spark, sf_dir).dwd_order_info.select("order_id", "user_id", "product_id", "final_amount", "create_time")
    return versions.as_of(orders, spark.read.schema(history.schema).parquet(path), "user_id", "create_time", USER_ATTRIBUTES)


def geo_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import dims
    wh = Warehouse(spark, sf_dir)
    geo = dims.geography(wh.table("customer"), wh.table("nation"), wh.table("region"))
    return dims.sales_by_geography(wh.dwd_order_info, geo)


def fact_user_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import dims
    return dims.behavior_fact(Warehouse(spark, sf_dir).table("events"))


TEST_SALT = "a salt for the driver tables only"


def masked_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.operators import dims
    return dims.masked_users(Warehouse(spark, sf_dir).dwd_user_info, TEST_SALT)


def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every property of the events, from the fact written with its properties as VARIANT."""
    from laminar.operators import properties
    from laminar.session import new_area
    from laminar.sinks.partitioned import write_frame
    fact, path = properties.open_behavior_fact(Warehouse(spark, sf_dir).table("events")), new_area(spark, "open-fact")
    write_frame(fact.select("event_type", "props"), path)
    return properties.property_profile(spark.read.parquet(path))


TEST_KEYS = {"k1": b"0123456789abcdef0123456789abcdef", "k2": b"fedcba9876543210"}     # of the registered query only


def encrypted_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users written with encrypted contact fields and a join digest, the fields of half of them
    moved to another key, and all read back in plain."""
    from pyspark.sql import functions as F
    from laminar.functions.encryption import decrypt_field, encrypt_field, join_digest, rotate_field
    from laminar.session import new_area
    from laminar.sinks.partitioned import write_frame
    users, path = Warehouse(spark, sf_dir).dwd_user_info, new_area(spark, "encrypted-users")
    write_frame(users.select(
        "user_id", *[encrypt_field(F.col(c), TEST_KEYS["k1"], "k1").alias(c) for c in ("email", "phone")],
        join_digest(F.col("email"), TEST_KEYS["k1"]).alias("email_digest")), path)
    kept = spark.read.parquet(path)
    half = F.col("user_id").cast("bigint") % 2 == 0
    moved = kept.select("user_id", "email_digest", *[
        F.when(half, rotate_field(F.col(c), TEST_KEYS, "k2")).otherwise(F.col(c)).alias(c) for c in ("email", "phone")])
    return moved.select("user_id", "email_digest", F.substring_index("email", ":", 1).alias("email_key"),
                        *[decrypt_field(F.col(c), TEST_KEYS).alias(c) for c in ("email", "phone")])


def event_log_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as log files under the shared root, read back with the declared
    schema (no inference pass) and summarised per day and event type."""
    from laminar.session import new_area
    from laminar.sources.logs import daily_event_summary, land_event_log, read_event_log
    path = land_event_log(Warehouse(spark, sf_dir).table("events"), new_area(spark, "event-log"))
    return daily_event_summary(read_event_log(spark, path))


# ---------------------------------------------------------------- streaming
def stream_dedup_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered twice (at-least-once) and ingested once by the stream."""
    from laminar.streaming.ingest import run_dedup_ingest
    return spark.read.parquet(run_dedup_ingest(spark, sf_dir, copies=2))


def stream_user_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    from laminar.streaming.activity import latest_versions, run_daily_activity
    return latest_versions(spark, run_daily_activity(spark, sf_dir))


def _delivered(spark: SparkSession, sf_dir: str, copies: int, count: int) -> tuple[str, int]:
    """The events delivered ``copies`` times over ``count`` shuffled files of a new folder, and
    a byte bound that makes a batch of about a fifth of them."""
    from pyspark.sql import functions as F

    from laminar.session import new_area
    from laminar.sinks import files
    folder = new_area(spark, "collector")
    events = Warehouse(spark, sf_dir).table("events")
    again = events.withColumn("_copy", F.explode(F.array(*[F.lit(i) for i in range(copies)])))
    place = F.pmod(F.xxhash64("event_id", "_copy"), F.lit(count)).cast("int")
    dealt = again.repartitionById(count, place).drop("_copy")
    # Row groups of a few MB: a batch of one large file is read by many tasks.
    dealt.write.option("parquet.block.size", str(4 << 20)).parquet(f"{folder}/events.parquet")
    return folder, max(1, files.size(spark, f"{folder}/events.parquet") // 5)


def stream_ods_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases delivered twice over shuffled files, landed in the raw order table by
    several batches; the last batch's commit is lost, so it runs again. Rows per day."""
    from pyspark.sql import functions as F

    from laminar.schemas import ODS_ORDER_INFO
    from laminar.session import new_area
    from laminar.sinks import files
    from laminar.sources.tables import read_table
    from laminar.sources.testdata import raw_orders_from_purchases
    from laminar.streaming import landing
    folder, bound = _delivered(spark, sf_dir, copies=2, count=10)
    to = landing.Landing(new_area(spark, "stream-ods"), ODS_ORDER_INFO, "order_id")
    done = landing.run_landing(spark, folder, raw_orders_from_purchases, to, max_bytes_per_trigger=bound)
    commits = f"{to.area}/checkpoint/commits"
    for name in (str(max(done)), f".{max(done)}.crc"):
        files.remove(spark, f"{commits}/{name}")
    landing.run_landing(spark, folder, raw_orders_from_purchases, to, max_bytes_per_trigger=bound)
    landed = read_table(spark, to.root, ODS_ORDER_INFO)
    return landed.groupBy("dt").agg(F.count(F.lit(1)).alias("orders"), F.countDistinct("order_id").alias("order_ids"),
                                    F.sum("total_amount").cast("decimal(20,2)").alias("total_amount"))


def stream_user_daily_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily activity from shuffled files in several bounded batches, late rows included."""
    from laminar.session import new_area
    from laminar.streaming.activity import merged_activity, run_bounded_activity
    folder, bound = _delivered(spark, sf_dir, copies=1, count=8)
    out = new_area(spark, "stream-bounded")
    run_bounded_activity(spark, folder, out, max_bytes_per_trigger=bound)
    return merged_activity(spark, out)


def queries() -> dict[str, Query]:
    return {
        # raw, detail, summary
        "ods_user_info": _layer("ods_user_info"),
        "ods_order_info": _layer("ods_order_info"),
        "dwd_user_info": _layer("dwd_user_info"),
        "dwd_order_info": _layer("dwd_order_info"),
        "dws_user_daily_stats": _layer("dws_user_daily_stats"),
        "dws_product_daily_stats": _layer("dws_product_daily_stats"),
        "preview_top_k": preview_top_k,
        "preview_users_top_k": preview_users_top_k,
        "layer_row_counts": layer_row_counts,
        # data quality
        "dq_completeness": dq_completeness,
        "dq_user_consistency": dq_user_consistency,
        "dq_order_retention": dq_order_retention,
        "dq_reconciliation": dq_reconciliation,
        "dq_accuracy": dq_accuracy,
        "dq_findings": dq_findings,
        "dq_report": dq_report,
        "dq_findings_persisted": dq_findings_persisted,
        # write path
        "etl_roundtrip": etl_roundtrip,
        # tier B
        "login_count": login_count,
        "dim_date": dim_date,
        "ads_user_behavior": ads_user_behavior,
        "ads_sales_trend": ads_sales_trend,
        "ads_sales_trend_written": ads_sales_trend_written,
        "ads_user_behavior_incremental": ads_user_behavior_incremental,
        "ads_sales_trend_incremental": ads_sales_trend_incremental,
        "active_users_by_period": active_users_by_period,
        "active_users_trailing": active_users_trailing,
        # tier C
        "dim_product": dim_product,
        "product_category_sales": product_category_sales,
        "dim_user": dim_user,
        "dim_user_history": dim_user_history,
        "orders_with_user_as_of": orders_with_user_as_of,
        "dwd_order_info_by_dimension": dwd_order_info_by_dimension,
        "dwd_order_info_by_lookup_table": dwd_order_info_by_lookup_table,
        "orders_by_region_orc": orders_by_region_orc,
        "geo_rollup": geo_rollup,
        "fact_user_behavior": fact_user_behavior,
        "event_properties": event_properties,
        "masked_users": masked_users,
        "encrypted_users": encrypted_users,
        "event_log_daily": event_log_daily,
        # streaming
        "stream_dedup_ingest": stream_dedup_ingest,
        "stream_user_daily": stream_user_daily,
        "stream_user_daily_bounded": stream_user_daily_bounded,
        "stream_ods_landing": stream_ods_landing,
    }
