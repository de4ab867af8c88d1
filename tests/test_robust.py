"""Streams over any file layout, reruns without lost or stale rows, totals that fit, and
the jobs from extract to catalog."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from laminar.operators import dims, quality
from laminar.operators.transforms import clean_orders
from laminar.plans import catalog, daily, jobs
from laminar.schemas import (ADS_SALES_TREND_ANALYSIS, DWD_ORDER_INFO, DWS_USER_DAILY_STATS, ODS_ORDER_INFO, ODS_USER_INFO,
                             TOTAL, conform)
from laminar.sinks.partitioned import land, write_frame, write_table
from laminar.sources.logs import MALFORMED, land_event_log, read_event_log
from laminar.sources.seed import SEED_DAY, seed_orders, seed_users
from laminar.sources.tables import read_table, table_path
from laminar.streaming.activity import daily_activity, latest_versions, run_daily_activity
from laminar.streaming.ingest import run_dedup_ingest
from laminar.streaming.source import LateRowsError


def rows(df):
    return sorted(map(tuple, df.collect()))


# ---------------------------------------------------------------- streams
@pytest.fixture(scope="module")
def many_files(spark):
    """The events as eight files in shuffled order, in a folder named like the table."""
    from laminar.session import new_area
    folder = new_area(spark, "events-many")
    events = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/events.parquet")
    events.repartition(8, F.xxhash64("event_id")).write.parquet(f"{folder}/events.parquet")
    return folder, events


def test_streams_do_not_depend_on_the_file_layout(spark, many_files):
    folder, events = many_files
    ingested = spark.read.parquet(run_dedup_ingest(spark, folder, copies=2))
    assert ingested.count() == events.count() == 10_000
    batch = daily_activity(events)
    streamed = latest_versions(spark, run_daily_activity(spark, folder))
    assert rows(streamed.select(*batch.columns)) == rows(batch)


def test_late_rows_fail_loudly(spark, many_files):
    folder, events = many_files
    with pytest.raises(LateRowsError):
        run_daily_activity(spark, folder, max_bytes_per_trigger=1)
    kept = latest_versions(spark, run_daily_activity(spark, folder, max_bytes_per_trigger=1, allow_late=True))
    assert kept.agg(F.sum("event_count")).first()[0] < events.count()


def test_no_batch_gives_an_empty_typed_frame(spark, area):
    none = latest_versions(spark, f"{area}/nothing")
    assert none.count() == 0 and dict(none.dtypes)["total_value"] == "decimal(22,2)"


# ---------------------------------------------------------------- reruns
@pytest.mark.parametrize("odd_day", [None, "2024-12-26 00:00", "2024-12-26T01:02:03"])
def test_backfill_keeps_what_it_wrote(spark, area, odd_day):
    orders = seed_orders(spark).withColumn("dt", F.when(F.col("order_id") == "O001", F.lit(odd_day)).otherwise(F.col("dt")))
    land(orders, area, ODS_ORDER_INFO)
    land(seed_users(spark), area, ODS_USER_INFO)
    for _ in range(2):
        written = daily.run(spark, area, daily.Days.every())
        assert written["dwd_order_info"] == 8 == read_table(spark, area, DWD_ORDER_INFO).count()


def test_nothing_is_deleted_without_an_observation(spark, area, monkeypatch):
    from laminar.sinks import partitioned
    land(seed_users(spark), area, ODS_USER_INFO)
    land(seed_orders(spark), area, ODS_ORDER_INFO)
    daily.run(spark, area, daily.Days.every())
    monkeypatch.setattr(partitioned, "_observed", lambda obs: {})
    daily.run(spark, area, daily.Days.every())
    assert read_table(spark, area, DWD_ORDER_INFO).count() == 8


def test_trend_leaves_no_stale_month(spark, area):
    def run(day):
        stamp = F.concat(F.lit(f"{day} "), F.substring("order_time", 12, 8))
        orders = seed_orders(spark).withColumn("order_time", stamp)
        land(orders.drop("dt"), area, ODS_ORDER_INFO, day=SEED_DAY)
        daily.run_daily(spark, area, SEED_DAY)
        daily.run_serving(spark, area, SEED_DAY)
        return read_table(spark, area, ADS_SALES_TREND_ANALYSIS).select(F.col("stat_date").cast("string"), "total_orders").collect()

    land(seed_users(spark), area, ODS_USER_INFO)
    assert list(map(tuple, run("2024-12-25"))) == [("2024-12-25", 8)]
    assert list(map(tuple, run("2025-01-05"))) == [("2025-01-05", 8)]


def test_findings_backfill_clears_resolved_days(spark, area):
    found = spark.createDataFrame([(d, "null_ratio", "t", "c", 0.5, 0.1, "WARN") for d in ("2024-01-01", "2024-01-02", "2024-02-01")],
                                  quality.FINDING_SCHEMA)
    path = jobs.persist_findings(found, area)
    jobs.persist_findings(found.where("check_date = '2024-01-02'"), area, day_range=("2024-01-01", "2024-01-31"))
    assert rows(jobs.read_findings(spark, path).select("check_date")) == [("2024-01-02",), ("2024-02-01",)]


def test_write_sizes_files_and_restores_the_session(spark, area):
    keys = ["spark.sql.adaptive.coalescePartitions.parallelismFirst", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    before = [spark.conf.get(k, None) for k in keys]
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        wide = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
        assert write_frame(wide, f"{area}/wide") == 400_000
        assert len(spark.read.parquet(f"{area}/wide").inputFiles()) <= 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [spark.conf.get(k, None) for k in keys] == before


# ---------------------------------------------------------------- totals
def test_large_days_fit(spark, area):
    orders = seed_orders(spark).drop("dt").withColumn("total_amount", F.lit(Decimal("30000000.00")).cast("decimal(10,2)"))
    land(seed_users(spark), area, ODS_USER_INFO)
    land(orders.withColumn("product_id", F.lit("P1")).withColumn("product_name", F.lit("one")), area, ODS_ORDER_INFO, day=SEED_DAY)
    daily.run_daily(spark, area, SEED_DAY)
    daily.run_serving(spark, area, SEED_DAY)
    assert read_table(spark, area, ADS_SALES_TREND_ANALYSIS).first()["total_amount"] == Decimal("240000000.00")
    assert dict(read_table(spark, area, DWS_USER_DAILY_STATS).dtypes)["total_amount"] == TOTAL.simpleString()


def test_overflow_raises_with_ansi_off(spark, area):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    big = seed_orders(spark).drop("dt").withColumn("total_amount", F.lit(Decimal("1234567890123.00")))
    with pytest.raises(Exception, match="(?i)out of range|cannot be represented|NUMERIC_VALUE"):
        land(big, area, ODS_ORDER_INFO, day=SEED_DAY)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert conform(seed_orders(spark), ODS_ORDER_INFO).count() == 8


# ---------------------------------------------------------------- lookups
def test_repeated_products_and_unknown_ones(spark):
    products = spark.createDataFrame([("P001", "B"), ("P001", "A"), ("P002", "C")], "product_id string, category_id string")
    detail = clean_orders(seed_orders(spark), products=products)
    assert detail.count() == 8
    by = {r["product_id"]: r["category_id"] for r in detail.collect()}
    assert by["P001"] == "A" and by["P002"] == "C" and by["P003"] == "OTHER"
    sales = {r["category_id"]: r for r in dims.sales_by_category(detail, products).collect()}
    assert sum(r["order_lines"] for r in sales.values()) == 8 and sales["OTHER"]["products"] == 5


def test_a_buyer_without_geography_stays_in_the_total(spark):
    geo = spark.createDataFrame([("U001", "EUROPE", "FRANCE")], "user_id string, region string, nation string")
    out = {(r["region"], r["nation"]): r for r in dims.sales_by_geography(clean_orders(seed_orders(spark)), geo).collect()}
    assert out[None, None]["order_lines"] == 8 and out["UNKNOWN", "UNKNOWN"]["order_lines"] == 6


def test_latest_user_version_wins(spark):
    u = [("u", "old", "2024-01-01", "2024-01-01", "2024-01-03"), ("u", "new", "2024-01-02", "2024-01-01", "2024-01-01"),
         ("u", "tie", "2024-01-02", "2024-01-01", "2024-01-02")]
    versions = spark.createDataFrame(u, "user_id string, username string, update_time string, create_time string, dt string")
    assert dims.latest_users(versions).first()["username"] == "tie"


def test_log_keeps_microseconds_and_malformed_text(spark, area):
    events = spark.sql("SELECT 1L AS event_id, TIMESTAMP '2024-01-01 00:00:00.123456' AS ts, 2L AS user_id, "
                       "'view' AS event_type, 1.5D AS value, '{}' AS props")
    path = land_event_log(events, f"{area}/log")
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(f"{path}/dt=2024-01-01")
    got = read_event_log(spark, path).orderBy("event_id").collect()
    assert got[1]["ts"].microsecond == 123456 and got[1][MALFORMED] is None
    assert got[0]["event_id"] is None and got[0][MALFORMED] == "not json"


def test_masked_digest_depends_on_the_salt(spark):
    users = seed_users(spark).withColumn("is_active", F.lit(True)).withColumn("user_level", F.lit("x"))
    plain, salted = (dims.masked_users(users, s).first()["email_sha256"] for s in ("", "secret"))
    assert plain != salted


# ---------------------------------------------------------------- jobs
def test_jobs_from_extract_to_catalog(spark, area):
    catalog.setup(spark, area, replace=True)
    written = jobs.extract(spark, area, SEED_DAY, {"ods_user_info": lambda s, d: seed_users(s).drop("dt"),
                                                   "ods_order_info": lambda s, d: seed_orders(s).drop("dt")})
    assert written == {"ods_user_info": 5, "ods_order_info": 8}
    logins = spark.createDataFrame([(SEED_DAY, "U001", 7)], "dt string, user_id string, login_count int")
    products = spark.createDataFrame([("P001", "PHONE")], "product_id string, category_id string")
    jobs.run_etl(spark, area, SEED_DAY, logins, products)
    assert spark.table(DWD_ORDER_INFO.qualified).count() == 8
    assert spark.table(DWD_ORDER_INFO.qualified).where("category_id = 'PHONE'").count() == 2
    assert spark.table(DWS_USER_DAILY_STATS.qualified).where("user_id = 'U001'").first()["login_count"] == 7
    with pytest.raises(ValueError):
        jobs.extract(spark, area, SEED_DAY, {"dwd_user_info": lambda s, d: seed_users(s)})


def test_command_line_takes_paths(spark, area):
    seed_users(spark).write.parquet(f"{area}/src/users")
    seed_orders(spark).write.parquet(f"{area}/src/orders")
    spark.createDataFrame([(SEED_DAY, "U002", 3)], "dt string, user_id string, login_count int").write.parquet(f"{area}/src/logins")
    at = ["--root", area, "--date", SEED_DAY]
    assert jobs.main(["extract", *at, "--users", f"{area}/src/users", "--orders", f"{area}/src/orders"]) == 0
    assert jobs.main(["etl", *at, "--logins", f"{area}/src/logins"]) == 0
    stats = read_table(spark, area, DWS_USER_DAILY_STATS, SEED_DAY)
    assert stats.where("user_id = 'U002'").first()["login_count"] == 3


def test_gate_reports_a_missing_table(spark, area):
    land(seed_users(spark), area, ODS_USER_INFO)
    land(seed_orders(spark), area, ODS_ORDER_INFO)
    rep = jobs.run_quality(spark, area, SEED_DAY).first()
    assert rep["overall_status"] == "FAIL" and rep["fail_count"] == 4 and rep["tables_checked"] == 2
    assert write_table(seed_users(spark), area, ODS_USER_INFO, SEED_DAY) == 5 and table_path(area, ODS_USER_INFO)
