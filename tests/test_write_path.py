"""Write path: partition overwrite idempotence, other days kept, DDL, JDBC source."""

import pytest
from pyspark.sql import functions as F

from laminar.plans import catalog, daily
from laminar.schemas import (DWD_ORDER_INFO, DWD_USER_INFO, DWS_PRODUCT_DAILY_STATS, DWS_USER_DAILY_STATS,
                             ODS_ORDER_INFO, ODS_USER_INFO, TABLES)
from laminar.sinks.partitioned import land
from laminar.sources.jdbc import read_jdbc
from laminar.sources.seed import SEED_DAY, seed_orders, seed_users
from laminar.sources.tables import read_table

SECOND_DAY = "2024-12-27"
OUT_TABLES = (DWD_USER_INFO, DWD_ORDER_INFO, DWS_USER_DAILY_STATS, DWS_PRODUCT_DAILY_STATS)


def counts(spark, root):
    return {(s.name, r.dt): r["count"] for s in OUT_TABLES
            for r in read_table(spark, root, s).groupBy("dt").count().collect()}


def test_rerun_is_idempotent_and_keeps_other_days(spark, area):
    assert land(seed_users(spark), area, ODS_USER_INFO) == 5
    assert land(seed_orders(spark), area, ODS_ORDER_INFO) == 8
    written = daily.run_daily(spark, area, SEED_DAY)
    assert written == {"dwd_user_info": 5, "dwd_order_info": 8, "dws_user_daily_stats": 5,
                       "dws_product_daily_stats": 7}
    first = counts(spark, area)
    daily.run_daily(spark, area, SEED_DAY)                       # rerun the same day
    assert counts(spark, area) == first
    # a second day (same rows restamped) must not erase the first
    land(seed_users(spark).drop("dt"), area, ODS_USER_INFO, day=SECOND_DAY)
    land(seed_orders(spark).drop("dt"), area, ODS_ORDER_INFO, day=SECOND_DAY)
    daily.run_daily(spark, area, SECOND_DAY)
    after = counts(spark, area)
    assert {k: v for k, v in after.items() if k[1] == SEED_DAY} == first
    assert after[("dwd_order_info", SECOND_DAY)] == 8
    # written detail keeps the contract's types and a STRING day
    d = read_table(spark, area, DWD_ORDER_INFO, SEED_DAY)
    assert dict(d.dtypes)["final_amount"] == "decimal(10,2)" and dict(d.dtypes)["dt"] == "string"
    s = read_table(spark, area, DWS_USER_DAILY_STATS, SEED_DAY)
    assert dict(s.dtypes)["avg_order_amount"] == "decimal(10,2)"


def test_rerun_of_a_day_that_became_empty_clears_it(spark, area):
    """Re-landing a day whose orders are now all invalid empties that day's detail and
    summaries (no stale rows from the first run), and leaves other days alone."""
    land(seed_users(spark), area, ODS_USER_INFO)
    land(seed_orders(spark), area, ODS_ORDER_INFO)
    daily.run_daily(spark, area, SEED_DAY)
    land(seed_orders(spark).drop("dt"), area, ODS_ORDER_INFO, day=SECOND_DAY)
    daily.run_daily(spark, area, SECOND_DAY)
    invalid = seed_orders(spark).drop("dt").withColumn("total_amount", F.lit(0).cast("decimal(10,2)"))
    land(invalid, area, ODS_ORDER_INFO, day=SEED_DAY)
    written = daily.run_daily(spark, area, SEED_DAY)
    assert written["dwd_order_info"] == 0 and written["dws_product_daily_stats"] == 0
    after = counts(spark, area)
    assert ("dwd_order_info", SEED_DAY) not in after and ("dws_user_daily_stats", SEED_DAY) not in after
    assert after[("dwd_order_info", SECOND_DAY)] == 8 and after[("dwd_user_info", SEED_DAY)] == 5


def test_backfill_clears_days_that_became_empty(spark, area):
    """A range run replaces its days; a day of the range that now has no valid order
    loses its old detail and summaries; a day outside the range is left alone."""
    third = "2024-12-28"
    land(seed_users(spark), area, ODS_USER_INFO)
    for d in (SEED_DAY, SECOND_DAY, third):
        land(seed_orders(spark).drop("dt"), area, ODS_ORDER_INFO, day=d)
    daily.run(spark, area, daily.Days.every())
    invalid = seed_orders(spark).drop("dt").withColumn("total_amount", F.lit(0).cast("decimal(10,2)"))
    land(invalid, area, ODS_ORDER_INFO, day=SECOND_DAY)
    written = daily.run(spark, area, daily.Days(SEED_DAY, SECOND_DAY))
    assert written["dwd_order_info"] == 8
    after = counts(spark, area)
    for table in ("dwd_order_info", "dws_user_daily_stats", "dws_product_daily_stats"):
        assert (table, SECOND_DAY) not in after
        assert (table, SEED_DAY) in after and (table, third) in after
    assert after[("dwd_user_info", SEED_DAY)] == 5


def test_day_read_is_partition_pruned(spark, area):
    land(seed_orders(spark), area, ODS_ORDER_INFO)
    plan = read_table(spark, area, ODS_ORDER_INFO).where(F.col("dt") == SEED_DAY)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert read_table(spark, area, ODS_ORDER_INFO, "1999-01-01").count() == 0   # absent day -> empty


def test_bad_run_date_raises(spark, area):
    with pytest.raises(ValueError):
        daily.run_daily(spark, area, "2024-02-30")


def test_ddl_creates_layers_and_tables(spark, area):
    created = catalog.create_tables(spark, area)
    assert len(created) == 9
    dbs = catalog.list_databases(spark)
    for db in ("ods_enterprise", "dwd_enterprise", "dws_enterprise", "ads_enterprise", "dim_enterprise"):
        assert db in dbs
    cols = [c.name for c in spark.catalog.listColumns("dwd_enterprise.dwd_order_info")]
    assert cols == DWD_ORDER_INFO.columns + ["dt"]
    assert [c.name for c in spark.catalog.listColumns("ads_enterprise.ads_sales_trend_analysis")][-2:] == \
        ["year", "month"]
    assert set(TABLES) >= {"dim_date"}


def test_jdbc_partitioned_extract(spark):
    url = "jdbc:derby:memory:laminar_src;create=true"
    driver = "org.apache.derby.jdbc.EmbeddedDriver"
    src = spark.range(1, 1001).select(F.col("id").alias("ID"), (F.col("id") % 7).alias("V"))
    src.write.mode("overwrite").option("driver", driver).jdbc(url, "SRC_T")
    df = read_jdbc(spark, url, "SRC_T", driver=driver, partition_column="ID", lower_bound=1,
                   upper_bound=1000, num_partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 1000 and df.agg(F.sum("V")).first()[0] == sum(i % 7 for i in range(1, 1001))
    with pytest.raises(ValueError):
        read_jdbc(spark, url, "SRC_T", driver=driver, partition_column="ID")
