"""Large ranges in passes of whole days, and shuffle files that go with their write."""

import os
import time

from pyspark.sql import functions as F

from laminar.plans import daily
from laminar.plans.context import Warehouse
from laminar.schemas import (DWD_ORDER_INFO, DWS_PRODUCT_DAILY_STATS, DWS_USER_DAILY_STATS, ODS_ORDER_INFO,
                             ODS_USER_INFO)
from laminar.session import local_path
from laminar.sinks import partitioned
from laminar.sinks.partitioned import day_bucket, day_passes, land, write_range
from laminar.sources.seed import seed_orders, seed_users
from laminar.sources.tables import read_table


def multiset(df):
    return sorted(map(str, df.collect()))


def test_passes_by_bytes():
    assert [day_passes(n) for n in (0, 1, partitioned.PASS_BYTES, partitioned.PASS_BYTES + 1, 1 << 50)] == \
        [1, 1, 1, 2, partitioned.MAX_PASSES]


def test_a_range_in_passes_writes_each_day_once_and_clears_the_others(spark, area):
    rows = spark.range(60).selectExpr("id", "IF(id % 10 = 0, NULL, concat('2024-03-0', id % 10)) AS dt")
    write_range(rows.withColumn("dt", F.coalesce("dt", F.lit("2024-03-20"))), f"{area}/t", "dt")
    assert write_range(rows, f"{area}/t", "dt", passes=4) == 60
    back = spark.read.schema("id bigint, dt string").parquet(f"{area}/t")
    assert multiset(back) == multiset(rows)                      # 2024-03-20 is gone, NULL days are kept
    kept = rows.where("dt < '2024-03-04' OR dt IS NULL")
    assert write_range(kept, f"{area}/t", "dt", (None, "2024-03-05"), passes=4) == kept.count()
    days = {r["dt"] for r in back.sparkSession.read.schema(back.schema).parquet(f"{area}/t").select("dt").distinct().collect()}
    assert days == {None, *(f"2024-03-0{d}" for d in (1, 2, 3, 6, 7, 8, 9))}
    buckets = rows.select("dt", day_bucket(F.col("dt"), 4).alias("b")).distinct()
    assert buckets.count() == 10 and buckets.where("b BETWEEN 0 AND 3").count() == 10


def test_a_backfill_in_passes_makes_the_same_tables(spark, area, monkeypatch):
    made = {}
    for name, size in (("one", 1 << 40), ("many", 1)):
        monkeypatch.setattr(partitioned, "PASS_BYTES", size)
        root = f"{area}/{name}"
        land(seed_users(spark), root, ODS_USER_INFO)
        for d in ("2024-12-26", "2024-12-27", "2024-12-28"):
            land(seed_orders(spark).drop("dt"), root, ODS_ORDER_INFO, day=d)
        passes, write = [], partitioned._write
        monkeypatch.setattr(partitioned, "_write", lambda *a, **k: (passes.append(a[1]), write(*a, **k))[1])
        counts = daily.run(spark, root, daily.Days.every())
        monkeypatch.setattr(partitioned, "_write", write)
        made[name] = (counts, [multiset(read_table(spark, root, s)) for s in
                               (DWD_ORDER_INFO, DWS_USER_DAILY_STATS, DWS_PRODUCT_DAILY_STATS)])
        per_table = {s.name: sum(p.endswith(s.name) for p in passes) for s in (DWS_USER_DAILY_STATS, DWS_PRODUCT_DAILY_STATS)}
        assert set(per_table.values()) == {1 if name == "one" else partitioned.MAX_PASSES}
    assert made["one"] == made["many"]


def test_the_shuffle_files_of_a_table_write_go_with_it(spark, area):
    def shuffled():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}
    before = shuffled()
    rows = seed_orders(spark)
    land(rows, area, ODS_ORDER_INFO)
    until = time.time() + 20
    while shuffled() - before and time.time() < until:           # they are removed behind the write
        time.sleep(0.2)
    assert not shuffled() - before
    assert read_table(spark, area, ODS_ORDER_INFO).count() == rows.count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_raw_orders_in_parts_are_the_raw_orders(spark, area, monkeypatch):
    """Also with orders that occur twice, orders without a day and keys that are NULL."""
    sf = f"{area}/sf"
    spark.range(200).selectExpr(
        "IF(id = 7, NULL, id % 40) AS l_orderkey", "id % 11 AS l_partkey", "CAST(id % 5 AS double) AS l_quantity",
        "CAST(id + 1 AS double) AS l_extendedprice", "CAST('2024-03-01' AS timestamp_ntz) AS l_shipdate").write.parquet(f"{sf}/lineitem.parquet")
    spark.range(42).selectExpr(
        "IF(id = 41, NULL, IF(id = 40, 3, id)) AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "'1-URGENT' AS o_orderpriority",
        "IF(id % 9 = 0, NULL, CAST(concat('2024-03-0', 1 + id % 8, ' 10:00:00') AS timestamp_ntz)) AS o_orderdate").write.parquet(f"{sf}/orders.parquet")
    spark.range(10).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "CAST(id AS double) AS p_retailprice").write.parquet(f"{sf}/part.parquet")
    wh = Warehouse(spark, sf)
    assert len(wh.ods_order_parts(f"{area}/unused")) == 1 and not os.path.exists(local_path(f"{area}/unused"))
    monkeypatch.setattr(partitioned, "PASS_BYTES", 1)
    parts = wh.ods_order_parts(f"{area}/lines")
    assert len(parts) == partitioned.MAX_PASSES
    days = [r["dt"] for p in parts for r in p.select("dt").distinct().collect()]
    assert len(days) == len(set(days)) == 9                      # eight days and NULL, each in one part
    assert sorted(x for p in parts for x in multiset(p)) == multiset(wh.ods_order_info)
    assert [p.schema for p in parts] == [wh.ods_order_info.schema] * len(parts)
