"""A day is published at once: readers see the old rows or the new ones, never none or both."""

import pytest
from pyspark.sql import functions as F

from laminar.plans import catalog, daily
from laminar.schemas import (DWD_ORDER_INFO, DWD_USER_INFO, DWS_PRODUCT_DAILY_STATS, DWS_USER_DAILY_STATS, ODS_ORDER_INFO,
                             ODS_USER_INFO)
from laminar.sinks import files, partitioned, publish
from laminar.sources.seed import seed_orders, seed_users
from laminar.sources.tables import read_days, read_table, table_path

DAY, NEXT = "2024-12-26", "2024-12-27"


def landed(spark, area):
    partitioned.land(seed_users(spark), area, ODS_USER_INFO, DAY)
    partitioned.land(seed_orders(spark), area, ODS_ORDER_INFO, DAY)
    return read_table(spark, area, ODS_ORDER_INFO, DAY)


def ids(df):
    return sorted(r["order_id"] for r in df.collect())


def test_a_reader_sees_the_old_day_until_the_new_one_is_complete(spark, area, monkeypatch):
    orders = landed(spark, area)
    all_ids = ids(orders)
    publish.publish_day(orders.where("order_id <> 'O001'"), area, ODS_ORDER_INFO, DAY)
    old = ids(read_table(spark, area, ODS_ORDER_INFO, DAY))
    assert old == [i for i in all_ids if i != "O001"]
    seen = []

    def half(df, path, **kwargs):
        rows = partitioned.write_frame(df, path, **kwargs)
        seen.append(ids(read_table(spark, area, ODS_ORDER_INFO, DAY)))     # written, not published
        raise OSError("the driver is lost")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(publish, "write_frame", half)
        publish.publish_day(orders, area, ODS_ORDER_INFO, DAY)
    with monkeypatch.context() as m, pytest.raises(publish.PublishError, match="read back"):
        m.setattr(publish, "write_frame", lambda df, path, **k: partitioned.write_frame(df, path, **k) + 1)
        publish.publish_day(orders, area, ODS_ORDER_INFO, DAY)
    assert seen == [old] and ids(read_table(spark, area, ODS_ORDER_INFO, DAY)) == old
    publish.publish_day(orders, area, ODS_ORDER_INFO, DAY)
    assert ids(read_table(spark, area, ODS_ORDER_INFO, DAY)) == all_ids
    assert ids(read_table(spark, area, ODS_ORDER_INFO)) == all_ids          # not the plain folder as well
    publish.publish_day(orders.limit(0), area, ODS_ORDER_INFO, DAY)
    assert ids(read_table(spark, area, ODS_ORDER_INFO, DAY)) == []


def test_ranges_mix_published_and_plain_days(spark, area):
    orders = landed(spark, area).drop("dt")
    partitioned.land(orders.limit(2), area, ODS_ORDER_INFO, NEXT)
    publish.publish_day(orders.limit(3), area, ODS_ORDER_INFO, DAY)
    per_day = {r["dt"]: r["n"] for r in read_days(spark, area, ODS_ORDER_INFO, DAY, NEXT).groupBy("dt").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert per_day == {DAY: 3, NEXT: 2}
    assert read_days(spark, area, ODS_ORDER_INFO, NEXT, NEXT).count() == 2
    assert read_days(spark, area, ODS_ORDER_INFO, "2024-12-27", "2024-12-31").count() == 2
    # A later plain write of a day of this table is published too; a backfill is refused.
    partitioned.land(orders.limit(1), area, ODS_ORDER_INFO, DAY)
    assert read_table(spark, area, ODS_ORDER_INFO, DAY).count() == 1
    with pytest.raises(ValueError, match="published days"):
        partitioned.write_table(read_table(spark, area, ODS_ORDER_INFO), area, ODS_ORDER_INFO, day_range=(DAY, NEXT))
    gone = publish.retire(spark, area, ODS_ORDER_INFO)
    assert len(gone) == 2 and f"dt={DAY}" in gone
    assert read_table(spark, area, ODS_ORDER_INFO).count() == 3
    assert publish.retire(spark, area, ODS_ORDER_INFO) == []


def test_daily_run_publishes_and_the_catalog_follows(spark, area):
    landed(spark, area)
    catalog.setup(spark, area, replace=True)
    plain = daily.run_daily(spark, area, DAY)
    catalog.register(spark, (DWD_ORDER_INFO,), DAY)
    assert daily.run_daily(spark, area, DAY, publish=True) == plain
    assert daily.run_daily(spark, area, DAY, publish=True) == plain
    for spec in (DWD_USER_INFO, DWD_ORDER_INFO, DWS_USER_DAILY_STATS, DWS_PRODUCT_DAILY_STATS):
        assert read_table(spark, area, spec).count() == plain[spec.name]
        assert spark.table(spec.qualified).count() == plain[spec.name]
        publish.retire(spark, area, spec)
        assert spark.table(spec.qualified).count() == plain[spec.name]
        assert len(files.names(spark, f"{table_path(area, spec)}/_versions/dt={DAY}")) == 1
    with pytest.raises(ValueError, match="single day"):
        daily.run(spark, area, daily.Days.every(), publish=True)
    for spec in (ODS_USER_INFO, ODS_ORDER_INFO):
        spark.sql(f"DROP TABLE {spec.qualified}")
