"""Edge cases of cleaning, thresholds and rounding."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from laminar.functions.parsing import resolve_run_date, run_date_literal
from laminar.functions.rounding import floor_div, half_up_ratio
from laminar.functions.rules import keyword_classifier, REFERENCE_CATEGORY_RULES
from laminar.operators import quality
from laminar.operators.transforms import clean_orders, clean_users
from laminar.schemas import DWD_ORDER_INFO, ODS_ORDER_INFO, ODS_USER_INFO
from laminar.sources.seed import SEED_ORDERS, SEED_USERS


def users(spark, rows):
    return spark.createDataFrame(rows, ODS_USER_INFO.schema).withColumn("dt", F.lit("2024-12-26"))


def orders(spark, rows):
    rows = [r[:5] + (None if r[5] is None else Decimal(r[5]), None if r[6] is None else Decimal(r[6])) + r[7:]
            for r in rows]
    return spark.createDataFrame(rows, ODS_ORDER_INFO.schema).withColumn("dt", F.lit("2024-12-26"))


def test_null_status_and_bad_dates(spark):
    base = SEED_USERS[0]
    rows = [("X1",) + base[1:4] + ("bad-date", "2024-13-45 00:00:00", None, "nope", base[8]),
            (None,) + base[1:]]
    (r,) = clean_users(users(spark, rows)).collect()
    assert r.user_id == "X1" and r.is_active is False and r.user_level == "Regular"
    assert r.register_date is None and r.last_login_date is None and r.create_time is None


def test_status_case_sensitive(spark):
    base = SEED_USERS[0]
    rows = [(f"Y{i}",) + base[1:6] + (s,) + base[7:] for i, s in enumerate(["VIP", "Active", "premium"])]
    got = {r.user_id: (r.is_active, r.user_level) for r in clean_users(users(spark, rows)).collect()}
    assert got == {"Y0": (False, "Regular"), "Y1": (False, "Regular"), "Y2": (False, "Premium")}


def test_invalid_orders_dropped(spark):
    o = SEED_ORDERS[0]
    rows = [o, o[:6] + ("0.00",) + o[7:], o[:6] + ("-5.00",) + o[7:], (None,) + o[1:], o[:1] + (None,) + o[2:],
            o[:6] + (None,) + o[7:]]
    assert clean_orders(orders(spark, rows)).count() == 1


def test_keyword_first_match_wins(spark):
    df = spark.createDataFrame([("手机电脑",), ("电脑服装",), (None,), ("x",)], "n string")
    got = [r.c for r in df.select(keyword_classifier("n", REFERENCE_CATEGORY_RULES).alias("c")).collect()]
    assert got == ["PHONE", "COMPUTER", "OTHER", "OTHER"]


def test_exactly_ten_percent_nulls_not_breached(spark):
    df = spark.createDataFrame([(None if i == 0 else "v", "2024-12-26") for i in range(10)], "c string, dt string")
    (r,) = quality.completeness(df, "t").collect()
    assert r.null_ratio == 0.1 and r.breached is False
    df2 = spark.createDataFrame([(None if i < 2 else "v", "2024-12-26") for i in range(11)], "c string, dt string")
    assert quality.completeness(df2, "t").first().breached is True


def test_retention_boundary_and_empty_raw(spark):
    ods = spark.createDataFrame([(i, "d1") for i in range(20)] + [(i, "d2") for i in range(3)], "x int, dt string")
    dwd = spark.createDataFrame([(i, "d1") for i in range(19)] + [(i, "d3") for i in range(2)], "x int, dt string")
    got = {r.check_date: (r.retention_ratio, r.breached) for r in quality.order_retention(ods, dwd).collect()}
    assert got["d1"] == (0.95, False)
    assert got["d2"] == (0.0, True)
    assert got["d3"] == (0.0, True)   # detail rows but an empty raw day: ratio 0


def test_empty_partition_and_missing_table_fail(spark):
    from laminar.sources.seed import seed_orders, seed_users
    u, o = seed_users(spark), seed_orders(spark)
    empty = clean_orders(o).where(F.lit(False))
    tables = {"ods_user_info": u, "ods_order_info": o, "dwd_user_info": clean_users(u),
              "dwd_order_info": empty, "dws_product_daily_stats": empty}
    rep = quality.report(tables, as_of="2024-12-26").first()
    # two empty partitions + one missing table (dws_user_daily_stats not given)
    assert rep.overall_status == "FAIL" and rep.fail_count == 3 and rep.tables_checked == 3
    with pytest.raises(quality.QualityGateError):
        quality.assert_quality(quality.report(tables, as_of="2024-12-26"))


def test_missing_table_detected(spark, area):
    assert quality.missing_tables(spark, {"t": f"{area}/nope"}) == ["t"]


def test_run_date_resolution(spark):
    assert resolve_run_date(None, today=dt.date(2024, 12, 27)) == "2024-12-26"
    assert resolve_run_date("2024-12-26") == "2024-12-26"
    with pytest.raises(ValueError):
        resolve_run_date("2024-13-01")
    with pytest.raises(Exception):
        spark.range(1).select(F.lit("bad").cast("date")).collect()
    assert spark.range(1).select(run_date_literal("2024-12-26").alias("d")).first().d == dt.date(2024, 12, 26)


def test_half_up_rounding_exact(spark):
    cases = [(107, 40, 2, 2.68), (1, 16, 4, 0.0625), (1, 32, 4, 0.0313), (-1, 32, 4, -0.0313),
             (0, 7, 4, 0.0), (2, 3, 4, 0.6667), (5, 0, 2, None)]
    df = spark.createDataFrame([(a, b) for a, b, _, _ in cases], "a long, b long")
    for a, b, s, want in cases:
        got = df.where((F.col("a") == a) & (F.col("b") == b)).select(half_up_ratio("a", "b", s).alias("r")).first().r
        assert got == want, (a, b, s, got)


def test_floor_div_large(spark):
    for a, b in [(2 ** 62 - 1, 3), (2 ** 62, 2 ** 31 - 1), (10 ** 18 + 7, 10 ** 9), (2 ** 53 + 1, 2), (5, 7)]:
        got = spark.range(1).select(floor_div(F.lit(a), F.lit(b)).alias("q")).first().q
        assert got == a // b, (a, b)


def test_conform_rejects_overflow(spark):
    from laminar.schemas import conform
    df = spark.createDataFrame([(Decimal("123456789.00"),)], "final_amount decimal(20,2)")
    rows = [tuple(None for _ in DWD_ORDER_INFO.full_schema.fields)]
    full = spark.createDataFrame(rows, DWD_ORDER_INFO.full_schema).drop("final_amount").crossJoin(df)
    with pytest.raises(Exception):
        conform(full, DWD_ORDER_INFO).collect()


def test_one_pass_login_stats_equal_joined_form(spark):
    """Orders and logins from one table: the single conditional aggregate gives the
    same rows as the two aggregates joined on (day, user)."""
    from conftest import SF_SMALL
    from laminar.operators.aggregates import user_daily_stats, user_daily_stats_one_pass
    from laminar.sources import testdata
    ev = testdata.table(spark, SF_SMALL, "events")
    joined = user_daily_stats(testdata.orders_from_purchases(ev), testdata.logins_from_views(ev))
    kind = F.col("event_type")
    one = user_daily_stats_one_pass(testdata.event_activity(ev), kind == "purchase", kind == "view")
    rows = lambda df: sorted(tuple(repr(v) for v in r) for r in df.select(*joined.columns).collect())
    assert rows(one) == rows(joined) and len(rows(one)) > 0


def test_storage_root_refuses_local_fallback_on_a_cluster():
    """Without spark.checkpoint.dir, only a local-mode session gets a private folder."""
    from types import SimpleNamespace

    from laminar.session import storage_root

    def session(master):
        ctx = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=ctx)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage_root(session("yarn"))
    assert storage_root(session("local[2]"))
