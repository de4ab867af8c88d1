"""Golden tests on the warehouse's sample day (5 users, 8 orders); expected values
from FIXTURES.md section 2."""

from decimal import Decimal

import pytest

from laminar.operators import quality
from laminar.operators.aggregates import product_daily_stats, user_daily_stats
from laminar.operators.transforms import clean_orders, clean_users
from laminar.sources.seed import SEED_DAY, seed_orders, seed_users


@pytest.fixture(scope="module")
def layers(spark):
    ods_u, ods_o = seed_users(spark), seed_orders(spark)
    dwd_u, dwd_o = clean_users(ods_u), clean_orders(ods_o)
    return {"ods_user_info": ods_u, "ods_order_info": ods_o, "dwd_user_info": dwd_u,
            "dwd_order_info": dwd_o, "dws_user_daily_stats": user_daily_stats(dwd_o),
            "dws_product_daily_stats": product_daily_stats(dwd_o)}


def test_dwd_users(layers):
    rows = {r.user_id: r for r in layers["dwd_user_info"].collect()}
    assert len(rows) == 5
    expect = {"U001": (True, "Regular"), "U002": (True, "Regular"), "U003": (False, "VIP"),
              "U004": (False, "Premium"), "U005": (True, "Regular")}
    for uid, (active, level) in expect.items():
        assert (rows[uid].is_active, rows[uid].user_level) == (active, level)
    assert str(rows["U001"].register_date) == "2024-01-15"
    assert str(rows["U005"].last_login_date) == "2024-12-21"


def test_dwd_orders(layers):
    rows = {r.order_id: r for r in layers["dwd_order_info"].collect()}
    assert len(rows) == 8
    assert rows["O004"].category_id == "COMPUTER"
    assert {r.category_id for k, r in rows.items() if k != "O004"} == {"OTHER"}
    assert all(r.discount_amount == Decimal("0.00") and r.final_amount == r.total_amount for r in rows.values())
    assert rows["O004"].payment_date is None
    assert str(rows["O001"].order_date) == "2024-12-25"


def test_dws_user_daily_stats(layers):
    rows = {r.user_id: r for r in layers["dws_user_daily_stats"].collect()}
    expect = {"U001": (2, "24998.00", 12499.0, "10:30:00", "14:20:00"),
              "U002": (2, "1195.00", 597.5, "16:45:00", "20:15:00"),
              "U003": (2, "7797.00", 3898.5, "18:30:00", "23:15:00"),
              "U004": (1, "17998.00", 17998.0, "21:00:00", "21:00:00"),
              "U005": (1, "2999.00", 2999.0, "22:30:00", "22:30:00")}
    assert set(rows) == set(expect)
    for uid, (n, total, avg, first, last) in expect.items():
        r = rows[uid]
        assert (r.order_count, r.total_amount, r.avg_order_amount) == (n, Decimal(total), avg)
        assert r.first_order_time.strftime("%H:%M:%S") == first and r.last_order_time.strftime("%H:%M:%S") == last
        assert r.login_count == 0 and str(r.stat_date) == SEED_DAY


def test_dws_product_daily_stats(layers):
    rows = {r.product_id: r for r in layers["dws_product_daily_stats"].collect()}
    expect = {"P001": ("OTHER", 2, 3, "26997.00", 8999.0, 2), "P002": ("OTHER", 1, 1, "15999.00", 15999.0, 1),
              "P003": ("OTHER", 1, 2, "598.00", 299.0, 1), "P004": ("COMPUTER", 1, 1, "5999.00", 5999.0, 1),
              "P005": ("OTHER", 1, 3, "597.00", 199.0, 1), "P006": ("OTHER", 1, 1, "2999.00", 2999.0, 1),
              "P007": ("OTHER", 1, 2, "1798.00", 899.0, 1)}
    assert set(rows) == set(expect)
    for pid, (cat, n, qty, total, avg, users) in expect.items():
        r = rows[pid]
        assert (r.category_id, r.order_count, r.total_quantity, r.total_amount, r.avg_price, r.unique_users) == \
            (cat, n, qty, Decimal(total), avg, users)


def test_quality_report(layers):
    f = quality.findings(layers, as_of="2024-12-26").collect()
    warns = {(r.check_name, r.table_name, r.column_name) for r in f if r.severity == "WARN"}
    assert warns == {("null_ratio", "ods_order_info", "payment_time"),
                     ("null_ratio", "dwd_order_info", "payment_date")}
    assert not [r for r in f if r.severity == "FAIL"]
    ratio = [r.metric for r in f if r.column_name == "payment_time"][0]
    assert ratio == 0.125
    (rep,) = quality.report(layers, as_of="2024-12-26").collect()
    assert (rep.check_date, rep.tables_checked, rep.fail_count, rep.warn_count, rep.overall_status) == \
        (SEED_DAY, 6, 0, 2, "PASS")
    quality.assert_quality(quality.report(layers, as_of="2024-12-26"))
    (uc,) = quality.user_consistency(layers["ods_user_info"], layers["dwd_user_info"]).collect()
    assert (uc.ods_users, uc.dwd_users, uc.consistent) == (5, 5, True)
    (rt,) = quality.order_retention(layers["ods_order_info"], layers["dwd_order_info"]).collect()
    assert (rt.retention_ratio, rt.breached) == (1.0, False)
