"""The serving state: any sequence of daily updates equals a full rebuild."""

import random

import pytest
from pyspark.sql import functions as F

from laminar.operators import serving
from laminar.plans import incremental
from laminar.schemas import DWD_ORDER_INFO
from laminar.sinks.partitioned import write_frame
from laminar.sources.tables import table_path

SCHEMA = ("order_id string, user_id string, category_id string, order_date date, final_amount decimal(10,2), "
          "order_status string, dt string")
RUN_TS = "2024-03-01 00:00:00"
BAD = ("pending", "lost")


def orders(rng, day, n, users=12):
    """Orders landed on March ``day``; some are dated up to five days earlier, some later, some not at all."""
    out = []
    for i in range(n):
        when = rng.choice([day, day, day - 1, day - rng.randrange(6), day + 2])
        date = f"2024-03-{when:02d}" if when > 0 else None
        out.append((f"o{day}-{i}", f"u{rng.randrange(users)}", rng.choice("abc"), date, rng.randrange(1, 9999) / 100,
                    rng.choice(["completed", "pending", "lost"]), f"2024-03-{day:02d}"))
    return out


def frame(spark, rows):
    text = SCHEMA.replace("order_date date", "order_date string").replace("final_amount decimal(10,2)", "final_amount double")
    return spark.createDataFrame(rows, text).select(
        "order_id", "user_id", "category_id", F.col("order_date").cast("date").alias("order_date"),
        F.col("final_amount").cast("decimal(10,2)").alias("final_amount"), "order_status", "dt")


def rows(df):
    return sorted(tuple(repr(v) for v in r) for r in df.collect())


def check(spark, root, landed, as_of):
    detail = frame(spark, [r for day in landed.values() for r in day])
    assert rows(incremental.user_behavior(spark, root, RUN_TS)) == rows(serving.user_behavior(detail, as_of, BAD, RUN_TS))
    seen = detail.where(F.col("order_date") <= F.lit(as_of).cast("date"))
    assert rows(incremental.sales_trend(spark, root, RUN_TS)) == rows(serving.sales_trend(seen, RUN_TS))


def update(spark, root, landed, *days, **options):
    detail = frame(spark, [r for d in landed.values() for r in d])
    return incremental.update(spark, root, detail, *[f"2024-03-{d:02d}" for d in days], bad_statuses=BAD, buckets=4, **options)


def test_days_in_any_order_reruns_and_late_orders_equal_a_rebuild(spark, area):
    rng = random.Random(4)
    landed = {d: orders(rng, d, 25) for d in range(8, 16)}
    first = {d: landed[d] for d in (8, 9, 10)}
    update(spark, area, first, 8, 10)                         # a backfill
    check(spark, area, first, "2024-03-10")
    for d in (13, 11, 12):                                    # a day that came late
        first[d] = landed[d]
        update(spark, area, first, d)
        check(spark, area, first, "2024-03-13")
    first[9] = [r for r in landed[9] if r[1] not in ("u1", "u2")][:5] + orders(rng, 9, 3, users=40)
    update(spark, area, first, 9)                             # an old day with other rows
    first[12] = []
    update(spark, area, first, 12)                            # a day that lost all its rows
    check(spark, area, first, "2024-03-13")
    first |= {14: landed[14], 15: landed[15], 8: landed[8][:1]}
    update(spark, area, first, 8, 15)                         # a backfill over everything
    check(spark, area, first, "2024-03-15")


def test_only_changed_buckets_are_written(spark, area):
    one = {1: [("o1", "u1", "a", "2024-03-01", 5.0, "completed", "2024-03-01")]}
    many = {2: [(f"p{i}", f"u{i}", "a", "2024-03-02", 5.0, "pending", "2024-03-02") for i in range(40)]}
    before = update(spark, area, many, 2)
    assert len(before.users) == 4
    after = update(spark, area, one | many, 1)
    moved = {b for b in after.users if after.users[b] != before.users[b]}
    assert len(moved) == 1
    again = update(spark, area, one | many, 2)                # nothing changed: no bucket is written
    assert again.users == after.users and again.trend == after.trend
    check(spark, area, one | many, "2024-03-02")
    assert incremental.vacuum(spark, area)
    check(spark, area, one | many, "2024-03-02")


def test_a_daily_run_never_opens_the_history(spark, area):
    """The days before are unreadable files, yet the daily job runs."""
    rng = random.Random(9)
    landed = {d: orders(rng, d, 20) for d in (11, 12)}
    update(spark, area, {11: landed[11]}, 11)
    filler = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in DWD_ORDER_INFO.full_schema.fields}
    detail = frame(spark, landed[12])
    full = detail.select(*[F.col(n) if n in detail.columns else c for n, c in filler.items()]).drop("dt")
    path = table_path(area, DWD_ORDER_INFO)
    write_frame(full, f"{path}/dt=2024-03-12")
    spark.createDataFrame([("not parquet",)], "v string").write.text(f"{path}/dt=2024-03-11")
    written = incremental.run_serving(spark, area, "2024-03-12", bad_statuses=BAD, run_ts=RUN_TS)
    assert all(written.values())
    check(spark, area, landed, "2024-03-12")


def test_a_failed_update_leaves_the_state(spark, area, monkeypatch):
    rng = random.Random(1)
    landed = {d: orders(rng, d, 20) for d in (11, 12)}
    update(spark, area, {11: landed[11]}, 11)
    kept = incremental.load(spark, area)

    def fail(df, path, *args, **kwargs):
        if path.endswith("/trend"):
            raise OSError("disk is gone")
        return write_frame(df, path, *args, **kwargs)

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(incremental, "write_frame", fail)
        update(spark, area, landed, 12)
    assert incremental.load(spark, area) == kept
    check(spark, area, {11: landed[11]}, "2024-03-11")
    update(spark, area, landed, 12)
    check(spark, area, landed, "2024-03-12")


def test_refusals(spark, area):
    rows_ = {1: [("o1", "u1", "a", "2024-03-01", 5.0, "completed", "2024-03-01")]}
    with pytest.raises(incremental.StateError):
        incremental.user_behavior(spark, area)                # nothing applied yet
    state = update(spark, area, rows_, 1)
    with pytest.raises(incremental.StateError):               # other statuses count as bad
        incremental.update(spark, area, frame(spark, rows_[1]), "2024-03-01", bad_statuses=("lost",))
    with pytest.raises(incremental.StateError):               # another update was faster
        incremental._publish(spark, area, state)
    with pytest.raises(incremental.StateError):
        incremental.user_behavior(spark, area, as_of="2024-02-01")
    with pytest.raises(incremental.StateError):
        update(spark, area, rows_, 5, 1)


def test_no_orders_at_all(spark, area):
    state = update(spark, area, {1: []}, 1)
    assert state.as_of == "2024-03-01" and not state.users
    assert incremental.user_behavior(spark, area).collect() == []
    assert incremental.sales_trend(spark, area).collect() == []


def test_an_update_writes_the_users_it_changes_and_layers_merge(spark, area, monkeypatch):
    """Layers above a large state equal a rebuild, through merges of some buckets, users that
    lose all their orders and users that come back."""
    monkeypatch.setattr(incremental, "LAYERS", 4)
    monkeypatch.setattr(incremental, "BROADCAST_USERS", 3)      # both ways of joining
    rng = random.Random(3)
    landed = {d: [r for r in orders(rng, d, 400, users=300) if (r[3] or "") < "2024-03-10"] for d in (8, 9)}
    before = update(spark, area, landed, 8, 9)
    assert all(len(paths) == 1 for paths in before.users.values())
    landed[10] = [("o", "u1", "a", "2024-03-10", 5.0, "pending", "2024-03-10")]
    after = update(spark, area, landed, 10)
    (b,) = [b for b in after.users if after.users[b] != before.users[b]]
    assert after.users[b][:1] == before.users[b] and len(after.users[b]) == 2
    assert after.rows[after.users[b][1]] == 1 == spark.read.parquet(after.users[b][1]).count()
    check(spark, area, landed, "2024-03-10")
    merged = False
    for step in range(5):
        landed[11 + step] = orders(rng, 11 + step, 2 + step, users=300)
        if step == 2:
            landed[10] = []                                     # u1's order is taken back
            update(spark, area, landed, 10)
        last = update(spark, area, landed, 11 + step)
        merged |= any(len(p) == 1 and p != before.users[b] for b, p in last.users.items())
        assert all(len(p) <= 4 for p in last.users.values())
    assert merged and any(len(p) > 1 for p in last.users.values())
    check(spark, area, landed, "2024-03-15")
    assert incremental.vacuum(spark, area)
    check(spark, area, landed, "2024-03-15")
