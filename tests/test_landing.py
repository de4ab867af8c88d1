"""Streams in bounded batches: landing in the raw layer exactly once, daily activity without loss."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from laminar.schemas import ODS_ORDER_INFO
from laminar.sinks import files
from laminar.sources.tables import read_table, table_path
from laminar.sources.testdata import raw_orders_from_purchases
from laminar.streaming import activity, landing

SCHEMA = "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double, props string"


def deliver(spark, folder, name, rows):
    """One file per list of rows, in a shuffled order of event time."""
    frame = spark.createDataFrame([(i, u, t, k, v, "{}") for i, u, t, k, v in rows],
                                  SCHEMA.replace("timestamp_ntz", "string")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    frame.coalesce(1).write.parquet(f"{folder}/stage-{name}")
    part = next(n for n in files.names(spark, f"{folder}/stage-{name}") if n.startswith("part-"))
    files.move(spark, f"{folder}/stage-{name}/{part}", f"{folder}/events.parquet/{name}.parquet")


def events(rng, n, first=0):
    return [(first + i, rng.randrange(6), f"2024-01-{rng.randrange(1, 6):02d} {rng.randrange(24):02d}:30:00",
             rng.choice(["purchase", "purchase", "view"]), rng.randrange(1, 999) / 4) for i in range(n)]


@pytest.fixture()
def delivered(spark, area):
    """Every event twice over five files; some events have no id."""
    rng = random.Random(6)
    once = events(rng, 90)
    once += [(None, 3, "2024-01-02 10:00:00", "purchase", 7.0)]
    twice = [e for e in once for _ in range(1 if e[0] is None else 2)]
    rng.shuffle(twice)
    for i in range(5):
        deliver(spark, area, f"f{i}", twice[i::5])
    return area, once


def landed(spark, to):
    return Counter(tuple(r) for r in read_table(spark, to.root, ODS_ORDER_INFO).collect())


def wanted(spark, once):
    frame = spark.createDataFrame([(i, u, t, k, v, "{}") for i, u, t, k, v in once],
                                  SCHEMA.replace("timestamp_ntz", "string")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return Counter(tuple(r) for r in raw_orders_from_purchases(frame).drop("event_time").collect())


def run(spark, folder, to):
    return landing.run_landing(spark, folder, raw_orders_from_purchases, to, max_bytes_per_trigger=1)


def own_files(spark, to):
    table = table_path(to.root, ODS_ORDER_INFO)
    return {f"{d}/{n}" for d in files.names(spark, table) if d.startswith("dt=")
            for n in files.names(spark, f"{table}/{d}") if n.endswith(".parquet") and not n.startswith(".")}


def test_batches_land_each_order_once_and_a_replay_touches_only_its_files(spark, delivered):
    folder, once = delivered
    to = landing.Landing(f"{folder}/warehouse", ODS_ORDER_INFO, "order_id")
    done = run(spark, folder, to)
    want = wanted(spark, once)
    assert len(done) == 5 and all(e["done"] for e in done.values())
    assert landed(spark, to) == want and sum(e["rows"] for e in done.values()) == sum(want.values())
    # Days overlap between the files, so rows came late; all are landed and listed.
    late = landing.late_rows(spark, to)
    assert late.count() == sum(e["late"] for e in done.values()) > 0
    assert set(landing.days_to_redo(spark, to)) <= {f"2024-01-0{d}" for d in range(1, 6)}
    # The last batch's commit is lost: it runs again.
    before = own_files(spark, to)
    for name in ("4", ".4.crc"):
        files.remove(spark, f"{to.area}/checkpoint/commits/{name}")
    again = run(spark, folder, to)
    assert landed(spark, to) == want and again[4]["rows"] == done[4]["rows"]
    other = {f for f in before if "/b0000000004-" not in f}
    assert other <= own_files(spark, to) and {f for f in own_files(spark, to) if "/b0000000004-" not in f} == other
    # Files that come later are taken by the next run, copies of landed orders are not.
    more = events(random.Random(8), 10, first=1000)
    deliver(spark, folder, "f9", more + [e for e in once if e[0] is not None][:30])
    assert len(run(spark, folder, to)) == 6
    assert landed(spark, to) == wanted(spark, once + more)


def test_copies_become_one_by_one_scan(spark, area):
    """Rows without a key are all kept, equal ones too, and the batch is read once."""
    rows = [("a", 1), ("a", 1), ("a", 0), ("b", None), (None, 1), (None, 1), (None, None)]
    spark.createDataFrame(rows, "k string, v int").write.parquet(f"{area}/rows")
    once = landing.one_per_key(spark.read.parquet(f"{area}/rows"), "k")
    assert Counter(tuple(r) for r in once.collect()) == Counter([("a", 0), ("b", None), (None, 1), (None, 1), (None, None)])
    assert once._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


def test_a_batch_that_fails_half_way_is_replaced(spark, delivered, monkeypatch):
    folder, once = delivered
    to = landing.Landing(f"{folder}/warehouse", ODS_ORDER_INFO, "order_id")
    moves = []

    def fail(spark_, source, target):
        if len(moves) == 3:
            raise OSError("the file system is gone")
        moves.append(target)
        return move(spark_, source, target)

    move = files.move
    with monkeypatch.context() as m, pytest.raises(Exception, match="file system is gone"):
        m.setattr(landing.files, "move", fail)
        run(spark, folder, to)
    assert not to.ledger(spark).entry(0)["done"]
    run(spark, folder, to)
    assert landed(spark, to) == wanted(spark, once)


def test_bounded_activity_equals_the_batch_twin_with_late_rows_kept(spark, delivered):
    folder, _ = delivered
    rows = spark.read.parquet(f"{folder}/events.parquet")
    out = f"{folder}/activity"
    done = activity.run_bounded_activity(spark, folder, out, max_bytes_per_trigger=1)
    want = Counter(tuple(r) for r in activity.daily_activity(rows).collect())
    columns = activity.daily_activity(rows).columns

    def got():
        return Counter(tuple(r) for r in activity.merged_activity(spark, out).select(*columns).collect())

    assert len(done) == 5 and got() == want
    kept = spark.read.parquet(f"{out}/late").count()
    assert kept == sum(e["late"] for e in done.values()) > 0
    for name in ("4", ".4.crc"):
        files.remove(spark, f"{out}/_checkpoint/commits/{name}")
    assert activity.run_bounded_activity(spark, folder, out, max_bytes_per_trigger=1) == done
    assert got() == want
