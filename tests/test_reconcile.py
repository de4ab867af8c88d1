"""Reconciliation of two layers against a brute-force full outer join."""

import random
from collections import defaultdict

from laminar.operators import reconcile

SCHEMA = "dt string, id string, a string, b int, ignored int"
KEY, COLUMNS = ["id"], ["a", "b"]


def brute(source, target):
    held = [defaultdict(list), defaultdict(list)]
    for side, rows in zip(held, (source, target)):
        for dt, key, *values, _ in rows:
            side[dt, key].append(repr(values))
    out = []
    for k in held[0].keys() | held[1].keys():
        one, two = sorted(held[0].get(k, [])), sorted(held[1].get(k, []))
        if one != two:
            out.append((*k, "lost" if not two else "invented" if not one else "changed", len(one), len(two)))
    return sorted(out, key=repr)


def rows_of(rng, n):
    out = [(rng.choice(["d1", "d2", "d3", None]), rng.choice(["hot", "hot", f"k{rng.randrange(60)}", None]),
            rng.choice(["x", "", None]), rng.choice([1, None]), i) for i in range(n)]
    return out + out[:20]


def check(spark, source, target, buckets=8):
    frames = [spark.createDataFrame(x, SCHEMA) for x in (source, target)]
    got = reconcile.differences(*frames, "dt", KEY, COLUMNS, buckets)
    assert got.columns == ["dt", "id", "status", "source_rows", "target_rows"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(source, target)
    return frames


def test_planted_faults_match_brute_force(spark):
    rng = random.Random(3)
    source = rows_of(rng, 400)
    # d1 stays as it is; elsewhere rows go, come, change or come twice.
    target = []
    for r in source:
        fate = rng.random() if r[0] != "d1" else 1
        if fate > 0.04:
            target.append((*r[:3], 7, 0) if fate < 0.08 else (r[0], f"new{len(target)}", *r[2:]) if fate < 0.1 else r)
        if 0.1 < fate < 0.12:
            target.append(r)
    rng.shuffle(target)
    frames = check(spark, source, target)
    days = {r["dt"] for r in reconcile.differing_buckets(*frames, "dt", KEY, COLUMNS, 8).collect()}
    assert "d1" not in days and days


def test_a_lost_and_an_invented_row_do_not_cancel(spark):
    source = [("d", "a", "x", 1, 0), ("d", "b", "x", 1, 0)]
    check(spark, source, [("d", "a", "x", 1, 9), ("d", "c", "x", 1, 0)], buckets=1)


def test_swapped_nulls_and_empty_text_differ(spark):
    check(spark, [("d", "a", None, 1, 0), ("d", "b", "", 1, 0)], [("d", "a", "", 1, 0), ("d", "b", None, 1, 0)])


def test_equal_and_empty_tables(spark):
    rows = [("d", "a", "x", 1, 0), (None, None, None, None, 0)]
    check(spark, rows, rows[::-1])
    check(spark, rows, [])
    check(spark, [], rows)
    check(spark, [], [])


def test_summary_counts_keys(spark):
    source, target = [spark.createDataFrame(x, SCHEMA) for x in ([("d", "a", "x", 1, 0), ("d", "b", "x", 1, 0)], [("d", "c", "x", 1, 0)])]
    found = reconcile.differences(source, target, "dt", KEY, COLUMNS)
    assert sorted(map(tuple, reconcile.summary(found, "dt").collect())) == [("d", "invented", 1), ("d", "lost", 2)]


def test_equal_days_are_not_read_again(spark, area):
    source = [(f"d{i}", "a", "x", 1, 0) for i in range(4)]
    frames = []
    for name, rows in (("source", source), ("target", source[:3])):
        spark.createDataFrame(rows, SCHEMA).write.partitionBy("dt").parquet(f"{area}/{name}")
        frames.append(spark.read.parquet(f"{area}/{name}"))
    found = reconcile.differences(*frames, "dt", KEY, COLUMNS)
    assert [tuple(r) for r in found.collect()] == [("d3", "a", "lost", 1, 0)]
    scans = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x and "/source" in x]
    assert scans and all("d3" in x.split("PartitionFilters")[1].split("PushedFilters")[0] for x in scans)
