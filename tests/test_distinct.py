"""Distinct users from per-day bitmaps against plain sets."""

import datetime as dt
import random
from collections import defaultdict

from pyspark.sql import functions as F

from laminar.operators import distinct
from laminar.plans import active_users

SCHEMA = "dt string, category_id string, user_id string, ignored int"


def rows_of(rng, days, n):
    """Users under one category or none; one user and one day hold a third of all rows."""
    day = lambda: rng.choice([days[0], rng.choice(days)])
    out = [(day(), rng.choice(["a", "b", None]), rng.choice(["hot", f"u{rng.randrange(80)}", None]), i) for i in range(n)]
    return out + out[:30] + [(None, "a", "u1", 0)]


def start(period, day):
    d = dt.date.fromisoformat(day)
    return d.replace(day=1) if period == "month" else d - dt.timedelta(days=d.weekday())


def brute_periods(rows):
    sets = defaultdict(set)
    for day, cat, user, _ in rows:
        if day and user:
            for p in ("week", "month"):
                sets[p, start(p, day), "category_id", cat].add(user)
                sets[p, start(p, day), "all", None].add(user)
    return sorted(((*k, len(v)) for k, v in sets.items()), key=repr)


def brute_trailing(rows, days):
    of = defaultdict(set)
    for day, _, user, _ in rows:
        if day and user:
            of[dt.date.fromisoformat(day)].add(user)
    return sorted((str(d), len(set().union(*[of.get(d - dt.timedelta(days=i), set()) for i in range(days)]))) for d in of)


def check(spark, root, rows):
    stored = active_users.bitmaps(spark, root)
    got = distinct.by_period(stored, "category_id")
    assert sorted(map(tuple, got.collect()), key=repr) == brute_periods(rows)
    for days in (1, 7):
        assert sorted(map(tuple, distinct.trailing(stored, days).collect())) == brute_trailing(rows, days)
    return got


DAYS = [f"2024-01-{d:02d}" for d in (1, 2, 3, 7, 8, 29, 31)] + ["2024-02-01", "2024-02-29", "2024-03-01"]


def test_all_days_at_once_match_sets(spark, area):
    rows = rows_of(random.Random(5), DAYS, 600)
    active_users.update(spark, area, spark.createDataFrame(rows, SCHEMA))
    got = check(spark, area, rows)
    numbers = sorted(r["number"] for r in active_users.numbers(spark, area).collect())
    assert numbers == list(range(1, len(numbers) + 1))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "user_id" not in plan and "number" not in plan.replace("numbers", "")


def test_days_one_by_one_late_and_again(spark, area):
    rng = random.Random(6)
    rows = [r for r in rows_of(rng, DAYS[:4], 200) if r[0]]
    by_day = defaultdict(list)
    for r in rows:
        by_day[r[0]].append(r)
    order = [DAYS[2], DAYS[0], DAYS[3], DAYS[1]]
    for day in order:
        active_users.update(spark, area, spark.createDataFrame(rows, SCHEMA), day)
    check(spark, area, rows)
    before = {r["user_id"]: r["number"] for r in active_users.numbers(spark, area).collect()}
    # A day again with other rows and users, another day again without any.
    by_day[DAYS[0]] = [(DAYS[0], "a", f"n{i}", i) for i in range(5)]
    by_day[DAYS[1]] = []
    again = [r for x in by_day.values() for r in x]
    for day in DAYS[:2]:
        active_users.update(spark, area, spark.createDataFrame(again, SCHEMA), day)
    check(spark, area, again)
    after = {r["user_id"]: r["number"] for r in active_users.numbers(spark, area).collect()}
    assert before.items() <= after.items() and len(set(after.values())) == len(after)


def test_numbers_over_several_chunks(spark):
    """Numbers on both sides of a chunk's end, given by a base and by many buckets."""
    rows = spark.range(70_000).select(
        F.lit("2024-01-01").alias("dt"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("category_id"),
        F.col("id").cast("string").alias("user_id"))
    known = spark.createDataFrame([], distinct.NUMBERS)
    numbers = distinct.numbered(distinct.unnumbered(rows, known), 32_700)
    seen = numbers.agg(F.min("number"), F.max("number"), F.countDistinct("number")).first()
    assert tuple(seen) == (32_701, 102_700, 70_000)
    stored = distinct.daily_bitmaps(rows, numbers, ("category_id",))
    assert stored.select("chunk").distinct().count() == 4
    got = {(r["level"], r["category_id"]): r["active_users"] for r in distinct.by_period(stored, "category_id", ("month",)).collect()}
    assert got == {("category_id", "a"): 35_000, ("category_id", "b"): 35_000, ("all", None): 70_000}


def test_no_rows(spark, area):
    none = spark.createDataFrame([], SCHEMA)
    assert active_users.update(spark, area, none) == 0
    check(spark, area, [])
    assert active_users.update(spark, area, none, "2024-01-01") == 0
    check(spark, area, [])
