"""Dimension history against brute force: validity of versions, rows looked up as of their time."""

import datetime as dt
import random

from laminar.operators import versions

START = dt.datetime(2024, 1, 1)
ATTRIBUTES = ("status", "city")
VERSIONS = "user_id string, at timestamp, status string, city string, user_extra int"
FACTS = "id int, user_id string, at timestamp, status string, _row int"


def moment(rng, days=100):
    # Few different hours, so that versions and facts often share a time.
    return START + dt.timedelta(days=rng.randrange(days), hours=rng.randrange(4))


def some_versions(rng, n):
    users = ["hot"] * 6 + [f"u{i}" for i in range(8)] + [None]
    out = [(rng.choice(users), moment(rng) if rng.random() > 0.03 else None, rng.choice("ab"),
            rng.choice(["x", None]), i) for i in range(n)]
    return out + out[:10]


def rank(state):
    return tuple((v is not None, v or "") for v in state)


def brute_history(rows):
    best = {}
    for user, at, status, city, _ in rows:
        if user is not None and at is not None:
            old = best.get((user, at))
            best[user, at] = (status, city) if old is None else max(old, (status, city), key=rank)
    out = {}
    for (user, at), state in sorted(best.items()):
        mine = out.setdefault(user, [])
        if not mine or mine[-1][1] != state:
            mine.append((at, state))
    return out


def brute_lookup(history, user, at):
    known = [] if user is None or at is None else [(t, s) for t, s in history.get(user, []) if t <= at]
    return (*known[-1][1], known[-1][0]) if known else (None, None, None)


def cases(seed):
    rng = random.Random(seed)
    told = some_versions(rng, 300)
    users = ["hot", "hot", "u1", "u2", "nobody", None]
    asked = [(i, rng.choice(users), moment(rng, 140) - dt.timedelta(days=20) if rng.random() > 0.05 else None, "own", i % 3)
             for i in range(400)]
    return told, asked + asked[:5]


def test_validity_matches_brute_force(spark):
    for seed in range(2):
        told, _ = cases(seed)
        got = versions.validity(spark.createDataFrame(told, VERSIONS), "user_id", "at", ATTRIBUTES).collect()
        want = []
        for user, mine in brute_history(told).items():
            ends = [at for at, _ in mine[1:]] + [None]
            want += [(user, *state, at, end, end is None) for (at, state), end in zip(mine, ends)]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_lookup_matches_brute_force(spark):
    told, asked = cases(7)
    history = versions.validity(spark.createDataFrame(told, VERSIONS), "user_id", "at", ATTRIBUTES)
    got = versions.as_of(spark.createDataFrame(asked, FACTS), history, "user_id", "at", ATTRIBUTES)
    assert got.columns == ["id", "user_id", "at", "status", "_row", "status_as_of", "city_as_of", "version_from"]
    known = brute_history(told)
    want = [(*f, *brute_lookup(known, f[1], f[2])) for f in asked]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_empty_tables(spark):
    none, facts = spark.createDataFrame([], VERSIONS), spark.createDataFrame([], FACTS)
    history = versions.validity(none, "user_id", "at", ATTRIBUTES)
    assert history.count() == 0
    assert versions.as_of(facts, history, "user_id", "at", ATTRIBUTES).count() == 0
    one = spark.createDataFrame([(1, "u", START, "own", 0)], FACTS)
    assert versions.as_of(one, history, "user_id", "at", ATTRIBUTES).first()["version_from"] is None


def test_facts_are_shuffled_once_for_the_lookup(spark):
    """The window and the join with the carried versions share one partitioning of the facts."""
    from conftest import SF_SMALL
    from laminar.plans import registry
    plan = registry.queries()["orders_with_user_as_of"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    rows = [x for x in plan.splitlines() if "Exchange hashpartitioning(_key" in x and "_day" in x]
    assert len(rows) <= 3 and "NestedLoop" not in plan
