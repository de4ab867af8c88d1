"""Serving by increments: a day's detail and the state in, the next state out.

Under ``<root>/serving_state`` every update writes a folder of its own: the days'
contributions, the users that changed, the trend, and changes that wait for their order date.
A manifest, written last, says which folders hold which bucket and day; the newest complete
manifest is the state. So an update that fails, or one that a reader overlaps with, leaves the
state as it was, and unchanged buckets are never rewritten.

A bucket is a folder of all its users and, above it, layers: folders of the users that later
updates changed, each row in place of the user's row below. So an update writes as many rows
as it changes. When the rows above reach a quarter (``MERGE_SHARE``) of those below, or a
bucket has ``LAYERS`` folders, the update merges the buckets it touches into new folders.

An update reads the detail of its own days, those days' earlier contributions (if they were
applied before) and, of the buckets of the users that changed, these users' rows. It never
reads the history. Few changed users (``BROADCAST_USERS``) are sent to the buckets' rows, so
the state is not shuffled.

What reaches the driver is bounded: the manifest (at most ``LAYERS`` folders per bucket, a row
per applied day) and the numbers of the changed buckets.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from laminar.functions.parsing import resolve_run_date
from laminar.operators import serving, serving_state as ss
from laminar.schemas import ADS_SALES_TREND_ANALYSIS, ADS_USER_BEHAVIOR_ANALYSIS, DWD_ORDER_INFO
from laminar.session import configure
from laminar.sinks import files
from laminar.sinks.partitioned import write_frame, write_table
from laminar.sources.tables import read_days

FOLDER = "serving_state"
BUCKETS = 64
MERGE_SHARE = 4               # layers are merged when their rows reach this part of those below
LAYERS = 32                   # folders of a bucket, at most
BROADCAST_USERS = 1 << 18     # changed rows up to which the users' ids are broadcast
ROWS = ss.STATE.rsplit(",", 1)[0]
LAYER_ROWS = f"{ss.STATE}, layer int"


class StateError(RuntimeError):
    """The serving state cannot take the update."""


@dataclass(frozen=True)
class State:
    """Which folder holds what. ``as_of`` is the last day applied."""
    version: int = 0
    buckets: int = BUCKETS
    as_of: str | None = None
    bad_statuses: tuple[str, ...] = ()
    users: dict[int, list[str]] = field(default_factory=dict)  # bucket -> folder of all users, then layers
    rows: dict[str, int] = field(default_factory=dict)         # folder of a users' write -> rows in it
    days: dict[str, str] = field(default_factory=dict)         # applied day -> folder of its contribution
    trend: str | None = None
    waiting: str | None = None


def _manifests(spark: SparkSession, root: str) -> dict[int, str]:
    """Published manifests by version, by one listing of their folder."""
    folder = f"{root.rstrip('/')}/{FOLDER}/manifest"
    return {int(n[1:-5]): f"{folder}/{n}" for n in files.names(spark, folder) if n.startswith("v") and n.endswith(".json")}


def load(spark: SparkSession, root: str, buckets: int = BUCKETS) -> State:
    """The current state; an empty one if there is none."""
    found = _manifests(spark, root)
    if not found:
        return State(buckets=buckets)
    m = json.loads(files.read_text(spark, found[max(found)]))
    placed = {int(k): [v] if isinstance(v, str) else v for k, v in m["users"].items()}     # before layers: one folder
    return State(**m | {"bad_statuses": tuple(m["bad_statuses"]), "users": placed})


def _publish(spark: SparkSession, root: str, state: State) -> None:
    """A version is published once: of two updates that race, one is refused."""
    place = f"{root.rstrip('/')}/{FOLDER}/manifest/v{state.version:08d}.json"
    if not files.publish_text(spark, place, json.dumps(asdict(state))):
        raise StateError(f"another update has published version {state.version}; apply the days again")


def _read(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def _whole(folder: str) -> bool:
    """Whether a folder holds all users of a bucket; else it is a layer."""
    return folder.rsplit("/", 1)[-1].startswith("bucket=")


def _write_of(folder: str) -> str:
    return folder.rsplit("/", 1)[0] if _whole(folder) else folder


def users(spark: SparkSession, state: State, buckets: Sequence[int] | None = None, only: DataFrame | None = None) -> DataFrame:
    """The users' rows, of all or of the given buckets (only their folders are opened), or of
    the users in ``only`` (``user_id``) alone. A user's row is that of the newest layer."""
    chosen = state.users if buckets is None else {b: state.users[b] for b in buckets if b in state.users}

    def picked(rows: DataFrame) -> DataFrame:
        return rows if only is None else rows.join(only, "user_id", "left_semi")

    below = picked(_read(spark, sorted(p for paths in chosen.values() for p in paths if _whole(p)), ROWS))
    # A layer counts for the buckets that were not merged since it was written.
    holds: dict[str, list[int]] = {}
    for b, paths in sorted(chosen.items()):
        for p in paths:
            if not _whole(p):
                holds.setdefault(p, []).append(b)
    if not holds:
        return below
    alike: dict[tuple[int, ...], list[str]] = {}
    for p, held in holds.items():
        alike.setdefault(tuple(held), []).append(p)
    layers = [spark.read.schema(LAYER_ROWS).parquet(*paths).where(F.col("bucket").isin(*held)) for held, paths in alike.items()]
    newest = picked(reduce(DataFrame.unionByName, layers)).groupBy("user_id").agg(
        F.max_by(F.struct("dates", "categories", "before"), "layer").alias("_row")).select("user_id", "_row.*")
    known = newest.select("user_id")
    if only is not None or sum(state.rows.get(p, 0) for p in holds) <= BROADCAST_USERS:
        known = F.broadcast(known)
    return below.join(known, "user_id", "left_anti").unionByName(newest)


def _place_users(spark: SparkSession, old: State, due: DataFrame, n: int, touched: Sequence[int],
                 folder: str) -> tuple[dict[int, list[str]], int, DataFrame]:
    """Write the users after ``due`` (at most ``n`` changes) to ``folder``; returns the touched
    buckets' folders, the rows written and those of changed users."""
    held = {b: old.users[b] for b in touched if b in old.users}
    paths = {p for all_ in held.values() for p in all_}
    below = sum(old.rows.get(p, 0) for p in {_write_of(p) for p in paths if _whole(p)})
    above = n + sum(old.rows.get(p, 0) for p in paths if not _whole(p))
    if MERGE_SHARE * above >= below or max(map(len, held.values())) >= LAYERS:
        written = write_frame(ss.apply_changes(ss.live(users(spark, old, touched)), due, old.buckets), folder, ("bucket",))
        placed = {b: [f"{folder}/bucket={b}"] for b in touched}
        return placed, written, _read(spark, [p for x in placed.values() for p in x], ROWS).where("before IS NOT NULL")
    ids = due.select("user_id").distinct()
    previous = ss.live(users(spark, old, touched, F.broadcast(ids) if n <= BROADCAST_USERS else ids))
    changed = ss.apply_changes(previous, due, old.buckets).withColumn("layer", F.lit(old.version + 1))
    written = write_frame(changed, folder, spread=False)
    return {b: [*held.get(b, []), folder] for b in touched}, written, spark.read.schema(LAYER_ROWS).parquet(folder)


def update(spark: SparkSession, root: str, detail: DataFrame, first: str, last: str | None = None,
           bad_statuses: Sequence[str] = ("pending",), buckets: int = BUCKETS) -> State:
    """Apply the days ``first`` to ``last`` of ``detail`` (order detail with its ``dt``).

    Days applied before are replaced. An order dated after the last day applied waits until
    a day reaches it. The statuses that count as bad are part of the state: an update with
    others is refused, as is one whose detail has rows without a day.
    """
    configure(spark)
    first, last = resolve_run_date(first), resolve_run_date(last or first)
    if first > last:
        raise StateError(f"no days from {first} to {last}")
    old = load(spark, root, buckets)
    if old.version and old.bad_statuses != tuple(sorted(bad_statuses)):
        raise StateError(f"the state counts {old.bad_statuses} as bad, not {tuple(sorted(bad_statuses))}: rebuild it")
    area = f"{root.rstrip('/')}/{FOLDER}/data/v={old.version + 1:08d}-{_token()}"
    as_of = max(last, old.as_of or last)

    # The days' contributions, by day; days without orders have none, but count as applied.
    chosen = detail.where((F.col("dt") >= first) & (F.col("dt") <= last))
    one_day = first == last
    found = ss.contribution(chosen, bad_statuses)
    if one_day:
        write_frame(found.drop("dt"), f"{area}/days/dt={first}", spread=False)
        written = {first: f"{area}/days/dt={first}"}
        new = _read(spark, list(written.values()), ss.CHANGE)
    else:
        write_frame(found, f"{area}/days", spread=False)
        new = spark.read.schema(f"{ss.CHANGE}, dt string").parquet(f"{area}/days")
        written = {r["dt"]: f"{area}/days" for r in new.select("dt").distinct().collect()}   # one row per day
    replaced = {d: p for d, p in old.days.items() if first <= d <= last}
    before = None
    for path in sorted(set(replaced.values())):
        days = [d for d, p in replaced.items() if p == path]
        part = (spark.read.schema(ss.CHANGE).parquet(path) if f"dt={days[0]}" in path.rsplit("/", 1)[-1]
                else spark.read.schema(f"{ss.CHANGE}, dt string").parquet(path).where(F.col("dt").isin(days)).drop("dt"))
        before = part if before is None else before.unionByName(part)
    if before is None:
        before = _read(spark, [], ss.CHANGE)
    waiting = _read(spark, [old.waiting] if old.waiting else [], ss.CHANGE)

    # The write tells which buckets have a changed user, and whether an order has to wait.
    seen, is_due = Observation("changes"), F.col("order_date") <= F.lit(as_of).cast("date")
    bucket = F.when(is_due, ss.bucket_of(F.col("user_id"), old.buckets))
    observed = ss.difference(new, before, waiting).observe(
        seen, F.collect_set(bucket).alias("buckets"), F.count_if(~is_due).alias("waiting"))
    n = write_frame(observed, f"{area}/changes", spread=False)
    metrics = seen.get if n else {"buckets": [], "waiting": 0}
    changes = spark.read.schema(ss.CHANGE).parquet(f"{area}/changes")
    due, later = changes.where(is_due), None
    if metrics["waiting"]:
        later = f"{area}/waiting"
        write_frame(changes.where(~is_due), later)

    # Only buckets with a changed user are read and written.
    touched = sorted(metrics["buckets"])
    placed, sizes, trend = dict(old.users), dict(old.rows), old.trend
    if touched:
        folder = f"{area}/users"
        moved, sizes[folder], changed = _place_users(spark, old, due, n, touched, folder)
        placed |= moved
        needed = {_write_of(p) for paths in placed.values() for p in paths}
        sizes = {p: k for p, k in sizes.items() if p in needed}
        days = _read(spark, [old.trend] if old.trend else [], ss.TREND)
        write_frame(ss.apply_trend(days, ss.trend_change(due, changed)), f"{area}/trend")
        trend = f"{area}/trend"
    state = State(old.version + 1, old.buckets, as_of, tuple(sorted(bad_statuses)), placed, sizes,
                  {d: p for d, p in old.days.items() if d not in replaced} | written, trend, later)
    _publish(spark, root, state)
    return state


def _token() -> str:
    import uuid
    return uuid.uuid4().hex[:8]


def user_behavior(spark: SparkSession, root: str, run_ts: str | None = None, as_of: str | None = None) -> DataFrame:
    """The behaviour table from the state, one row per user. ``as_of`` may lie after the last
    day applied (days without orders), not before it."""
    state = load(spark, root)
    if state.as_of is None:
        raise StateError("no day has been applied yet")
    if as_of is not None and as_of < state.as_of:
        raise StateError(f"the state holds orders up to {state.as_of}; {as_of} is before that")
    return serving.behavior_rows(ss.user_totals(users(spark, state)), as_of or state.as_of, run_ts)


def sales_trend(spark: SparkSession, root: str, run_ts: str | None = None) -> DataFrame:
    """The sales trend from the state: it holds one row per order date."""
    state = load(spark, root)
    days = _read(spark, [state.trend] if state.trend else [], ss.TREND)
    return serving.trend_rows(ss.trend_days(days), run_ts or f"{state.as_of} 00:00:00")


def run_serving(spark: SparkSession, root: str, day: str, bad_statuses: Sequence[str] = ("pending",),
                run_ts: str | None = None) -> dict[str, int]:
    """The daily serving job: apply the day's written detail, then publish both tables."""
    day = resolve_run_date(day)
    state = update(spark, root, read_days(spark, root, DWD_ORDER_INFO, day, day), day, bad_statuses=bad_statuses)
    run_ts = run_ts or f"{state.as_of} 00:00:00"
    return {ADS_USER_BEHAVIOR_ANALYSIS.name: write_table(user_behavior(spark, root, run_ts), root,
                                                         ADS_USER_BEHAVIOR_ANALYSIS),
            ADS_SALES_TREND_ANALYSIS.name: write_table(sales_trend(spark, root, run_ts), root,
                                                       ADS_SALES_TREND_ANALYSIS, dynamic=False)}


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Remove folders that the newest manifest does not need, and older manifests; returns
    what was removed. For use when no reader or update of an older version is running."""
    state = load(spark, root)
    if not state.version:
        return []
    base = f"{root.rstrip('/')}/{FOLDER}/data"
    fs, data = files.file_system(spark, base)
    needed = {p[p.index(f"/{FOLDER}/data/"):] for p in
              [*(q for paths in state.users.values() for q in paths), *state.days.values(), state.trend, state.waiting] if p}
    gone = []
    for folder in fs.listStatus(data):
        for part in fs.listStatus(folder.getPath()):
            # days/ and users/ hold one folder per day or bucket; a backfill's days/ is one table.
            inner = fs.listStatus(part.getPath()) if part.getPath().getName() in ("days", "users") else []
            leaves = [f for f in inner if f.isDirectory()] or [part]
            for leaf in leaves:
                place = leaf.getPath().toString()
                if place[place.index(f"/{FOLDER}/data/"):] not in needed:
                    gone.append(place[place.index("/data/") + 6:])
                    fs.delete(leaf.getPath(), True)
    for version, path in _manifests(spark, root).items():
        if version != state.version:
            files.remove(spark, path)
    return gone
