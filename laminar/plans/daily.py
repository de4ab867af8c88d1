"""The daily run: raw -> detail -> summary, one day or a range of days per job.

A range is processed by the same jobs as one day (the day filter is a partition
filter on ``dt``), never by looping over days on the driver. The summaries of a large
range are made in a few passes over their days (``sinks.partitioned.day_passes``), as their
shuffles are several times the detail. Each layer is
written, then read back for the next layer: the written table cuts the lineage,
so a lost executor late in the run recomputes from the last written layer, not
from the raw extract. The caller's session is never stopped here.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.functions.parsing import resolve_run_date
from laminar.functions.rules import REFERENCE_CATEGORY_RULES
from laminar.operators.aggregates import product_daily_stats, user_daily_stats
from laminar.operators.transforms import clean_orders, clean_users
from laminar.schemas import (
    DWD_ORDER_INFO, DWD_USER_INFO, DWS_PRODUCT_DAILY_STATS, DWS_USER_DAILY_STATS, TableSpec,
)
from laminar.session import configure
from laminar.sinks import files
from laminar.sinks.partitioned import day_passes
from laminar.sinks.partitioned import write_table as plain_write
from laminar.sinks.publish import publish_day
from laminar.sources.tables import read_days, table_path


@dataclass(frozen=True)
class Days:
    """An inclusive range of run days (``first == last`` for a daily run)."""
    first: str | None
    last: str | None

    @classmethod
    def every(cls) -> "Days":
        """All landed days (a backfill)."""
        return cls(None, None)

    @classmethod
    def one(cls, day: str | None = None) -> "Days":
        d = resolve_run_date(day)
        return cls(d, d)

    def predicate(self) -> Column:
        if self.first is None and self.last is None:
            return F.lit(True)
        if self.first == self.last:
            return F.col("dt") == F.lit(self.first)
        return (F.col("dt") >= F.lit(self.first)) & (F.col("dt") <= F.lit(self.last))


def _read(spark: SparkSession, root: str, spec: TableSpec, days: Days) -> DataFrame:
    return read_days(spark, root, spec, days.first, days.last)


def _stored(spark: SparkSession, root: str, spec: TableSpec, days: Days) -> int:
    """Bytes of the range's day folders."""
    table = table_path(root, spec)
    if days.first is None and days.last is None:
        return files.size(spark, table)
    inside = [n for n in files.names(spark, table) if n.startswith("dt=")
              and (days.first is None or n[len("dt="):] >= days.first) and (days.last is None or n[len("dt="):] <= days.last)]
    return sum(files.size(spark, f"{table}/{n}") for n in inside)


def _concurrently(*jobs):
    """Run independent table writes as concurrent Spark jobs (they share the cluster)."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def _writer(publish: bool, target: dict):
    if not publish:
        return plain_write
    if "day" not in target:
        raise ValueError("only a single day can be published")
    return publish_day


def run(spark: SparkSession, root: str, days: Days,
        category_rules: Sequence[tuple[str, str]] = REFERENCE_CATEGORY_RULES,
        logins: DataFrame | None = None, products: DataFrame | None = None, publish: bool = False) -> dict[str, int]:
    """Run the detail and summary layers for ``days``; returns rows written per table.

    With ``publish`` (one day only) each table's day is written apart and switched to when it
    is complete (``sinks.publish``), so a failed run leaves the day as it was.
    """
    configure(spark)
    from laminar.schemas import ODS_ORDER_INFO, ODS_USER_INFO
    # One day replaces that day's folder; a range also clears its days that now produce no rows.
    if days.first is not None and days.first == days.last:
        target = {"day": days.first}
    else:
        target = {"day_range": (days.first, days.last)}
    write_table = _writer(publish, target)
    # Cleaning has no shuffle: a range's rows come from the day folders they go to. A lookup
    # that shuffles mixes the days, and one day is spread over its files' tasks again.
    users, orders = _concurrently(
        lambda: write_table(clean_users(_read(spark, root, ODS_USER_INFO, days)), root, DWD_USER_INFO,
                            spread="day" in target, **target),
        lambda: write_table(clean_orders(_read(spark, root, ODS_ORDER_INFO, days), category_rules, products),
                            root, DWD_ORDER_INFO, spread="day" in target or products is not None, **target))
    detail = _read(spark, root, DWD_ORDER_INFO, days)
    if logins is not None:
        logins = logins.where(days.predicate())
    passes = {} if "day" in target else {"passes": day_passes(_stored(spark, root, DWD_ORDER_INFO, days))}
    # Logins are not stored by day here: passes would read all of them again.
    user_stats, product_stats = _concurrently(
        lambda: write_table(user_daily_stats(detail, logins), root, DWS_USER_DAILY_STATS, **target,
                            **passes if logins is None else {}),
        lambda: write_table(product_daily_stats(detail), root, DWS_PRODUCT_DAILY_STATS, **target, **passes))
    return {DWD_USER_INFO.name: users, DWD_ORDER_INFO.name: orders,
            DWS_USER_DAILY_STATS.name: user_stats, DWS_PRODUCT_DAILY_STATS.name: product_stats}


def run_daily(spark: SparkSession, root: str, day: str | None = None, **kwargs) -> dict[str, int]:
    """One day (default: yesterday). A bad day string raises before any job starts."""
    return run(spark, root, Days.one(day), **kwargs)


def run_serving(spark: SparkSession, root: str, as_of: str, bad_statuses: Sequence[str] = ("pending",),
                run_ts: str | None = None, holidays: DataFrame | None = None) -> dict[str, int]:
    """Rebuild the serving layer and the date dimension from the written order detail.

    All three are full rebuilds that replace the whole table; the sales trend is
    partitioned by (year, month), and a month that no longer has orders must go as
    well. Contracts are applied strictly: a value outside a declared DECIMAL
    fails the write instead of being stored wrong.
    """
    from laminar.operators import dims, serving
    from laminar.schemas import ADS_SALES_TREND_ANALYSIS, ADS_USER_BEHAVIOR_ANALYSIS, DIM_DATE
    configure(spark)
    as_of = resolve_run_date(as_of)
    run_ts = run_ts or f"{as_of} 00:00:00"
    detail = read_days(spark, root, DWD_ORDER_INFO, None, as_of)
    behaviour, trend, dates = _concurrently(
        lambda: plain_write(serving.user_behavior(detail, as_of, bad_statuses, run_ts), root,
                            ADS_USER_BEHAVIOR_ANALYSIS),
        lambda: plain_write(serving.sales_trend(detail, run_ts), root, ADS_SALES_TREND_ANALYSIS,
                            dynamic=False),
        lambda: plain_write(dims.date_dimension(dims.date_span(detail, "order_date"), holidays), root, DIM_DATE))
    return {ADS_USER_BEHAVIOR_ANALYSIS.name: behaviour, ADS_SALES_TREND_ANALYSIS.name: trend,
            DIM_DATE.name: dates}
