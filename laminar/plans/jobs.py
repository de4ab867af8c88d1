"""Command-line jobs (spark-submit entry points).

    spark-submit -m laminar.plans.jobs setup
    spark-submit -m laminar.plans.jobs extract  --date 2024-12-26 --users PATH --orders PATH
    spark-submit -m laminar.plans.jobs etl      --date 2024-12-26 [--root PATH] [--logins PATH] [--products PATH]
    spark-submit -m laminar.plans.jobs quality  --date 2024-12-26 [--as-of D] [--strict]
    spark-submit -m laminar.plans.jobs serving  --as-of 2024-12-26      # full rebuild
    spark-submit -m laminar.plans.jobs serving  --date 2024-12-26 --incremental
    spark-submit -m laminar.plans.jobs active   --date 2024-12-26       # the day's active users, as bitmaps
    spark-submit -m laminar.plans.jobs report   --date 2024-12-26

``--date`` defaults to yesterday. ``--root`` defaults to the shared folder named by
``spark.checkpoint.dir``. The quality job persists its findings (partitioned by
check_date) and exits with status 1 when the day FAILs, so a scheduler stops the
chain there. A session the job creates is stopped at the end; a caller's session is left running.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.functions.parsing import resolve_run_date
from laminar.functions.rules import REFERENCE_CATEGORY_RULES
from laminar.operators import quality, reports
from laminar.plans import active_users, catalog, daily, incremental
from laminar.schemas import (DWD_ORDER_INFO, DWD_USER_INFO, DWS_PRODUCT_DAILY_STATS, DWS_USER_DAILY_STATS,
                             ODS_ORDER_INFO, ODS_USER_INFO, TableSpec)
from laminar.session import build_session, storage_root
from laminar.sinks.partitioned import land, write_frame, write_range
from laminar.sources.tables import read_table, table_path

CHECKED_SPECS: tuple[TableSpec, ...] = (ODS_USER_INFO, ODS_ORDER_INFO, DWD_USER_INFO, DWD_ORDER_INFO,
                                        DWS_USER_DAILY_STATS, DWS_PRODUCT_DAILY_STATS)


Source = Callable[[SparkSession, str], DataFrame]


def extract(spark: SparkSession, root: str, day: str, sources: Mapping[str, Source]) -> dict[str, int]:
    """Step 1: take one day's rows from each source and land them in the raw layer.

    ``sources`` maps a raw table's name to a callable ``(spark, day) -> DataFrame``, e.g.
    around ``read_jdbc`` with a predicate on the day. A table that the catalog has gets the
    day's partition.
    """
    specs = {s.name: s for s in (ODS_USER_INFO, ODS_ORDER_INFO)}
    unknown = set(sources) - set(specs)
    if unknown:
        raise ValueError(f"not a raw table: {sorted(unknown)}")
    out = {name: land(read(spark, day), root, specs[name], day=day) for name, read in sources.items()}
    catalog.register(spark, [specs[n] for n in sources], day)
    return out


def day_of_files(path: str) -> Source:
    """A source over exported Parquet files: all rows, or those of the day if they carry ``dt``."""
    def read(spark: SparkSession, day: str) -> DataFrame:
        rows = spark.read.parquet(path)
        return rows.where(F.col("dt") == F.lit(day)).drop("dt") if "dt" in rows.columns else rows
    return read


def run_etl(spark: SparkSession, root: str, day: str, logins: DataFrame | None = None,
            products: DataFrame | None = None, publish: bool = False) -> dict[str, int]:
    """The daily run, with the day registered in the catalog tables that exist."""
    written = daily.run_daily(spark, root, day, category_rules=REFERENCE_CATEGORY_RULES, logins=logins, products=products,
                              publish=publish)
    catalog.register(spark, CHECKED_SPECS, day)
    return written


def quality_for_day(spark: SparkSession, root: str, day: str, as_of: str | None = None,
                    min_date: str = quality.DEFAULT_MIN_ORDER_DATE):
    """(findings, report) for one run day over the written tables; unreadable tables are FAIL."""
    missing = quality.missing_tables(spark, {s.name: table_path(root, s) for s in CHECKED_SPECS})
    tables = {s.name: read_table(spark, root, s, day) for s in CHECKED_SPECS if s.name not in missing}
    as_of = as_of or day
    # the run day is checked even when nothing landed for it (then every table is empty: FAIL)
    return (quality.findings(tables, as_of, min_date, missing, run_days=[day]),
            quality.report(tables, as_of, min_date, missing, run_days=[day]))


FINDINGS_TABLE = "dq.db/dq_findings"


def persist_findings(found: DataFrame, root: str, day: str | None = None,
                     day_range: tuple[str | None, str | None] = (None, None)) -> str:
    """Write findings partitioned by check day.

    For a run ``day`` the day's folder is replaced outright, even when the day has
    no finding: a dynamic partition overwrite writes nothing for an empty day and
    would keep the rows of an earlier run of it. Without ``day`` (a backfill over
    ``day_range``), the range's days are replaced, those without a finding included.
    """
    path = f"{root.rstrip('/')}/{FINDINGS_TABLE}"
    if day is None:
        write_range(found, path, "check_date", day_range)
    else:
        write_frame(found.where(F.col("check_date") == F.lit(day)).drop("check_date"), f"{path}/check_date={day}")
    return path


def read_findings(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Persisted findings with ``check_date`` kept a string (inference would make it a DATE).
    With ``day``, only that day's folder is opened."""
    reader = spark.read.schema(quality.FINDING_SCHEMA)
    if day is None:
        return reader.parquet(path)
    return reader.option("basePath", path).parquet(f"{path}/check_date={day}") \
                 .where(F.col("check_date") == F.lit(day))


def run_quality(spark: SparkSession, root: str, day: str, as_of: str | None = None,
                min_date: str = quality.DEFAULT_MIN_ORDER_DATE) -> DataFrame:
    """Check one day, persist its findings, and return the day's report.

    The checked tables are read once, by the findings write; the report and the gate
    read the small persisted findings of the day.
    """
    found, _ = quality_for_day(spark, root, day, as_of, min_date)
    path = persist_findings(found, root, day)
    dates = spark.createDataFrame([(day,)], "check_date string")
    return quality.report_from_findings(read_findings(spark, path, day), dates)


def run_report(spark: SparkSession, root: str, day: str):
    """RPT-1: rows per layer table for the day."""
    return reports.layer_row_counts({s.name: (s.database.split("_")[0].upper(), read_table(spark, root, s, day))
                                     for s in (DWD_USER_INFO, DWD_ORDER_INFO, DWS_USER_DAILY_STATS,
                                               DWS_PRODUCT_DAILY_STATS)})


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="laminar")
    p.add_argument("job", choices=["setup", "extract", "etl", "quality", "serving", "active", "report"])
    p.add_argument("--date", default=None)
    p.add_argument("--as-of", default=None)
    p.add_argument("--min-date", default=quality.DEFAULT_MIN_ORDER_DATE)
    p.add_argument("--root", default=None)
    for name, what in (("users", "extract: exported user records"), ("orders", "extract: exported order records"),
                       ("logins", "etl: logins (dt, user_id, login_count)"),
                       ("products", "etl: product dimension (product_id, category_id)")):
        p.add_argument(f"--{name}", default=None, help=f"{what}, a Parquet path")
    p.add_argument("--incremental", action="store_true", help="serving: apply the day's detail to the serving state")
    p.add_argument("--publish", action="store_true", help="etl: write the day apart and switch to it when complete")
    p.add_argument("--strict", action="store_true", help="quality: WARN also fails the gate")
    args = p.parse_args(argv)
    owned = SparkSession.getActiveSession() is None
    spark = build_session(app_name=f"laminar-{args.job}")
    try:
        root = args.root or storage_root(spark)
        day = resolve_run_date(args.date)
        if args.job == "setup":
            print(catalog.setup(spark, root))
        elif args.job == "extract":
            given = {ODS_USER_INFO.name: args.users, ODS_ORDER_INFO.name: args.orders}
            print(extract(spark, root, day, {n: day_of_files(path) for n, path in given.items() if path}))
        elif args.job == "etl":
            logins, products = (spark.read.parquet(x) if x else None for x in (args.logins, args.products))
            print(run_etl(spark, root, day, logins, products, args.publish))
            run_report(spark, root, day).orderBy("layer", "table_name").show(truncate=False)
        elif args.job == "quality":
            rep = run_quality(spark, root, day, args.as_of, args.min_date)
            rep.show(truncate=False)
            try:
                quality.assert_quality(rep, strict=args.strict)
            except quality.QualityGateError as exc:
                print(exc, file=sys.stderr)
                return 1
        elif args.job == "active":
            print(active_users.run_day(spark, root, day))
        elif args.job == "serving" and args.incremental:
            print(incremental.run_serving(spark, root, day))
        elif args.job == "serving":
            print(daily.run_serving(spark, root, args.as_of or day))
        else:
            run_report(spark, root, day).orderBy("layer", "table_name").show(truncate=False)
        return 0
    finally:
        if owned:      # never stop a session the caller created
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
