"""Data-quality checks as DataFrames: completeness, consistency, accuracy, report, gate.

Every check reads one aggregate per table keyed by the partition day ``dt`` (a
*day profile*): the row count, the null count of every column, and where a check
needs it, the distinct user count or the counts of invalid amounts and dates. A
report builds one profile per table and derives every finding from these small
per-day frames, so each table is scanned **once** for the whole report, whatever
the number of columns, checks or days. (The profile is referenced by several
findings; Spark reuses its shuffle instead of recomputing it.) Only a few rows
per day cross the shuffle, since the partial aggregate runs map-side.

Severity rules (fixed): an empty table partition or a missing table is FAIL;
threshold breaches are WARN. A report's status is FAIL iff it has a FAIL finding.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Thresholds of the checks.
NULL_RATIO_WARN_ABOVE = 0.1        # completeness: WARN when null ratio > 10 %
RETENTION_WARN_BELOW = 0.95        # consistency: WARN when detail/raw order ratio < 95 %
DEFAULT_MIN_ORDER_DATE = "2020-01-01"

# The six tables a report checks, in report order.
CHECKED_TABLES = ("ods_user_info", "ods_order_info", "dwd_user_info", "dwd_order_info",
                  "dws_user_daily_stats", "dws_product_daily_stats")
RAW_TABLES = ("ods_user_info", "ods_order_info")
USER_TABLES = ("ods_user_info", "dwd_user_info")          # compared on distinct user ids
ORDER_TABLES = ("ods_order_info", "dwd_order_info")       # compared on row counts
ACCURACY_TABLE = "dwd_order_info"

FINDING_SCHEMA = T.StructType([
    T.StructField("check_date", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("metric", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("severity", T.StringType()),
])


class QualityGateError(RuntimeError):
    pass


# ---------------------------------------------------------------- day profile
@dataclass(frozen=True)
class DayProfile:
    """Per-day aggregate of one table: ``dt, total_count, _n0.._nk`` (null counts
    of ``columns``), optionally ``distinct_count`` and one count per condition."""
    frame: DataFrame
    columns: tuple[str, ...]


def day_profile(df: DataFrame, columns: Sequence[str] | None = None, distinct_of: str | None = None,
                conditions: Mapping[str, Column] | None = None) -> DayProfile:
    """Profile ``df`` per day in one aggregate (one pass over the table).

    ``columns`` defaults to every column but ``dt``. With ``distinct_of``, Spark
    first groups by (dt, that column), which spreads a hot day over many tasks,
    and computes the other counts in the same pass.
    """
    cols = tuple(c for c in df.columns if c != "dt") if columns is None else tuple(columns)
    aggs = [F.count(F.lit(1)).alias("total_count"),
            *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]]
    if distinct_of is not None:
        aggs.append(F.countDistinct(distinct_of).alias("distinct_count"))
    for name, cond in (conditions or {}).items():
        aggs.append(F.count_if(cond).alias(name))
    return DayProfile(df.groupBy("dt").agg(*aggs), cols)


def completeness_of(profile: DayProfile, table_name: str,
                    threshold: float = NULL_RATIO_WARN_ABOVE) -> DataFrame:
    """``(check_date, table_name, column_name, total_count, null_count, null_ratio, breached)``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
                      for i, c in enumerate(profile.columns)])
    ratio = F.col("null_count").cast("double") / F.col("total_count").cast("double")
    return (profile.frame.select("dt", "total_count", F.inline(pairs))
                   .select(F.col("dt").alias("check_date"), F.lit(table_name).alias("table_name"),
                           "column_name", "total_count", "null_count",
                           ratio.alias("null_ratio"), (ratio > F.lit(threshold)).alias("breached")))


def completeness(df: DataFrame, table_name: str, exclude: Sequence[str] = ("dt",),
                 threshold: float = NULL_RATIO_WARN_ABOVE) -> DataFrame:
    """Null ratio of every column per day. Days with no rows do not appear (they
    are reported as empty partitions)."""
    return completeness_of(day_profile(df, [c for c in df.columns if c not in exclude]), table_name, threshold)


def user_consistency_of(ods: DayProfile, dwd: DayProfile) -> DataFrame:
    o_p = ods.frame.select("dt", F.col("distinct_count").alias("ods_users"))
    d_p = dwd.frame.select("dt", F.col("distinct_count").alias("dwd_users"))
    j = o_p.join(d_p, "dt", "full_outer")
    o, d = F.coalesce("ods_users", F.lit(0)), F.coalesce("dwd_users", F.lit(0))
    return j.select(F.col("dt").alias("check_date"), o.alias("ods_users"), d.alias("dwd_users"),
                    (o == d).alias("consistent"))


def user_consistency(ods_users: DataFrame, dwd_users: DataFrame) -> DataFrame:
    """Distinct user ids per day in raw vs detail; NULL ids are ignored on both sides."""
    return user_consistency_of(day_profile(ods_users, (), "user_id"), day_profile(dwd_users, (), "user_id"))


def order_retention_of(ods: DayProfile, dwd: DayProfile, threshold: float = RETENTION_WARN_BELOW) -> DataFrame:
    o_p = ods.frame.select("dt", F.col("total_count").alias("ods_rows"))
    d_p = dwd.frame.select("dt", F.col("total_count").alias("dwd_rows"))
    j = o_p.join(d_p, "dt", "full_outer")
    return _retention(j, threshold)


def _retention(counts: DataFrame, threshold: float) -> DataFrame:
    o, d = F.coalesce("ods_rows", F.lit(0)), F.coalesce("dwd_rows", F.lit(0))
    ratio = F.when(o > 0, d.cast("double") / o.cast("double")).otherwise(F.lit(0.0))
    return counts.select(F.col("dt").alias("check_date"), o.alias("ods_rows"), d.alias("dwd_rows"),
                    ratio.alias("retention_ratio"), (ratio < F.lit(threshold)).alias("breached"))


def order_retention(ods_orders: DataFrame, dwd_orders: DataFrame,
                    threshold: float = RETENTION_WARN_BELOW) -> DataFrame:
    """Detail rows / raw rows per day (0 when the raw day is empty); breach when < threshold."""
    return order_retention_of(day_profile(ods_orders, ()), day_profile(dwd_orders, ()), threshold)


def order_retention_one_pass(ods_orders: DataFrame, valid: Column,
                             threshold: float = RETENTION_WARN_BELOW) -> DataFrame:
    """The same rows as ``order_retention(ods, ods.where(valid))`` from one read of the raw
    orders: two conditional counts per day."""
    counts = ods_orders.groupBy("dt").agg(F.count(F.lit(1)).alias("ods_rows"), F.count_if(valid).alias("dwd_rows"))
    return _retention(counts, threshold)


def accuracy_conditions(as_of: str, min_date: str = DEFAULT_MIN_ORDER_DATE) -> dict[str, Column]:
    """Invalid amounts (any of total, price, quantity <= 0) and order dates outside
    [min_date, as_of]. NULL operands do not match on their own."""
    bad_amount = (F.col("total_amount") <= 0) | (F.col("unit_price") <= 0) | (F.col("quantity") <= 0)
    od = F.col("order_date")
    bad_date = (od > F.lit(as_of).cast("date")) | (od < F.lit(min_date).cast("date"))
    return {"invalid_amounts": bad_amount, "invalid_dates": bad_date}


def accuracy_of(profile: DayProfile) -> DataFrame:
    return profile.frame.select(F.col("dt").alias("check_date"), "invalid_amounts", "invalid_dates")


def accuracy(dwd_orders: DataFrame, as_of: str, min_date: str = DEFAULT_MIN_ORDER_DATE) -> DataFrame:
    """Invalid amounts and dates counted per day in one conditional aggregate."""
    return accuracy_of(day_profile(dwd_orders, (), conditions=accuracy_conditions(as_of, min_date)))


# ---------------------------------------------------------------- report
def _profiles(tables: Mapping[str, DataFrame], present: Sequence[str], as_of: str,
              min_date: str) -> dict[str, DayProfile]:
    """One profile per readable table, carrying what every check on it needs."""
    out = {}
    for name in present:
        df = tables[name]
        distinct_of = "user_id" if name in USER_TABLES and "user_id" in df.columns else None
        conds = accuracy_conditions(as_of, min_date) if name == ACCURACY_TABLE else None
        out[name] = day_profile(df, None, distinct_of, conds)
    return out


def _wide(spark: SparkSession, profiles: Mapping[str, DayProfile], run_days: Sequence[str]) -> DataFrame:
    """All profiles side by side, one row per day (full outer joins on ``dt`` of
    frames holding one row per day), with ``_run_day``: the day landed in a raw
    table or was requested (a scheduled day on which nothing landed is checked too)."""
    wide = None
    for name, prof in profiles.items():
        f = prof.frame
        renamed = f.select("dt", *[F.col(c).alias(f"{name}__{c}") for c in f.columns if c != "dt"])
        wide = renamed if wide is None else wide.join(renamed, "dt", "full_outer")
    run_day = [F.col(f"{n}__total_count").isNotNull() for n in RAW_TABLES if n in profiles]
    if run_days:
        asked = spark.createDataFrame([(d, True) for d in run_days], "dt string, _asked boolean")
        wide = asked if wide is None else wide.join(asked, "dt", "full_outer")
        run_day.append(F.col("_asked").isNotNull())
    if not run_day:
        raise ValueError("no raw table and no run day to check")
    flag = run_day[0]
    for c in run_day[1:]:
        flag = flag | c
    return wide.withColumn("_run_day", flag)


def _entry(cond: Column, check: str, table: str, column: str | None, metric, threshold: float | None,
           severity: str) -> Column:
    """A finding (struct), or NULL when ``cond`` does not hold."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(cond, F.struct(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"), as_col(metric).cast("double").alias("metric"),
        F.lit(threshold).cast("double").alias("threshold"), F.lit(severity).alias("severity")))


def _entries(profiles: Mapping[str, DayProfile]) -> list[Column]:
    """Every check of the report as a conditional finding over one wide day row."""
    c = lambda name, field: F.col(f"{name}__{field}")
    run_day = F.col("_run_day")
    out = []
    for name in CHECKED_TABLES:
        if name not in profiles:
            out.append(_entry(run_day, "table_missing", name, None, None, None, "FAIL"))
            continue
        total = c(name, "total_count")
        out.append(_entry(run_day & total.isNull(), "empty_partition", name, None, 0.0, None, "FAIL"))
        for i, column in enumerate(profiles[name].columns):
            ratio = c(name, f"_n{i}").cast("double") / total.cast("double")
            out.append(_entry(total.isNotNull() & (ratio > F.lit(NULL_RATIO_WARN_ABOVE)), "null_ratio", name,
                              column, ratio, NULL_RATIO_WARN_ABOVE, "WARN"))
    if all(n in profiles and "distinct_count" in profiles[n].frame.columns for n in USER_TABLES):
        o, d = (F.coalesce(c(n, "distinct_count"), F.lit(0)) for n in USER_TABLES)
        out.append(_entry(o != d, "user_consistency", "dwd_user_info", "user_id", d - o, 0.0, "WARN"))
    if all(n in profiles for n in ORDER_TABLES):
        o, d = (F.coalesce(c(n, "total_count"), F.lit(0)) for n in ORDER_TABLES)
        seen = c(ORDER_TABLES[0], "total_count").isNotNull() | c(ORDER_TABLES[1], "total_count").isNotNull()
        ratio = F.when(o > 0, d.cast("double") / o.cast("double")).otherwise(F.lit(0.0))
        out.append(_entry(seen & (ratio < F.lit(RETENTION_WARN_BELOW)), "order_retention", "dwd_order_info",
                          None, ratio, RETENTION_WARN_BELOW, "WARN"))
    if ACCURACY_TABLE in profiles:
        amounts, dates = c(ACCURACY_TABLE, "invalid_amounts"), c(ACCURACY_TABLE, "invalid_dates")
        out.append(_entry(F.coalesce(amounts, F.lit(0)) > 0, "amount_accuracy", ACCURACY_TABLE, None,
                          amounts, 0.0, "WARN"))
        out.append(_entry(F.coalesce(dates, F.lit(0)) > 0, "date_accuracy", ACCURACY_TABLE, "order_date",
                          dates, 0.0, "WARN"))
    return out


def _assess(tables: Mapping[str, DataFrame], as_of: str, min_date: str, missing: Sequence[str],
            run_days: Sequence[str]) -> DataFrame:
    """``dt, _run_day, _found``: the findings of each day as an array, from one
    profile per table (each table is read once)."""
    # before any table was ever written, every table is missing: FAIL findings on the run days
    spark = next(iter(tables.values())).sparkSession if tables else SparkSession.getActiveSession()
    if spark is None:
        raise ValueError("no table to check and no active session")
    present = [n for n in CHECKED_TABLES if n in tables and n not in missing]
    profiles = _profiles(tables, present, as_of, min_date)
    wide = _wide(spark, profiles, run_days)
    found = F.filter(F.array(*_entries(profiles)), lambda x: x.isNotNull())
    return wide.select("dt", "_run_day", found.alias("_found"))


def findings(tables: Mapping[str, DataFrame], as_of: str, min_date: str = DEFAULT_MIN_ORDER_DATE,
             missing: Sequence[str] = (), run_days: Sequence[str] = ()) -> DataFrame:
    """All findings of a report, one row each (``FINDING_SCHEMA``).

    ``tables`` maps each of ``CHECKED_TABLES`` to its frame; names in ``missing``
    (tables that could not be read) or absent from ``tables`` become FAIL findings
    on every run day.
    """
    days = _assess(tables, as_of, min_date, missing, run_days)
    return (days.select(F.col("dt").alias("check_date"), F.inline("_found"))
                .select(*FINDING_SCHEMA.fieldNames()))


def report(tables: Mapping[str, DataFrame], as_of: str, min_date: str = DEFAULT_MIN_ORDER_DATE,
           missing: Sequence[str] = (), run_days: Sequence[str] = ()) -> DataFrame:
    """One row per run day: tables_checked, fail_count, warn_count, overall_status."""
    days = _assess(tables, as_of, min_date, missing, run_days).where("_run_day")
    count = lambda pred: F.size(F.filter("_found", pred)).cast("bigint")
    fails = count(lambda x: x["severity"] == "FAIL")
    unchecked = count(lambda x: x["check_name"].isin("empty_partition", "table_missing"))
    return days.select(
        F.col("dt").alias("check_date"),
        (F.lit(len(CHECKED_TABLES)).cast("bigint") - unchecked).alias("tables_checked"),
        fails.alias("fail_count"),
        count(lambda x: x["severity"] == "WARN").alias("warn_count"),
        F.when(fails > 0, "FAIL").otherwise("PASS").alias("overall_status"),
    )


def report_from_findings(found: DataFrame, dates: DataFrame) -> DataFrame:
    """The report of ``dates`` (column ``check_date``) from findings already computed,
    e.g. the persisted findings table, so the gate does not re-read the checked tables."""
    per_day = found.groupBy("check_date").agg(
        F.count_if(F.col("severity") == "FAIL").alias("fail_count"),
        F.count_if(F.col("severity") == "WARN").alias("warn_count"),
        F.count_if(F.col("check_name").isin("empty_partition", "table_missing")).alias("_unchecked"),
    )
    j = dates.join(per_day, "check_date", "left")
    zero = F.lit(0).cast("bigint")
    fails = F.coalesce("fail_count", zero)
    return j.select(
        "check_date",
        (F.lit(len(CHECKED_TABLES)).cast("bigint") - F.coalesce("_unchecked", zero)).alias("tables_checked"),
        fails.alias("fail_count"),
        F.coalesce("warn_count", zero).alias("warn_count"),
        F.when(fails > 0, "FAIL").otherwise("PASS").alias("overall_status"),
    )


def assert_quality(report_df: DataFrame, strict: bool = False) -> None:
    """The gate: raise when any day FAILs (or, when strict, has any WARN).

    Only the number of offending days and a few of their dates reach the driver.
    """
    bad = F.col("overall_status") == "FAIL"
    if strict:
        bad = bad | (F.col("warn_count") > 0)
    offenders = report_df.where(bad)
    sample = [r["check_date"] for r in offenders.select("check_date").orderBy("check_date").limit(5).collect()]
    if sample:
        n = offenders.count()
        raise QualityGateError(f"data quality gate failed on {n} day(s), e.g. {sample}")


def missing_tables(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    """Names whose table folder does not exist (reported as FAIL findings, not raised).

    Only the table folder is looked up: opening the table would list every day
    it has ever had. A table that exists but cannot be read fails the run when its
    check reads it, as an unexpected error should.
    """
    from laminar.session import path_exists
    return [name for name, p in paths.items() if not path_exists(spark, p)]
