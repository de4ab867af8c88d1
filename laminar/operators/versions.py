"""Dimension history: versions with their validity, and rows looked up as of their time.

A version is valid from its time up to the next version that differs (``valid_to``, exclusive;
NULL for the current one). A fact gets the version that was valid at its own time.

Scale
- One key may hold a large share of the versions or of the facts, so no window runs over all
  rows of a key. Neighbours are found within a (key, month) or (key, day) group; what a group
  needs from the others is one row per group (an aggregate combined before the shuffle), and
  only those rows, bounded by the calendar, meet in a window per key.
- The lookup is a union and a running last value, not a range join: facts and versions of one key
  and day are sorted once, so many facts and many versions of a day do not multiply. Its join
  with the carried versions has the window's own partitioning and adds no shuffle of the facts.

Defined results: versions without a key or time say nothing and are left out. Of versions with the
same key and time the one with the greatest attributes counts (NULL is least); repeated versions
and unchanged ones merge into the earlier one. A fact without a key or time, or before the first
version, has NULL attributes; facts keep their columns and repeated facts stay as they are. A
version is valid at the very time it starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _beside(rows: DataFrame, key: str, at: str, value: Column, into: str, following: bool) -> DataFrame:
    """``rows`` (unique by key and ``at``) with ``value``, which is never NULL, of the key's next or previous row."""
    step, edge = (F.lead, F.min) if following else (F.lag, F.max)
    months = rows.withColumn("_value", value).withColumn("_month", F.date_trunc("month", at))
    edges = months.groupBy(key, "_month").agg(edge(F.struct(at, "_value")).alias("_edge"))
    across = edges.select(key, "_month", step("_edge").over(Window.partitionBy(key).orderBy("_month")).alias("_across"))
    near = step("_value").over(Window.partitionBy(key, "_month").orderBy(at))
    return (months.withColumn("_near", near).join(across, [key, "_month"])
            .withColumn(into, F.coalesce("_near", F.col("_across._value"))).drop("_value", "_month", "_near", "_across"))


def validity(versions: DataFrame, key: str, at: str, attributes: Sequence[str]) -> DataFrame:
    """(key, attributes, valid_from, valid_to, is_current): one row per version that differs
    from the one before."""
    state = F.struct(*attributes)
    one = (versions.where(F.col(key).isNotNull() & F.col(at).isNotNull()).groupBy(key, F.col(at).alias("valid_from"))
           .agg(F.max(state).alias("_state")))
    known = _beside(one, key, "valid_from", F.col("_state"), "_before", following=False)
    changed = known.where(~F.col("_state").eqNullSafe(F.col("_before"))).drop("_before")
    ended = _beside(changed, key, "valid_from", F.col("valid_from"), "valid_to", following=True)
    return ended.select(key, *[F.col(f"_state.{c}").alias(c) for c in attributes], "valid_from", "valid_to",
                        F.col("valid_to").isNull().alias("is_current"))


def as_of(facts: DataFrame, history: DataFrame, key: str, at: str, attributes: Sequence[str],
          suffix: str = "_as_of") -> DataFrame:
    """``facts`` with every attribute of the version of ``history`` valid at their time, as
    ``<attribute><suffix>``, and the start of that version as ``version_from``."""
    row = F.struct(*facts.columns)
    state = F.struct(*attributes, "valid_from")
    timed = F.col(key).isNotNull() & F.col(at).isNotNull()
    told = history.select(F.col(key).alias("_key"), F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"),
                          F.lit(None).cast(facts.select(row.alias("r")).schema["r"].dataType).alias("_row"),
                          state.alias("_version"))
    asked = facts.where(timed).select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
                                      row.alias("_row"), F.lit(None).cast(told.schema["_version"].dataType).alias("_version"))
    both = told.unionByName(asked).withColumn("_day", F.to_date("_at"))
    days = both.groupBy("_key", "_day").agg(
        F.max(F.when(F.col("_kind") == 0, F.struct("_at", "_version"))).alias("_latest"))
    earlier = Window.partitionBy("_key").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("_key", "_day", F.last("_latest", ignorenulls=True).over(earlier)["_version"].alias("_carried"))
    so_far = (Window.partitionBy("_key", "_day").orderBy("_at", "_kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = both.withColumn("_seen", F.last("_version", ignorenulls=True).over(so_far)).where("_kind = 1")
    found = seen.join(carried, ["_key", "_day"]).withColumn("_v", F.coalesce("_seen", "_carried"))
    kept = [F.col("_row").getField(c).alias(c) for c in facts.columns]
    looked_up = [F.col("_v").getField(c).alias(c + suffix) for c in attributes]
    out = found.select(*kept, *looked_up, F.col("_v.valid_from").alias("version_from"))
    unknown = [F.lit(None).cast(out.schema[c + suffix].dataType).alias(c + suffix) for c in attributes]
    untimed = facts.where(~timed).select("*", *unknown, F.lit(None).cast(out.schema["version_from"].dataType).alias("version_from"))
    return out.unionByName(untimed)
