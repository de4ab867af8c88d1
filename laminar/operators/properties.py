"""The behaviour fact with all properties of an event, declared or not.

Properties are kept as a VARIANT: parsed once, nested values and unknown names included, and read by
path. Text that is no JSON is kept beside it and counted, never dropped.

Defined results: a NULL property text has NULL properties and is not malformed. A JSON value that is
no object (a number, a list) is kept and has no named properties. A JSON null is a value of kind
``null``. Parsing is a projection and the profile one aggregate combined before the shuffle, so a
hot event type or property sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def open_behavior_fact(events: DataFrame) -> DataFrame:
    """Typed events; ``props`` a VARIANT, ``props_malformed`` the text that is no JSON."""
    ts = F.col("ts").cast("timestamp")
    parsed = F.try_parse_json("props")
    return events.select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), "event_type", ts.alias("event_ts"),
        F.to_date(ts).alias("event_date"), "value", parsed.alias("props"),
        F.when(parsed.isNull(), F.col("props")).alias("props_malformed"),
        F.date_format(ts, "yyyy-MM-dd").alias("dt"))


def property_profile(fact: DataFrame) -> DataFrame:
    """Per event type, property name and kind of value: how often, and the range of the numbers."""
    kind = F.schema_of_variant("value")
    named = fact.sparkSession.tvf.variant_explode(F.col("props").outer())
    objects = fact.where(F.schema_of_variant("props").startswith("OBJECT")).select("event_type", "props")
    each = objects.lateralJoin(named).select("event_type", F.col("key").alias("property"), (
        F.when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)"), "number").when(kind == "STRING", "text")
        .when(kind == "BOOLEAN", "truth").when(kind.startswith("ARRAY"), "list").when(kind.startswith("OBJECT"), "object")
        .otherwise("null")).alias("kind"), F.try_variant_get("value", "$", "double").alias("_x"))
    number = F.when(F.col("kind") == "number", F.col("_x"))
    return each.groupBy("event_type", "property", "kind").agg(
        F.count(F.lit(1)).alias("occurrences"), F.min(number).alias("least"), F.max(number).alias("greatest"))


def malformed_counts(fact: DataFrame) -> DataFrame:
    """Events with malformed properties per day."""
    return fact.where("props_malformed IS NOT NULL").groupBy("dt").agg(F.count(F.lit(1)).alias("malformed"))
