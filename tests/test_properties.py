"""The behaviour fact keeps every property: nested, unknown, malformed and missing ones."""

import datetime as dt
import json

from laminar.operators import properties

AT = dt.datetime(2024, 3, 1, 8)
TEXTS = ['{"k": 3, "new": {"deep": [1, {"x": "y"}]}}', '{"k": 7.5, "flag": true, "none": null}', '{"k": "three", "list": []}',
         "not json", "", None, "[1, 2]", "5", "{}"]


def fact_of(spark, area, texts):
    rows = [(i, 1, AT, "view", 1.0, t) for i, t in enumerate(texts)]
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts timestamp, event_type string, value double, props string")
    properties.open_behavior_fact(events).write.mode("overwrite").parquet(area)
    return spark.read.parquet(area)


def test_all_properties_survive_the_written_fact(spark, area):
    rows = {r["event_id"]: r for r in fact_of(spark, area, TEXTS).collect()}
    for i, text in enumerate(TEXTS):
        if text in ("not json", ""):
            assert rows[i]["props"] is None and rows[i]["props_malformed"] == text
        elif text is None:
            assert rows[i]["props"] is None and rows[i]["props_malformed"] is None
        else:
            assert json.loads(rows[i]["props"].toJson()) == json.loads(text) and rows[i]["props_malformed"] is None


def test_profile_and_malformed_counts(spark, area):
    fact = fact_of(spark, area, TEXTS)
    got = {(r["property"], r["kind"]): (r["occurrences"], r["least"], r["greatest"])
           for r in properties.property_profile(fact).collect()}
    assert got == {("k", "number"): (2, 3.0, 7.5), ("k", "text"): (1, None, None), ("new", "object"): (1, None, None),
                   ("flag", "truth"): (1, None, None), ("none", "null"): (1, None, None), ("list", "list"): (1, None, None)}
    assert [tuple(r) for r in properties.malformed_counts(fact).collect()] == [("2024-03-01", 2)]


def test_empty_events(spark, area):
    fact = fact_of(spark, area, [])
    assert properties.property_profile(fact).count() == 0 and properties.malformed_counts(fact).count() == 0
