"""Hot keys: one user and one product hold a third of all orders.

The fixture is derived from the driver tables. Joins are forced to sort-merge, and
AQE's skew thresholds are lowered so that the skew split actually runs at this size.
Every result must equal the one computed under the default settings, and the hot
keys' totals must equal a brute-force count.
"""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from laminar.functions.rules import SCALE_CATEGORY_RULES
from laminar.operators import dims, serving
from laminar.operators.aggregates import product_daily_stats, user_daily_stats
from laminar.operators.transforms import clean_orders
from laminar.sources.testdata import load_ods, table

HOT_USER, HOT_PRODUCT = "1", "1"        # both exist in the customer and part masters

FORCED_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    # several map tasks even for this tiny input: a split is by map tasks
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed(spark):
    ods = load_ods(spark, SF_SMALL)["ods_order_info"]
    hot = F.xxhash64("order_id", "product_id", "quantity") % 3 == 0
    return (ods.withColumn("user_id", F.when(hot & F.col("user_id").isNotNull(), F.lit(HOT_USER))
                                       .otherwise(F.col("user_id")))
               .withColumn("product_id", F.when(hot, F.lit(HOT_PRODUCT)).otherwise(F.col("product_id"))))


def _frames(spark, ods):
    detail = clean_orders(ods, SCALE_CATEGORY_RULES)
    dim = dims.product_dimension(table(spark, SF_SMALL, "part"), SCALE_CATEGORY_RULES)
    geo = dims.geography(table(spark, SF_SMALL, "customer"), table(spark, SF_SMALL, "nation"),
                         table(spark, SF_SMALL, "region"))
    return {
        "user_daily": user_daily_stats(detail),
        "product_daily": product_daily_stats(detail),
        "behaviour": serving.user_behavior(detail, "2001-08-01", ("P",), "2001-08-01 00:00:00"),
        "trend": serving.sales_trend(detail, "2001-08-02 00:00:00"),
        "geo": dims.sales_by_geography(detail, geo),
        "dim_lookup": clean_orders(ods, products=dim).groupBy("category_id").agg(
            F.count("order_id").alias("n"), F.sum("final_amount").alias("amount")),
    }


def _rows(df):
    return sorted(tuple(repr(v) for v in r) for r in df.collect())


def test_hot_keys_hold_a_third(skewed):
    n = skewed.count()
    assert skewed.where(F.col("product_id") == HOT_PRODUCT).count() > n / 4
    assert skewed.where(F.col("user_id") == HOT_USER).count() > n / 4


def test_results_equal_under_forced_skew_split(spark, skewed):
    expected = {k: _rows(v) for k, v in _frames(spark, skewed).items()}
    with conf(spark, FORCED_SKEW):
        frames = _frames(spark, skewed)
        got = {k: _rows(v) for k, v in frames.items()}
        plan = frames["dim_lookup"]._jdf.queryExecution().executedPlan().toString()
    assert got == expected
    assert "skew=true" in plan          # the hot product's join partition was split


def _above(plan, leaf, root):
    """The operators of a plan between the first line with ``leaf`` and its ancestor ``root``."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if leaf in line)
    depth, out = lines[at].index("- "), []
    for line in reversed(lines[:at]):
        here = line.index("- ") if "- " in line else 0
        if here < depth:
            out.append(line)
            depth = here
            if root in line:
                return out
    return []


def test_bucketed_lookup_is_not_shuffled_and_hot_products_stay_out_of_its_join(spark, skewed, area):
    dim = dims.product_dimension(table(spark, SF_SMALL, "part"), SCALE_CATEGORY_RULES)
    known = dim.where("product_id % 10 <> 3")                       # some orders have an unknown product
    orders = skewed.withColumn("product_id", F.when(F.col("quantity") == 7, None).otherwise(F.col("product_id")))
    expected = _rows(clean_orders(orders, products=known))
    with conf(spark, FORCED_SKEW):
        name = dims.write_lookup_table(known.unionByName(known), "lookup_of_the_skew_test", area)
        found = clean_orders(orders, lookup=name)
        assert _rows(found) == expected
        plan = found._jdf.queryExecution().executedPlan().toString()
        above = _above(plan, "Bucketed: true", "SortMergeJoin [_key")
        assert above and not [line for line in above if "Exchange" in line]
        keyed = spark.table(name)
        hot = dims.with_category(orders, keyed, share=0.05)
        assert _rows(hot) == _rows(dims.with_category(orders, keyed, share=1.0))
        # The rows of one task of the join: the hot product's orders are dealt over all of them.
        sides = dims.with_category(orders, keyed).groupBy(F.spark_partition_id().alias("p")).count()
        counts = [r["count"] for r in sides.collect()]
        assert max(counts) < 2 * sum(counts) / len(counts)
    assert {r["product_id"] for r in dims.hot_products(orders, 0.05).collect()} == {HOT_PRODUCT}
    spark.sql("DROP TABLE lookup_of_the_skew_test")


def test_hot_user_totals_match_brute_force(spark, skewed):
    detail = clean_orders(skewed, SCALE_CATEGORY_RULES)
    hot = detail.where(F.col("user_id") == HOT_USER)
    stats = user_daily_stats(detail).where(F.col("user_id") == HOT_USER)
    agg = stats.agg(F.sum("order_count").alias("n"), F.sum("total_amount").alias("amt")).first()
    brute = hot.agg(F.count("order_id").alias("n"), F.sum("final_amount").alias("amt")).first()
    assert (agg.n, agg.amt) == (brute.n, brute.amt)
    (beh,) = serving.user_behavior(detail, "2001-08-01", ("P",)).where(F.col("user_id") == HOT_USER).collect()
    assert beh.total_orders == hot.where(F.col("order_date") <= F.lit("2001-08-01").cast("date")).count()
