"""The warehouse layers derived lazily from the driver tables of one scale.

Every query in the registry reads the driver tables (or frames Spark derives
from them), so its work grows with the data. Nothing is collected: each property
is a lazy DataFrame, and Catalyst plans and prunes the combined lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.functions.rules import SCALE_CATEGORY_RULES
from laminar.operators.aggregates import product_daily_stats, user_daily_stats
from laminar.operators.transforms import clean_orders, clean_users
from laminar.session import configure, new_area
from laminar.sources import testdata


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return testdata.table(self.spark, self.sf_dir, name)

    @cached_property
    def ods_user_info(self) -> DataFrame:
        return testdata.ods_users(self.table("customer"))

    @cached_property
    def ods_order_info(self) -> DataFrame:
        return testdata.ods_orders(self.table("lineitem"), self.table("orders"), self.table("part"))

    @cached_property
    def dwd_user_info(self) -> DataFrame:
        return clean_users(self.ods_user_info)

    @cached_property
    def dwd_order_info(self) -> DataFrame:
        return clean_orders(self.ods_order_info, SCALE_CATEGORY_RULES)

    @cached_property
    def dws_user_daily_stats(self) -> DataFrame:
        return user_daily_stats(self.dwd_order_info)

    @cached_property
    def dws_product_daily_stats(self) -> DataFrame:
        return product_daily_stats(self.dwd_order_info)

    def staged(self, columns: Sequence[str] | None = None) -> "Warehouse":
        """This warehouse with its raw orders written once under the storage root and read
        back. Reports that check raw, detail and both summaries then read the order lineage
        (a join of the largest tables) once, and a lost executor restarts from the files.

        With ``columns`` only these are written (and read from the sources); the others are
        NULL in the staged orders, for reports that do not look at them."""
        from laminar.sinks.partitioned import write_frame
        path = new_area(self.spark, "staged-orders")
        orders = self.ods_order_info
        chosen = orders if columns is None else orders.select(*columns)
        write_frame(chosen, path)
        back = self.spark.read.schema(chosen.schema).parquet(path)
        out = Warehouse(self.spark, self.sf_dir)
        out.__dict__["ods_order_info"] = back.select(*[
            f.name if f.name in chosen.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in orders.schema])
        return out

    def ods_order_parts(self, path: str) -> list[DataFrame]:
        """The raw orders as frames of whole days, each day in one of them: one frame, or with
        large tables some to land one after the other, so that only a share of the rows is in a
        shuffle at a time. The line items then join their orders once; the result is written to
        ``path`` by the pass of its day, and a frame reads its own rows and joins the parts."""
        from laminar.sinks.partitioned import day_bucket, day_passes, write_frame
        lineitem = self.table("lineitem")
        passes = day_passes(int(str(lineitem._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())))
        if passes == 1:
            return [self.ods_order_info]
        lines = testdata.order_lines(lineitem, self.table("orders")).withColumn(
            "day_pass", day_bucket(testdata.order_day(), passes))
        write_frame(lines, path, ("day_pass",), compression="zstd", spread=False)
        back = self.spark.read.schema(lines.schema).parquet(path)
        return [testdata.ods_orders_of_lines(back.where(F.col("day_pass") == i).drop("day_pass"), self.table("part"))
                for i in range(passes)]

    def layers(self) -> dict[str, DataFrame]:
        return {
            "ods_user_info": self.ods_user_info, "ods_order_info": self.ods_order_info,
            "dwd_user_info": self.dwd_user_info, "dwd_order_info": self.dwd_order_info,
            "dws_user_daily_stats": self.dws_user_daily_stats,
            "dws_product_daily_stats": self.dws_product_daily_stats,
        }
