"""Raw -> detail cleaning (ODS -> DWD) for users and orders.

Both are pure projections plus a filter: Catalyst pushes the filter below the
projection into the scan and prunes unused columns, and the whole step runs in
one whole-stage-codegen span with no shuffle. The partition column ``dt`` is
carried through, so many days are cleaned at once and one day is the same
transform over a pruned read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.functions.parsing import lenient_date, lenient_timestamp
from laminar.functions.rules import (
    DEFAULT_CATEGORY, REFERENCE_CATEGORY_RULES, keyword_classifier, status_is_active, user_level,
)
from laminar.operators.dims import with_category, written_lookup
from laminar.schemas import MONEY


def _partitions(df: DataFrame) -> list[str]:
    return ["dt"] if "dt" in df.columns else []


def clean_users(ods: DataFrame) -> DataFrame:
    """Type the raw user record and derive activity flag and level; drop rows without a key."""
    return ods.select(
        "user_id", "username", "email", "phone",
        lenient_date("register_time").alias("register_date"),
        lenient_date("last_login_time").alias("last_login_date"),
        "status",
        status_is_active("status").alias("is_active"),
        user_level("status").alias("user_level"),
        lenient_timestamp("create_time").alias("create_time"),
        lenient_timestamp("update_time").alias("update_time"),
        *_partitions(ods),
    ).where(F.col("user_id").isNotNull())


def valid_order() -> Column:
    """Order id and user id present and a positive total."""
    return F.col("order_id").isNotNull() & F.col("user_id").isNotNull() & (F.col("total_amount") > 0)


def clean_orders(ods: DataFrame, category_rules: Sequence[tuple[str, str]] = REFERENCE_CATEGORY_RULES,
                 products: DataFrame | None = None, lookup: str | None = None) -> DataFrame:
    """Type the raw order record, classify its product, keep valid orders only.

    Valid: order id and user id present and a positive total. The category comes
    from product-name keyword rules, or from a left lookup into a product dimension
    (unknown -> OTHER), which is given either as rows ``products`` ``(product_id, category_id)``
    or as the name ``lookup`` of a bucketed table (``dims.write_lookup_table``).
    With ``products`` the lookup is a plain equi-join with the deduplicated rows, written
    first: the planner broadcasts them only when their size is under the broadcast threshold,
    and else sort-merges, splitting a hot product. With ``lookup`` the dimension is not
    shuffled, and hot products go beside the join (``dims.with_category``).
    """
    discount = F.lit(0).cast(MONEY)
    src = ods
    if lookup is not None:
        src = with_category(ods, ods.sparkSession.table(lookup))
        category = F.coalesce(F.col("_dim_category"), F.lit(DEFAULT_CATEGORY))
    elif products is not None:
        dim = written_lookup(products).withColumnRenamed("category_id", "_dim_category")
        src = ods.join(dim, "product_id", "left")
        category = F.coalesce(F.col("_dim_category"), F.lit(DEFAULT_CATEGORY))
    else:
        category = keyword_classifier("product_name", category_rules)
    return src.select(
        "order_id", "user_id", "product_id", "product_name",
        category.alias("category_id"),
        "quantity", "unit_price", "total_amount",
        discount.alias("discount_amount"),
        (F.col("total_amount") - discount).cast(MONEY).alias("final_amount"),
        "order_status", "payment_method",
        lenient_date("order_time").alias("order_date"),
        lenient_date("payment_time").alias("payment_date"),
        lenient_timestamp("create_time").alias("create_time"),
        *_partitions(ods),
    ).where(valid_order())
