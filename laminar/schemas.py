"""Declared table contracts: one StructType per warehouse table.

Column names, order and types are the warehouse's published DDL (fixed values).
``conform`` casts a frame to its contract strictly before a write, so a value that
does not fit (say a daily sum above DECIMAL(10,2)) fails the job instead of
turning into NULL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
D = T.DateType()
TS = T.TimestampType()
B = T.BooleanType()
MONEY = T.DecimalType(10, 2)
# Sums over rows: the published DDL declares DECIMAL(10,2) here as well, which a day of
# 100 million does not fit. A documented difference; row-level money keeps its type.
TOTAL = T.DecimalType(20, 2)


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class TableSpec:
    database: str
    name: str
    schema: T.StructType          # data columns, in declared order
    partition_by: tuple[str, ...] = ()
    partition_types: tuple[T.DataType, ...] = field(default=())
    comment: str = ""

    @property
    def qualified(self) -> str:
        return f"{self.database}.{self.name}"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def full_schema(self) -> T.StructType:
        """Data columns followed by partition columns (the on-disk layout)."""
        extra = [T.StructField(n, t, True) for n, t in zip(self.partition_by, self.partition_types)]
        return T.StructType(list(self.schema.fields) + extra)


# Layer databases (fixed values).
ODS, DWD, DWS, ADS, DIM = "ods_enterprise", "dwd_enterprise", "dws_enterprise", "ads_enterprise", "dim_enterprise"
DATABASES = {
    ODS: "Operational Data Store: raw data as landed",
    DWD: "Data Warehouse Detail: cleaned and typed detail",
    DWS: "Data Warehouse Summary: daily pre-aggregates",
    ADS: "Application Data Service: serving tables",
    DIM: "Dimension data",
}

DAY = (("dt",), (S,))

ODS_USER_INFO = TableSpec(ODS, "ods_user_info", _struct(
    ("user_id", S), ("username", S), ("email", S), ("phone", S), ("register_time", S),
    ("last_login_time", S), ("status", S), ("create_time", S), ("update_time", S)), *DAY,
    comment="raw user records")

ODS_ORDER_INFO = TableSpec(ODS, "ods_order_info", _struct(
    ("order_id", S), ("user_id", S), ("product_id", S), ("product_name", S), ("quantity", I),
    ("unit_price", MONEY), ("total_amount", MONEY), ("order_status", S), ("payment_method", S),
    ("order_time", S), ("payment_time", S), ("create_time", S)), *DAY,
    comment="raw order records")

DWD_USER_INFO = TableSpec(DWD, "dwd_user_info", _struct(
    ("user_id", S), ("username", S), ("email", S), ("phone", S), ("register_date", D),
    ("last_login_date", D), ("status", S), ("is_active", B), ("user_level", S),
    ("create_time", TS), ("update_time", TS)), *DAY, comment="user detail")

DWD_ORDER_INFO = TableSpec(DWD, "dwd_order_info", _struct(
    ("order_id", S), ("user_id", S), ("product_id", S), ("product_name", S), ("category_id", S),
    ("quantity", I), ("unit_price", MONEY), ("total_amount", MONEY), ("discount_amount", MONEY),
    ("final_amount", MONEY), ("order_status", S), ("payment_method", S), ("order_date", D),
    ("payment_date", D), ("create_time", TS)), *DAY, comment="order detail")

DWS_USER_DAILY_STATS = TableSpec(DWS, "dws_user_daily_stats", _struct(
    ("user_id", S), ("login_count", I), ("order_count", I), ("total_amount", TOTAL),
    ("avg_order_amount", MONEY), ("first_order_time", TS), ("last_order_time", TS),
    ("stat_date", D)), *DAY, comment="per-user daily statistics")

DWS_PRODUCT_DAILY_STATS = TableSpec(DWS, "dws_product_daily_stats", _struct(
    ("product_id", S), ("product_name", S), ("category_id", S), ("order_count", I),
    ("total_quantity", T.LongType()), ("total_amount", TOTAL), ("avg_price", MONEY), ("unique_users", I),
    ("stat_date", D)), *DAY, comment="per-product daily statistics")

ADS_USER_BEHAVIOR_ANALYSIS = TableSpec(ADS, "ads_user_behavior_analysis", _struct(
    ("user_id", S), ("total_orders", I), ("total_amount", TOTAL), ("avg_order_amount", MONEY),
    ("first_order_date", D), ("last_order_date", D), ("order_frequency", T.DecimalType(5, 2)),
    ("user_lifecycle", S), ("preferred_category", S), ("risk_level", S), ("create_time", TS)),
    comment="user behaviour analysis")

ADS_SALES_TREND_ANALYSIS = TableSpec(ADS, "ads_sales_trend_analysis", _struct(
    ("stat_date", D), ("total_orders", T.LongType()), ("total_amount", TOTAL), ("avg_order_amount", MONEY),
    ("new_users", T.LongType()), ("active_users", T.LongType()), ("retention_rate", T.DecimalType(5, 4)),
    ("growth_rate", T.DecimalType(5, 4)), ("create_time", TS)),
    ("year", "month"), (I, I), comment="sales trend analysis")

DIM_DATE = TableSpec(DIM, "dim_date", _struct(
    ("date_key", S), ("full_date", D), ("year", I), ("quarter", I), ("month", I), ("week", I),
    ("day", I), ("weekday", I), ("is_weekend", B), ("is_holiday", B), ("season", S),
    ("month_name", S), ("weekday_name", S)), comment="date dimension")

TABLES: dict[str, TableSpec] = {t.name: t for t in (
    ODS_USER_INFO, ODS_ORDER_INFO, DWD_USER_INFO, DWD_ORDER_INFO, DWS_USER_DAILY_STATS,
    DWS_PRODUCT_DAILY_STATS, ADS_USER_BEHAVIOR_ANALYSIS, ADS_SALES_TREND_ANALYSIS, DIM_DATE)}


def _strict_cast(c: Column, dtype: T.DataType) -> Column:
    # ANSI cast: overflow or a malformed value raises instead of producing NULL.
    return c.cast(dtype)


def conform(df: DataFrame, spec: TableSpec, with_partitions: bool = True) -> DataFrame:
    """Select the contract's columns by name, in order, cast to the declared types.

    Missing columns are an error (a silent NULL column would hide a bug upstream).
    ``configure`` turns the session's ANSI rules on, so out-of-range values raise.
    """
    df.sparkSession.conf.set("spark.sql.ansi.enabled", "true")
    schema = spec.full_schema if with_partitions else spec.schema
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{spec.qualified}: missing columns {missing}")
    return df.select([_strict_cast(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def ddl(spec: TableSpec, location: str | None = None) -> str:
    """CREATE TABLE statement generated from the contract (Parquet, partitioned)."""
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in spec.full_schema.fields)
    parts = f"\nPARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
    loc = f"\nLOCATION '{location}'" if location else ""
    comment = f"\nCOMMENT '{spec.comment}'" if spec.comment else ""
    return (f"CREATE TABLE IF NOT EXISTS {spec.qualified} (\n  {cols}\n) USING PARQUET"
            f"{parts}{comment}{loc}")
