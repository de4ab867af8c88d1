"""The warehouse's sample day, landed as raw rows (golden fixture).

``INSERT ... VALUES`` becomes ``createDataFrame(rows, schema)`` followed by the
partition-overwrite writer, so reloading the seed is idempotent.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.schemas import ODS_ORDER_INFO, ODS_USER_INFO

SEED_DAY = "2024-12-26"

# The sample users (user_id, username, email, phone, register_time,
# last_login_time, status, create_time, update_time).
SEED_USERS = [
    ("U001", "zhang_san", "zhangsan@email.com", "13800138001", "2024-01-15 10:30:00", "2024-12-25 15:20:00", "active", "2024-01-15 10:30:00", "2024-12-25 15:20:00"),
    ("U002", "li_si", "lisi@email.com", "13800138002", "2024-02-20 14:15:00", "2024-12-24 09:45:00", "active", "2024-02-20 14:15:00", "2024-12-24 09:45:00"),
    ("U003", "wang_wu", "wangwu@email.com", "13800138003", "2024-03-10 16:45:00", "2024-12-23 11:30:00", "vip", "2024-03-10 16:45:00", "2024-12-23 11:30:00"),
    ("U004", "zhao_liu", "zhaoliu@email.com", "13800138004", "2024-04-05 09:20:00", "2024-12-22 14:10:00", "premium", "2024-04-05 09:20:00", "2024-12-22 14:10:00"),
    ("U005", "qian_qi", "qianqi@email.com", "13800138005", "2024-05-12 11:00:00", "2024-12-21 16:55:00", "active", "2024-05-12 11:00:00", "2024-12-21 16:55:00"),
]

# The sample orders (order_id, user_id, product_id, product_name, quantity,
# unit_price, total_amount, order_status, payment_method, order_time, payment_time, create_time).
SEED_ORDERS = [
    ("O001", "U001", "P001", "iPhone 15 Pro", 1, "8999.00", "8999.00", "completed", "credit_card", "2024-12-25 10:30:00", "2024-12-25 10:35:00", "2024-12-25 10:30:00"),
    ("O002", "U001", "P002", "MacBook Pro", 1, "15999.00", "15999.00", "completed", "alipay", "2024-12-25 14:20:00", "2024-12-25 14:25:00", "2024-12-25 14:20:00"),
    ("O003", "U002", "P003", "运动鞋", 2, "299.00", "598.00", "completed", "wechat_pay", "2024-12-25 16:45:00", "2024-12-25 16:50:00", "2024-12-25 16:45:00"),
    ("O004", "U003", "P004", "笔记本电脑", 1, "5999.00", "5999.00", "pending", "credit_card", "2024-12-25 18:30:00", None, "2024-12-25 18:30:00"),
    ("O005", "U002", "P005", "连衣裙", 3, "199.00", "597.00", "completed", "alipay", "2024-12-25 20:15:00", "2024-12-25 20:20:00", "2024-12-25 20:15:00"),
    ("O006", "U004", "P001", "iPhone 15 Pro", 2, "8999.00", "17998.00", "completed", "bank_transfer", "2024-12-25 21:00:00", "2024-12-25 21:05:00", "2024-12-25 21:00:00"),
    ("O007", "U005", "P006", "智能手表", 1, "2999.00", "2999.00", "shipped", "credit_card", "2024-12-25 22:30:00", "2024-12-25 22:35:00", "2024-12-25 22:30:00"),
    ("O008", "U003", "P007", "无线耳机", 2, "899.00", "1798.00", "completed", "wechat_pay", "2024-12-25 23:15:00", "2024-12-25 23:20:00", "2024-12-25 23:15:00"),
]


def seed_users(spark: SparkSession, day: str = SEED_DAY) -> DataFrame:
    return spark.createDataFrame(SEED_USERS, ODS_USER_INFO.schema).withColumn("dt", F.lit(day))


def seed_orders(spark: SparkSession, day: str = SEED_DAY) -> DataFrame:
    rows = [r[:5] + (Decimal(r[5]), Decimal(r[6])) + r[7:] for r in SEED_ORDERS]
    return spark.createDataFrame(rows, ODS_ORDER_INFO.schema).withColumn("dt", F.lit(day))
