"""Row-level reconciliation of two layers: which keys were lost, invented or changed.

Counts alone miss a lost row that an invented one makes up for. Both sides are reduced to a row
count and a sum of row hashes per (day, bucket of keys); only the (day, bucket) groups whose
digests differ are read again and compared key by key.

Scale
- Digests are combined before the shuffle and hold at most days x ``buckets`` rows a side. They
  are written. The second read is restricted to the days that differ (their list, bounded by the
  calendar, is a filter that prunes day partitions) and then by a semi-join to their buckets.
- Keys are compared by one aggregate over both sides together, not by a join: a key with very many
  rows sends one partial row per task, and rows without a key compare like any other.

Defined results: a NULL day or key is a value of its own. Repeated rows count: a key whose rows
differ in number or content is changed. NULL differs from every value and from an empty text. Empty
tables give the other side's keys as lost or invented; columns not compared are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.session import new_area
from laminar.sinks.partitioned import write_frame

BUCKETS = 256


def _hash(columns: Sequence[str]) -> Column:
    """Hash of a row; a NULL is hashed as such (alone, it would leave the hash as it is)."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def _sides(source: DataFrame, target: DataFrame, day: str, key: Sequence[str], columns: Sequence[str],
           buckets: int) -> DataFrame:
    """Rows of both sides as (day, keys, bucket, hash, 1 or 0 for source and target). The hash covers
    the key, or a lost row would cancel an invented one of the same values in its bucket."""
    def of(rows: DataFrame, is_source: int) -> DataFrame:
        return rows.select(day, *key, F.pmod(_hash(key), F.lit(buckets)).alias("_bucket"),
                           _hash([*key, *columns]).cast("decimal(20,0)").alias("_hash"),
                           F.lit(is_source).alias("_s"), F.lit(1 - is_source).alias("_t"))
    return of(source, 1).unionByName(of(target, 0))


def _totals(rows: DataFrame, *by: str) -> DataFrame:
    """Rows and hash sums of either side per group; ``_same`` if they agree."""
    sums = rows.groupBy(*by).agg(
        F.sum("_s").cast("bigint").alias("source_rows"), F.sum("_t").cast("bigint").alias("target_rows"),
        F.sum(F.col("_hash") * (F.col("_s") - F.col("_t"))).alias("_apart"))
    return sums.withColumn("_same", (F.col("source_rows") == F.col("target_rows")) & (F.col("_apart") == 0))


def differing_buckets(source: DataFrame, target: DataFrame, day: str, key: Sequence[str], columns: Sequence[str],
                      buckets: int = BUCKETS) -> DataFrame:
    """(day, _bucket) of the groups whose digests differ."""
    rows = _sides(source, target, day, key, columns, buckets)
    return _totals(rows, day, "_bucket").where("NOT _same").select(day, "_bucket")


def differences(source: DataFrame, target: DataFrame, day: str, key: Sequence[str], columns: Sequence[str],
                buckets: int = BUCKETS) -> DataFrame:
    """(day, keys, status, source_rows, target_rows) of every key that differs: ``lost`` (source
    only), ``invented`` (target only) or ``changed``."""
    spark = source.sparkSession
    path = new_area(spark, "reconcile")
    wrong = differing_buckets(source, target, day, key, columns, buckets).withColumnRenamed(day, "_day")
    write_frame(wrong, path)
    wrong = spark.read.schema(wrong.schema).parquet(path).withColumnRenamed("_bucket", "_b")
    days = [r[0] for r in wrong.select("_day").distinct().collect()]
    apart = F.col(day).isin([d for d in days if d is not None])
    apart = apart | F.col(day).isNull() if None in days else apart
    rows = _sides(source.where(apart), target.where(apart), day, key, columns, buckets)
    chosen = rows.join(wrong, F.col(day).eqNullSafe(F.col("_day")) & (F.col("_bucket") == F.col("_b")), "left_semi")
    status = (F.when(F.col("target_rows") == 0, "lost").when(F.col("source_rows") == 0, "invented").otherwise("changed"))
    return (_totals(chosen, day, *key).where("NOT _same")
            .select(day, *key, status.alias("status"), "source_rows", "target_rows"))


def summary(found: DataFrame, day: str) -> DataFrame:
    """Differing keys per day and status."""
    return found.groupBy(day, "status").agg(F.count(F.lit(1)).alias("keys"))
