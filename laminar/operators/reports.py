"""Run reports: per-layer row counts and bounded previews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def layer_row_counts(tables: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """``(layer, table_name, dt, row_count)`` for every table and day.

    ``tables`` maps table name -> (layer, frame). Each count is a partial/final
    aggregate on ``dt`` (one tiny row per day crosses the shuffle); the four
    results are stacked with ``unionByName``.
    """
    parts = [
        df.groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"))
          .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "dt", "row_count")
        for name, (layer, df) in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview_top_k(df: DataFrame, columns: Sequence[str], k: int, by: str = "dt") -> DataFrame:
    """First ``k`` rows per ``by`` group, ordered by all shown columns (a defined result).

    ``row_number() <= k`` lets Spark insert a partial per-group limit before the
    shuffle (WindowGroupLimit), so even a day holding a third of all rows sends at
    most ``k`` rows per map task to the final sort.
    """
    order = [F.col(c).asc_nulls_last() for c in columns]
    w = Window.partitionBy(by).orderBy(*order)
    return (df.select(by, *columns)
              .withColumn("rank_in_day", F.row_number().over(w))
              .where(F.col("rank_in_day") <= k))
