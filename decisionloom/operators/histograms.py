"""Counts by value: they merge from any parts, and quantiles come from them without gathering a group's values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def counted(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value, n: how many rows have each value; nulls are left out."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def merged(*histograms: DataFrame) -> DataFrame:
    """The histogram of all rows that histograms (the same keys and value, n) were made of."""
    out = histograms[0]
    for h in histograms[1:]:
        out = out.unionByName(h)
    return out.groupBy(*[c for c in out.columns if c != "n"]).agg(F.sum("n").alias("n"))


def placed(histogram: DataFrame, keys: list[str], value: str) -> DataFrame:
    """histogram + before (rows of smaller values) and rows (all of the key)."""
    order = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return histogram.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).withColumn("rows", F.sum("n").over(Window.partitionBy(*keys)))


def medians(histogram: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, median: the middle value, or the mean of both middle ones."""
    rows = placed(histogram, keys, value)
    low, high = F.floor((F.col("rows") - 1) / 2), F.floor(F.col("rows") / 2)
    at = lambda k: F.max(F.when((F.col("before") <= k) & (k < F.col("before") + F.col("n")), F.col(value)))
    return rows.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias("median"))


def under_ceiling(histogram: DataFrame, keys: list[str], value: str, ceiling: int) -> DataFrame:
    """keys, rows, over, longest, total, visible: what a ceiling on the value leaves of the sum of all values."""
    v, n = F.col(value), F.col("n")
    return histogram.groupBy(*keys).agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(v > ceiling, n)), F.lit(0)).alias("over"), F.max(v).alias("longest"),
        F.sum(v * n).alias("total"), F.sum(F.least(v, F.lit(ceiling)) * n).alias("visible"),
    )
