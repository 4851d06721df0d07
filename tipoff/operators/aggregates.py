"""Aggregation operators: ratios of sums, weighted means, quantiles, pivots, pair statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tipoff.functions.scalars import ratio


def ratio_of_sums(x: Column, y: Column) -> Column:
    return ratio(F.sum(x), F.sum(y))


def weighted_mean(x: Column, w: Column) -> Column:
    """sum(x w) / sum(w), or the plain mean where the weights sum to 0."""
    return F.coalesce(F.try_divide(F.sum(x * w), F.sum(w)), F.avg(x))


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key; nulls are values."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("duplicates"))


def pivot_max(df: DataFrame, keys: list[str], on: str, values: list, metric: str) -> DataFrame:
    return df.groupBy(*keys).pivot(on, values).agg(F.max(metric))


def quantiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles by Spark's percentile, for groups whose distinct values fit in a task; selection.quantiles is for any."""
    return df.groupBy(*keys).agg(*(F.percentile(value, F.lit(p)).alias(n) for n, p in points.items()))


def top_values(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """Most frequent values, ties by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col(col).asc_nulls_last()).limit(k)


def bucket_stats(df: DataFrame, bucket: Column, value: str) -> DataFrame:
    return df.groupBy(bucket.alias("bucket")).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise correlations in one pass, as rows (a, b, r)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    one = df.agg(*(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs))
    return one.select(F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs))).alias("x")).select("x.*")
