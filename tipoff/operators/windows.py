"""Window operators: dedupe, ranks, rolling form, change points, islands, shares, scores. Orders put nulls last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tipoff.sources import sinks

START, HERE = Window.unboundedPreceding, Window.currentRow


def by(keys: list[str], *order: Column):
    return Window.partitionBy(*keys).orderBy(*order)


def first_of(df: DataFrame, keys: list[str], *order: Column, n: int = 1) -> DataFrame:
    """The first n rows of each key."""
    return df.withColumn("_rn", F.row_number().over(by(keys, *order))).filter(F.col("_rn") <= n).drop("_rn")


def leaderboard(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """RANK of each metric inside keys, largest first, as <metric>_rank."""
    return df.select("*", *(F.rank().over(by(keys, F.col(m).desc_nulls_last())).alias(f"{m}_rank") for m in metrics))


def trailing_mean(df: DataFrame, keys: list[str], order: list[Column], value: str, rows: list[int], current: bool = True) -> DataFrame:
    """Means over the last n rows, with or without the current one."""
    last = 0 if current else -1
    w = by(keys, *order)
    return df.select("*", *(F.avg(value).over(w.rowsBetween(last - n + 1, last)).alias(f"{value}_avg_{n}") for n in rows))


def changes(df: DataFrame, keys: list[str], order: list[Column], attrs: list[str]) -> DataFrame:
    """Rows where an attribute differs from the previous row's; a first row is a change, as is one after a null."""
    w = by(keys, *order)
    hit = F.lit(False)
    for a in attrs:
        hit = hit | ~F.lag(a).over(w).eqNullSafe(F.col(a)) | F.lag(a).over(w).isNull()
    return df.withColumn("_c", hit).filter("_c").drop("_c")


def validity(df: DataFrame, keys: list[str], valid_from: str) -> DataFrame:
    """valid_to is the next valid_from of the key; the last version is current."""
    nxt = F.lead(valid_from).over(by(keys, F.col(valid_from).asc_nulls_last()))
    return df.withColumn("valid_to", nxt).withColumn("is_current", F.col("valid_to").isNull())


def scd2(df: DataFrame, keys: list[str], order: list[Column], attrs: list[str], valid_from: str) -> DataFrame:
    """Slowly changing dimension of type 2: one row for each change, with its validity."""
    return validity(changes(df, keys, order, attrs), keys, valid_from)


def by_ranges(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """The rows with _p, the number of their range in a global order: written once, so that all later passes see the same ranges."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path = sinks.work_dir(df.sparkSession) + "/ranges"
    df.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.schema(df.withColumn("_p", F.lit(0)).schema).parquet(path)


def global_running(df: DataFrame, order: list[str], value: Column, name: str) -> DataFrame:
    """Running total in a global order without gathering the rows: sums inside ranges, and each range's offset (a row per range)."""
    placed = by_ranges(df, order)
    sums = placed.groupBy("_p").agg(F.sum(value).alias("_s"))
    before = sums.select("_p", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(START, -1)), F.lit(0)).alias("_b"))
    inside = F.sum(value).over(by(["_p"], *(F.col(c) for c in order)).rowsBetween(START, HERE))
    return placed.join(F.broadcast(before), "_p").withColumn(name, inside + F.col("_b")).drop("_p", "_b")


def dense_key(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """1..n in a global order without gathering the rows."""
    return global_running(df, order, F.lit(1), name)


def islands(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """Runs of equal values: adds island, numbered from 1 inside keys."""
    w = by(keys, *order)
    start = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_s", start).withColumn("island", F.sum("_s").over(w.rowsBetween(START, HERE))).drop("_s")


def share(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return df.withColumn(name, F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*keys))))


def beside(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Each row with aggregates of its group (null keys are a group): sums are combined before the shuffle, and no task holds a group."""
    if not keys:
        return df.join(F.broadcast(df.agg(*aggs)))  # one row
    stats = df.groupBy(*(F.col(k).alias(f"_key_{k}") for k in keys)).agg(*aggs)
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(stats[f"_key_{k}"])
    return df.join(stats, same, "left").drop(*(f"_key_{k}" for k in keys))


def percent_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Tie-aware percentile (x100, 1 decimal), ordinal share, and share of strictly smaller values; nulls are the largest.

    Ranks come from counts of each distinct value, added up over ranges of (key, value), so no task holds a key's rows.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_ties")).withColumn("_last", F.col(value).isNull())
    placed = global_running(counts, [*keys, "_last", value], F.col("_ties"), "_upto")
    below = beside(placed, keys, F.min(F.col("_upto") - F.col("_ties")).alias("_first"), F.sum("_ties").alias("_all"))
    below = below.select(*(F.col(k).alias(f"_key_{k}") for k in [*keys, value]), "_ties", "_all", (F.col("_upto") - F.col("_ties") - F.col("_first")).alias("_below"))
    same = F.lit(True)
    for k in [*keys, value]:
        same = same & df[k].eqNullSafe(below[f"_key_{k}"])
    pct = F.round((F.col("_below") + 1 + (F.col("_ties") - 1) / 2) / F.col("_all") * 100, 1)
    return df.join(below, same).select(*(df[k] for k in df.columns), pct.alias("pct_rank"), (F.col("_below") / F.col("_all")).alias("share_below"))


def z_scores(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Sample z-scores inside keys; 0 where the deviation is 0 or undefined."""
    x = beside(df, keys, *(f(v).alias(f"_{n}_{v}") for v in values for n, f in (("m", F.avg), ("s", F.stddev_samp))))
    return x.select(*df.columns, *(F.coalesce(F.try_divide(F.col(v) - F.col(f"_m_{v}"), F.col(f"_s_{v}")), F.lit(0.0)).alias(f"{v}_z") for v in values))


def min_max(df: DataFrame, keys: list[str], value: str, top: float = 1.0) -> DataFrame:
    """Value scaled to 0..top inside keys; 0 for a single value."""
    x = beside(df, keys, F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return x.select(*df.columns, F.coalesce(F.try_divide((F.col(value) - F.col("_lo")) * top, F.col("_hi") - F.col("_lo")), F.lit(0.0)).alias(f"{value}_scaled"))


def centred_mean(df: DataFrame, keys: list[str], order: list[Column], value: str, n: int = 5) -> DataFrame:
    """Mean of n rows around each; null near the ends."""
    w = by(keys, *order).rowsBetween(-(n // 2), n // 2)
    return df.withColumn(f"{value}_smooth", F.when(F.count(value).over(w) == n, F.avg(value).over(w)))


def date_gaps(df: DataFrame, keys: list[str], day: str, longest: int) -> DataFrame:
    """Distinct days followed by more than `longest` days without any."""
    d = df.select(*keys, day).distinct()
    return d.withColumn("next_day", F.lead(day).over(by(keys, F.col(day)))).withColumn("gap_days", F.date_diff("next_day", day)).filter(F.col("gap_days") > longest)


def days_since(df: DataFrame, keys: list[str], day: str, order: list[Column], default: int = 3) -> DataFrame:
    return df.withColumn("rest_days", F.coalesce(F.date_diff(F.col(day), F.lag(day).over(by(keys, *order))), F.lit(default)))


def running_total(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    return df.withColumn(f"{value}_running", F.sum(value).over(by(keys, *order).rowsBetween(START, HERE)))


def lead_after(df: DataFrame, keys: list[str], order: list[Column], value: str, n: int) -> DataFrame:
    """The value n rows later: the window form of joining each event with the n-th that follows it."""
    return df.withColumn(f"{value}_after_{n}", F.lead(value, n).over(by(keys, *order)))
