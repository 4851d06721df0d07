"""Exact quantiles of any group without gathering it: selection by range counts.

Each group's values are cut at approximate quantiles, rows are counted by range, and only the ranges that hold a wanted rank go on.
Ranges with one value are answers; the others are cut again, as groups of their own, until a range has at most `limit` distinct
values, which a window then ranks. Counts are combined before each shuffle, so no task holds a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tipoff.operators import windows as W
from tipoff.sources import sinks

CUTS, LIMIT = 128, 1 << 20


def _ranged(df: DataFrame) -> DataFrame:
    """With part: how many of the ascending cuts (fewer than 256) lie below v, by halving, in steps that Spark compiles."""
    df = df.withColumn("part", F.lit(0))
    for k in range(7, -1, -1):
        at = F.col("part")
        df = df.withColumn("part", at + F.when(F.get("cuts", at + ((1 << k) - 1)) < F.col("v"), 1 << k).otherwise(0))
    return df


def ranked(values: DataFrame, wanted: DataFrame, limit: int = LIMIT, cuts: int = CUTS) -> DataFrame:
    """g, rank, v: the value at each wanted rank (from 0) of each group's ascending values.

    values: g, v (without nulls) and n, how often a row counts; wanted: g, rank, for ranks that the group has.
    """
    out, parts = None, [k / cuts for k in range(1, cuts)]
    wanted = wanted.select("g", "rank", F.col("rank").alias("_rank"), F.array().cast("array<int>").alias("path"))
    values = values.select("g", "v", "n", F.array().cast("array<int>").alias("path"))
    while True:
        # groups are (g, path): path holds the range of each round; the middle of the values is a cut too, so a value with most of the rows doesn't stop it
        middle = F.array(F.min("v") / 2 + F.max("v") / 2)
        edges = sinks.written(values.groupBy("g", "path").agg(F.array_sort(F.array_distinct(F.concat(F.percentile_approx("v", parts, 1_000), middle))).alias("cuts")))
        ranged = _ranged(values.join(edges, ["g", "path"])).select("g", "path", "v", "n", "part")
        counts = ranged.groupBy("g", "path", "part").agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.approx_count_distinct("v", 0.05).alias("d"))
        upto = F.sum("n").over(W.by(["g", "path"], F.col("part")).rowsBetween(W.START, W.HERE))  # at most `cuts` rows of a group
        counts = counts.withColumn("upto", upto)
        hit = wanted.join(counts, ["g", "path"]).filter((F.col("_rank") < F.col("upto")) & (F.col("_rank") >= F.col("upto") - F.col("n")))
        hit = sinks.written(hit.withColumn("_rank", F.col("_rank") - F.col("upto") + F.col("n")))
        found = hit.filter("low = high").select("g", "rank", F.col("low").alias("v"))
        out = found if out is None else out.unionByName(found)
        hit = hit.filter("low < high").withColumn("path", F.concat("path", F.array("part")))
        largest = hit.agg(F.max("d")).collect()[0][0]
        if largest is None:
            return out
        wanted, narrow = hit.select("g", "path", "rank", "_rank"), hit.select("g", "path").distinct()
        values = ranged.select("g", F.concat("path", F.array("part")).alias("path"), "v", "n").join(narrow, ["g", "path"], "left_semi")
        if largest <= 0.8 * limit:
            break
        values = sinks.written(values)
    n = values.groupBy("g", "path", "v").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(W.by(["g", "path"], F.col("v")).rowsBetween(W.START, W.HERE))
    last = wanted.join(n.withColumn("upto", upto), ["g", "path"]).filter((F.col("_rank") < F.col("upto")) & (F.col("_rank") >= F.col("upto") - F.col("n")))
    return out.unionByName(last.select("g", "rank", "v"))


def quantiles(df: DataFrame, keys: list[str], value: str | Column, points: dict[str, float], limit: int = LIMIT, weight: str | None = None) -> DataFrame:
    """Interpolated quantiles of each group, exactly as quantile_cont has them; groups without values have none (null). With a weight, a row counts that often."""
    x = df.select(F.struct(*(F.col(k) for k in keys), F.lit(0).alias("_")).alias("g"), (F.col(value) if isinstance(value, str) else value).cast("double").alias("v"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("n"))
    n = sinks.written(x.groupBy("g").agg(F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("n")))
    at = F.explode(F.array(*(F.struct(F.lit(name).alias("point"), (F.lit(float(p)) * (F.col("n") - 1)).alias("at")) for name, p in points.items())))
    spots = n.filter("n > 0").select("g", at.alias("s")).select("g", "s.point", "s.at", F.floor("s.at").alias("low"), F.ceil("s.at").alias("high"))
    wanted = spots.select("g", F.explode(F.array("low", "high")).alias("rank")).distinct()
    got = sinks.written(ranked(x.filter("v is not null"), wanted, limit))
    low, high = got.select("g", F.col("rank").alias("low"), F.col("v").alias("a")), got.select("g", F.col("rank").alias("high"), F.col("v").alias("b"))
    each = spots.join(low, ["g", "low"]).join(high, ["g", "high"]).select("g", "point", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.col("low"))).alias("v"))
    wide = each.groupBy("g").agg(*(F.max(F.when(F.col("point") == name, F.col("v"))).alias(name) for name in points))
    return n.join(wide, "g", "left").select(*(F.col(f"g.`{k}`").alias(k) for k in keys), *points)


def profile(df: DataFrame, few: int = 20, top: int = 5, limit: int = LIMIT) -> DataFrame:
    """Every column of a table: rows, nulls, distinct values; lowest, highest, p50 and p95 of numeric ones; the most frequent values (as text, ties by value)
    of others with at most `few` distinct values, as value=count, comma-separated.

    Each column's values are counted in its own type, with counts combined before the shuffle, and the counts are written; all else comes from them.
    """
    numeric = [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]
    counts = None
    for c, kind in df.dtypes:
        x = F.col(f"`{c}`")
        one = df.groupBy((x if "map<" not in kind and kind != "variant" else x.cast("string")).alias("x")).agg(F.count(F.lit(1)).alias("n"))
        one = one.select(F.lit(c).alias("column"), F.col("x").isNotNull().alias("there"), F.lit(None).cast("string").alias("value") if c in numeric else F.col("x").cast("string").alias("value"), F.col("x").cast("double").alias("v") if c in numeric else F.lit(None).cast("double").alias("v"), "n")
        counts = one if counts is None else counts.unionByName(one)
    counts = sinks.written(counts)
    there = F.col("there")
    s = sinks.written(counts.groupBy("column").agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(~there, F.col("n"))), F.lit(0)).alias("nulls"), F.count_if(there).alias("distinct")))
    few_ones = s.filter(F.col("distinct") <= few).filter(~F.col("column").isin(numeric)).select("column")
    best = W.first_of(counts.filter(there).join(F.broadcast(few_ones), "column", "left_semi"), ["column"], F.desc("n"), F.col("value"), n=top)  # at most `few` rows of a column
    tops = best.groupBy("column").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "value"))), lambda x: F.concat(x["value"], F.lit("="), (-x["m"]).cast("string"))), ",").alias("top"))
    out = s.join(tops, "column", "left")
    if not numeric:
        return out.select("column", "rows", "nulls", "distinct", *(F.lit(None).cast("double").alias(c) for c in ("min", "max", "p50", "p95")), "top")
    q = quantiles(counts.filter(F.col("column").isin(numeric)), ["column"], "v", {"min": 0.0, "p50": 0.5, "p95": 0.95, "max": 1.0}, limit, "n")
    return out.join(q, "column", "left").select("column", "rows", "nulls", "distinct", "min", "max", "p50", "p95", "top")
