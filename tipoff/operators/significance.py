"""Tests with p-values and verdicts: differences of two groups, and streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tipoff.functions.statistics import normal_upper, student_two_sided
from tipoff.operators import analysis as N
from tipoff.operators import windows as W

WELCH, RANKS = "Welch's t-test", "Mann-Whitney U"
LEAST_GROUP, LEAST_STREAK = 3, 10


def effect_label(d: Column) -> Column:
    return F.when(d < 0.2, "negligible").when(d < 0.5, "small").when(d < 0.8, "medium").otherwise("large")


def difference(df: DataFrame, group: str, a: str, b: str, value: str, test: str = WELCH, alpha: float = 0.05) -> DataFrame:
    """One row: test_used, statistic, p_value, significant, effect_size (Cohen's d), effect_label, means, sizes and a summary of two groups.

    Fewer than three values in a group, or no spread at all, give no p-value and no verdict.
    """
    x = df.filter(F.col(value).isNotNull() & F.col(group).isin(a, b)).select(group, F.col(value).cast("double").alias(value))
    m = N.moments(x, group, a, b, value)
    pooled = F.sqrt(F.try_divide((F.col("na") - 1) * F.col("va") + (F.col("nb") - 1) * F.col("vb"), F.col("na") + F.col("nb") - 2))
    m = m.withColumn("effect_size", F.when(pooled > 0, F.abs(F.col("ma") - F.col("mb")) / pooled).otherwise(0.0))
    if test == WELCH:
        ea, eb = F.col("va") / F.col("na"), F.col("vb") / F.col("nb")
        dof = (ea + eb) ** 2 / (ea**2 / (F.col("na") - 1) + eb**2 / (F.col("nb") - 1))
        t = (F.col("ma") - F.col("mb")) / F.sqrt(ea + eb)
        m = m.withColumn("_ok", (ea + eb) > 0).withColumn("statistic", F.when(F.col("_ok"), t)).withColumn("dof", F.when(F.col("_ok"), dof))
        m = m.withColumn("p_value", student_two_sided(F.col("statistic"), F.col("dof")))
    elif test == RANKS:
        u = N.rank_sum(x, group, a, b, value).select("u", "ties")  # one row
        m = m.join(F.broadcast(u)).withColumn("dof", F.lit(None).cast("double"))
        n = F.col("na") + F.col("nb")
        sd = F.sqrt(F.col("na") * F.col("nb") / 12.0 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1))))
        z = F.try_divide(F.greatest(F.col("u"), F.col("na") * F.col("nb") - F.col("u")) - F.col("na") * F.col("nb") / 2.0 - 0.5, sd)
        m = m.withColumn("statistic", F.col("u").cast("double")).withColumn("_z", z)
        m = m.withColumn("p_value", F.when(F.col("_z") < 0, 1.0).otherwise(F.least(F.lit(1.0), 2 * normal_upper(F.col("_z")))))
    else:
        raise ValueError(f"unknown test {test}")
    m = m.withColumn("p_value", F.when((F.col("na") >= LEAST_GROUP) & (F.col("nb") >= LEAST_GROUP), F.col("p_value")))
    m = m.withColumn("significant", F.col("p_value") < alpha).withColumn("effect_label", effect_label(F.col("effect_size")))
    text = F.format_string(
        "%s difference (p=%.4f, %s). Effect size: %.2f (%s). Group means: %.2f vs %.2f.",
        F.when(F.col("significant"), "Significant").otherwise("Not significant"), "p_value", F.lit(test), "effect_size", "effect_label", "ma", "mb",
    )
    return m.select(
        F.lit(test).alias("test_used"), "statistic", "dof", "p_value", "significant", "effect_size", "effect_label", F.col("ma").alias("mean_a"), F.col("mb").alias("mean_b"), F.col("na").alias("n_a"), F.col("nb").alias("n_b"),
        F.when(F.col("p_value").isNotNull(), text).alias("summary"),
    )


def streaks(df: DataFrame, keys: list[str], order: list[Column], outcome: str, direction: str = "hot", alpha: float = 0.05) -> DataFrame:
    """For each key: longest and expected longest streak of successes ('hot') or failures ('cold'), runs and the runs test's p-value and verdict.

    Keys with fewer than ten outcomes, or with one outcome only, have no p-value and no verdict.
    """
    target = {"hot": 1, "cold": 0}[direction]
    runs = W.islands(df, keys, order, outcome).groupBy(*keys, "island", outcome).agg(F.count(F.lit(1)).alias("len"))
    total = lambda v: F.sum(F.when(F.col(outcome) == v, F.col("len")).otherwise(0))
    s = runs.groupBy(*keys).agg(F.max(F.when(F.col(outcome) == target, F.col("len")).otherwise(0)).alias("longest"), F.count(F.lit(1)).alias("runs"), total(1).alias("n1"), total(0).alias("n0"))
    n, a, b = (F.col("n1") + F.col("n0")).cast("double"), F.col("n1").cast("double"), F.col("n0").cast("double")
    share = (a if target else b) / n
    expected = F.when((share > 0) & (share < 1), F.log(n) / -F.log(share)).when(share == 1, n).otherwise(0.0)
    mean, var = 1 + 2 * a * b / n, 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
    z = F.abs(F.col("runs") - mean) / F.sqrt(var)
    p = F.when((n >= LEAST_STREAK) & (a > 0) & (b > 0) & (var > 0), 2 * normal_upper(z))
    s = s.select(*keys, "longest", expected.alias("expected_longest"), n.cast("long").alias("n"), (a / n).alias("success_rate"), "runs", mean.alias("expected_runs"), p.alias("p_value"))
    return s.withColumn("significant", F.col("p_value") < alpha)
