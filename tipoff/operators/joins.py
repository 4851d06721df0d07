"""Join operators. Spark picks the algorithm from sizes at run time; none of these forces a broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tipoff.operators.windows import HERE, START, by, by_ranges, first_of


def enrich(fact: DataFrame, *dims: tuple[DataFrame, list[str]]) -> DataFrame:
    """Left joins on key columns; dimensions are deduplicated on their keys so that the fact's grain stays."""
    out = fact
    for dim, keys in dims:
        out = out.join(dim.dropDuplicates(keys), keys, "left")
    return out


def full_outer(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with merged keys."""
    return left.join(right, keys, "full")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Children with a key that no parent has; null keys are ignored."""
    return child.filter(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def as_of(facts: DataFrame, history: DataFrame, keys: list[str], at: str, value: str, tie: Column) -> DataFrame:
    """Each fact with the value of the latest history row strictly before it: one ordered pass over both, no join."""
    name = f"prior_{value}"
    both = facts.withColumn("_side", F.lit(0)).withColumn("_v", F.lit(None).cast(history.schema[value].dataType)).unionByName(
        history.select(*keys, at, F.col(value).alias("_v"), F.lit(1).alias("_side")), allowMissingColumns=True
    )
    w = by(keys, F.col(at), F.col("_side"), tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(name, F.last("_v", ignorenulls=True).over(w)).filter("_side = 0").drop("_side", "_v")


def range_before(events: DataFrame, marks: DataFrame, keys: list[str], seq: str, rows: int) -> DataFrame:
    """Events in the `rows` sequence numbers before each mark: the equal keys shuffle, sequence buckets bound each match."""
    b = F.floor(F.col(seq) / rows)
    e = events.withColumn("_b", b)
    m = marks.select(*keys, F.col(seq).alias("mark_seq"), F.explode(F.array(b, b - 1)).alias("_b"))
    return e.join(m, [*keys, "_b"]).filter((F.col(seq) < F.col("mark_seq")) & (F.col(seq) >= F.col("mark_seq") - rows)).drop("_b")


def self_pairs(df: DataFrame, keys: list[str], side: str, left: str, right: str, cols: list[str]) -> DataFrame:
    """Rows of one side joined with those of the other inside keys: home and away of a game."""
    a = df.filter(F.col(side) == left).select(*keys, *(F.col(c).alias(f"home_{c}") for c in cols))
    z = df.filter(F.col(side) == right).select(*keys, *(F.col(c).alias(f"away_{c}") for c in cols))
    return a.join(z, keys)


def current_join(fact: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a type 2 dimension's current rows; unmatched facts stay."""
    return fact.join(dim.filter("is_current"), keys, "left")


def latest_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return first_of(df, keys, *order)


def nearest(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str, id_col: str) -> DataFrame:
    """Left rows of keys that right has, with the id of the right row whose value is nearest, and the distance d; ties to the smaller id, nulls last.

    Distinct places of both sides are put in one order of (keys, value) and cut into ranges. Inside a range each place sees the right values
    next to it; at a range's ends they come from the other ranges (a row for each range and key). So no pair of rows is made and no
    task holds a key. Of right values that differ but whose distances round to one double, the one next to the place counts as nearest.
    """
    some = right.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.min(id_col).alias("_id")).withColumn("_r", F.struct("_v", "_id"))
    places = left.filter(F.col(at).isNotNull()).select(*keys, F.col(at).alias("_v")).distinct()
    cut = by_ranges(places.withColumn("_side", F.lit(1)).unionByName(some.drop("_id").withColumn("_side", F.lit(0)), allowMissingColumns=True), [*keys, "_v"])
    ends = cut.groupBy(*keys, "_p").agg(F.min("_r").alias("_lo"), F.max("_r").alias("_hi"))
    p = F.col("_p")
    ends = ends.select(*keys, "_p", F.last("_hi", True).over(by(keys, p).rowsBetween(START, -1)).alias("_before"), F.last("_lo", True).over(by(keys, p.desc()).rowsBetween(START, -1)).alias("_after"))
    own = [*keys, "_p"]
    below = F.last("_r", True).over(by(own, F.col("_v"), F.col("_side")).rowsBetween(START, HERE))
    above = F.last("_r", True).over(by(own, F.col("_v").desc(), F.col("_side")).rowsBetween(START, HERE))
    seen = cut.withColumn("_below", below).withColumn("_above", above).filter("_side = 1").join(ends, own)
    far = lambda r: F.when(r.isNotNull(), F.struct(F.abs(F.col("_v") - r["_v"]).alias("d"), r["_id"].alias("id")))
    best = F.least(far(F.coalesce("_below", "_before")), far(F.coalesce("_above", "_after")))
    found = seen.select(*keys, F.col("_v").alias(at), best.alias("_best"))
    whole = right.groupBy(*keys).agg(F.min(F.when(F.col(value).isNotNull(), F.col(id_col))).alias("_any"), F.min(id_col).alias("_least"))
    out = left.join(found, [*keys, at], "left").join(whole, keys)
    near = F.when(F.isnan("_best.d"), F.col("_any")).when(F.col("_best").isNotNull(), F.col("_best.id")).otherwise(F.col("_least"))
    return out.select(*left.columns, near.alias(id_col), F.col("_best.d").alias("d"))
