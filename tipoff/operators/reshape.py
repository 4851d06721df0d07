"""Reshaping operators: wide to long, slots, id lists, families of tables, pairs, perspective flips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a task pairs.
PAIR_ROWS = 1 << 19


def unpivot(df: DataFrame, keys: list[str], cols: dict[str, str], name: str, value: str, drop_null: bool = True) -> DataFrame:
    """Columns to rows in one scan."""
    rows = F.array(*(F.struct(F.lit(label).alias(name), F.col(c).alias(value)) for c, label in cols.items()))
    out = df.select(*keys, F.explode(rows).alias("_r")).select(*keys, f"_r.{name}", f"_r.{value}")
    return out.filter(F.col(value).isNotNull()) if drop_null else out


def split_ids(df: DataFrame, keys: list[str], ids: str, sep: str, name: str, cast: str = "long") -> DataFrame:
    """An id list to rows with its place in the list, from 1; repeated rows once."""
    out = df.select(*keys, F.posexplode(F.split(ids, sep)).alias("_p", "_v"))
    return out.select(*keys, F.trim("_v").try_cast(cast).alias(name), (F.col("_p") + 1).alias("position")).distinct()


def typed(df: DataFrame, col: str, dtype: str) -> Column:
    """A column cast if it is there, else a typed null."""
    return (F.col(col).try_cast(dtype) if col in df.columns else F.lit(None).cast(dtype)).alias(col)


def stack_family(frames: dict[str, DataFrame], label: str, schema: dict[str, str]) -> DataFrame:
    """Tagged union of tables under one schema: missing columns are null, types are cast."""
    out = None
    for k, df in frames.items():
        part = df.select(F.lit(k).alias(label), *(typed(df, c, t) for c, t in schema.items()))
        out = part if out is None else out.unionByName(part)
    return out


def metric_family(frames: dict[str, DataFrame], label: str, keys: list[str], value: str = "stat_value") -> DataFrame:
    """Narrow tables of one metric each: the metric is the only column that is no key."""
    out = None
    for k, df in frames.items():
        rest = [c for c in df.columns if c not in keys]
        if len(rest) != 1:
            raise ValueError(f"{k}: expected one metric beside {keys}, found {rest}")
        part = df.select(F.lit(k).alias(label), *keys, F.col(rest[0]).cast("double").alias(value))
        out = part if out is None else out.unionByName(part)
    return out


def tagged_union(frames: dict[str, DataFrame], label: str) -> DataFrame:
    """UNION ALL BY NAME with a discriminator."""
    out = None
    for k, df in frames.items():
        part = df.withColumn(label, F.lit(k))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def pair_rows(df: DataFrame, group: list[str], item: str, carry: list[str]) -> DataFrame:
    """Pairs of distinct items that a group (bounded: a line-up, an order) holds, smaller first.

    Rows are dealt by group, PAIR_ROWS to a task: what a task pairs, and what is counted there, doesn't grow with the input.
    """
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PAIR_ROWS))
    items = df.select(*group, item, *carry).repartition(n, *group).dropDuplicates([*group, item])
    a = items.select(*group, F.col(item).alias("first_id"), *carry)
    b = items.select(*group, F.col(item).alias("second_id"))
    return a.join(b, group).filter(F.col("first_id") < F.col("second_id"))


def flip(df: DataFrame, keys: list[str], home: dict[str, str], away: dict[str, str]) -> DataFrame:
    """A game row to two team rows: home and away give the columns of either view."""
    view = lambda label, m: F.struct(F.lit(label).alias("side"), *(F.col(c).alias(n) for n, c in m.items()))
    return df.select(*keys, F.explode(F.array(view("home", home), view("away", away))).alias("_v")).select(*keys, "_v.*")


def on_off(df: DataFrame, keys: list[str], label: str, on: str, off: str, metrics: list[str]) -> DataFrame:
    """On and off rows side by side with differences; labels match after trimming, in any case."""
    tag = F.lower(F.trim(label))
    a = df.filter(tag == on.lower()).select(*keys, *(F.col(m).alias(f"on_{m}") for m in metrics))
    b = df.filter(tag == off.lower()).select(*keys, *(F.col(m).alias(f"off_{m}") for m in metrics))
    return a.join(b, keys).select("*", *((F.col(f"on_{m}") - F.col(f"off_{m}")).alias(f"{m}_delta") for m in metrics))
