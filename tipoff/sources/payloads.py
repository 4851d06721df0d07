"""Readers of landed JSON: result-set envelopes, live payloads, nested schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.functions.scalars import snake_names
from tipoff.sources import sinks

ENVELOPE = "resultSets array<struct<name: string, headers: array<string>, rowSet: array<array<string>>>>"


def read_envelopes(spark: SparkSession, path: str, headers: dict[str, list[str]], types: dict[str, str] | None = None, aliases: dict[str, str] | None = None, multi_line: bool = True) -> dict[str, DataFrame]:
    """A table for each named result set; values are placed by the file's own header order and cast by column name.

    multi_line: a file holds one envelope; else, one in each line. Files are parsed by Spark, all tables in one pass each; a column that a file lacks is null there.
    """
    sets = spark.read.schema(ENVELOPE).option("multiLine", multi_line).json(path).select(F.explode("resultSets").alias("s")).select("s.*")
    out = {}
    for name, cols in headers.items():
        rows = sets.filter(F.col("name") == name).select("headers", F.explode("rowSet").alias("r"))
        names = snake_names(cols, aliases)
        at = lambda h: F.array_position("headers", h).cast("int")
        value = lambda h: F.when(at(h) > 0, F.try_element_at("r", F.nullif(at(h), F.lit(0))))
        out[name] = rows.select(*(value(h).try_cast((types or {}).get(n, "string")).alias(n) for h, n in zip(cols, names, strict=True)))
    return out


def project_payload(df: DataFrame, payload: str, paths: dict[str, str]) -> DataFrame:
    """Dotted paths of a JSON text column as columns; the payload stays."""
    return df.select("*", *(F.get_json_object(payload, f"$.{p}").alias(n) for n, p in paths.items()))


def flatten_nested(df: DataFrame, array: str, keys: list[str]) -> DataFrame:
    """One row for each struct in an array column, its fields beside the keys."""
    return df.select(*keys, F.explode(array).alias("_x")).select(*keys, "_x.*")


def discover_sets(df: DataFrame, payload: str) -> DataFrame:
    """(path, row) of every array element in JSON texts at any depth: a row for each element, its path without indices.

    One pass over a level of nesting at a time, until a level is empty; each level is written, so it is parsed once.
    """
    spark = df.sparkSession
    base, k, out = sinks.work_dir(spark), 0, None
    level = df.select(F.lit("$").alias("path"), F.try_parse_json(payload).alias("v")).filter(F.col("v").isNotNull())
    while True:
        kids = level.lateralJoin(spark.tvf.variant_explode_outer(F.col("v").outer())).select(
            F.when(F.col("key").isNull(), F.col("path")).otherwise(F.concat_ws(".", "path", "key")).alias("path"), F.col("key").isNull().alias("item"), F.to_json("value").alias("row")
        ).filter(F.col("row").isNotNull())
        kids.write.parquet(f"{base}/{k}")
        kids = spark.read.schema(kids.schema).parquet(f"{base}/{k}")
        rows = kids.filter("item").select("path", "row")
        out = rows if out is None else out.unionByName(rows)
        level = kids.filter(F.col("row").rlike(r"^[\[{]")).select("path", F.parse_json("row").alias("v"))
        if level.isEmpty():
            return out
        k += 1
