"""Generated dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tipoff.functions.scalars import season_of


def calendar(span: DataFrame) -> DataFrame:
    """One row a day between the dates lo and hi of a one-row frame; weekdays are 1 (Monday) to 7."""
    d = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day"))
    day = F.col("day")
    return d.select(
        "day", F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"), F.date_format(day, "yyyy-MM-dd").alias("iso"), (F.weekday(day) + 1).alias("weekday"),
        F.date_format(day, "EEEE").alias("day_name"), F.date_format(day, "MMMM").alias("month_name"), (F.weekday(day) >= 5).alias("is_weekend"), season_of(day).alias("season"),
    )
