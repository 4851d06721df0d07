"""Every registered query with its oracle SQL: operators of the warehouse on the driver tables.

Stand-ins: orders are games, order lines are player-game rows (l_suppkey the player, l_partkey the line-up or shot, nation the
team), events are play-by-play, conversations are stints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


class Tables:
    """The tables of a folder as lazy frames: t.orders, t.lineitem, ..."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of Tables under a name, with its oracle."""

    def add(f: Callable[[Tables], DataFrame]):
        _QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            _ORACLE[name] = sql
        return f

    return add


def rounded(df: DataFrame, places: int = 4, *cols: str) -> DataFrame:
    """Doubles rounded, so that another summation order gives the same values."""
    names = cols or tuple(c for c, t in df.dtypes if t == "double")
    return df.select(*(F.round(c, places).alias(c) if c in names else F.col(c) for c in df.columns))


def _load() -> None:
    from tipoff.plans import analysis_queries, composed_queries, core_queries, feature_queries, insight_queries, quality_queries, recipe_queries, run_queries, store_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
