"""Curated questions: named queries over the models, with a cap on returned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

MAX_ROWS = 10_000


def capped(df: DataFrame, limit: int) -> DataFrame:
    """A user query's rows, 1 to MAX_ROWS of them: the cap is the feature."""
    return df.limit(max(1, min(limit, MAX_ROWS)))
