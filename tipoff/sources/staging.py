"""Staged tables and literal lookups."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tipoff.functions.scalars import EVENT_NAMES

#: Season phases by id.
PHASES = ("Preseason", "Regular", "Play-In", "Playoffs R1", "Playoffs R2", "Conference Finals", "Finals", "All-Star")


def load_staging(spark: SparkSession, base: str, keys: list[str], prefix: str | None = None) -> dict[str, DataFrame]:
    """A lazy frame for each staged table that is there; keys may be narrowed by a prefix, missing tables are left out."""
    out = {}
    for k in keys:
        if prefix is None or k.startswith(prefix):
            try:
                out[k] = spark.read.parquet(f"{base}/{k}.parquet")
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                    raise
    return out


def event_types(spark: SparkSession) -> DataFrame:
    """The play event types, with the code that stands for all others."""
    rows = [*EVENT_NAMES.items(), (18, "unknown")]
    return spark.createDataFrame(rows, "event_type_id int, event_type string")


def phases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, n, k) for k, n in enumerate(PHASES, 1)], "phase_id int, phase_name string, phase_order int")
