"""The load step: finished frames to their sinks, with a mark, a quality score and a metadata row for each table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.sources import sinks

METADATA = "table string, status string, rows long, columns int, mark string, score double, sinks string, error string"


@dataclass
class Load:
    """What becomes of a table: its mark column (the largest value is its high-water mark), rules, and sinks beside Parquet."""

    frame: DataFrame
    mark: str | None = None
    rules: dict[str, Column] = field(default_factory=dict)
    secondary: dict[str, Callable[[DataFrame], None]] = field(default_factory=dict)


def load_tables(spark: SparkSession, loads: dict[str, Load], path: str, strict: bool = False) -> DataFrame:
    """Write each table to Parquet under path and to its other sinks; a metadata row for each, also written under path.

    A table that fails leaves the others alone: its row says failed and why. One whose secondary sink fails is partial, or failed if
    strict. Rows, mark and broken rules come from one pass over what was written.
    """
    out = []
    for name, load in loads.items():
        try:
            target = f"{path}/{name}"
            report = sinks.fan_out(load.frame, {"parquet": lambda d, to=target: sinks.write_parquet(d, to)} | load.secondary, strict)
            written = spark.read.schema(load.frame.schema).parquet(target)
            bad = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"r{k}") for k, ok in enumerate(load.rules.values())]
            mark = F.max(load.mark) if load.mark else F.lit(None)
            got = written.agg(F.count(F.lit(1)).alias("n"), mark.cast("string").alias("mark"), *bad).collect()[0]
            passed = sum(got[f"r{k}"] == 0 for k in range(len(load.rules)))
            score = 100.0 * passed / len(load.rules) if load.rules else 100.0
            failed = [f"{s}: {e.splitlines()[0][:200]}" for s, ok, e in report if not ok]
            out.append((name, "partial" if failed else "ok", got.n, len(written.columns), got.mark, score, ",".join(s for s, ok, _ in report if ok), "; ".join(failed) or None))
        except Exception as e:  # one table's failure must not stop the others
            out.append((name, "failed", None, None, None, None, None, str(e).splitlines()[0][:200]))
    meta = spark.createDataFrame(out, METADATA)  # a row for each table
    meta.coalesce(1).write.mode("append").parquet(f"{path}/_metadata")
    return meta

