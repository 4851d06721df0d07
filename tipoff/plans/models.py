"""Models as functions of frames, run in dependency order; and the declarative families among them."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.operators.reshape import tagged_union
from tipoff.operators.windows import first_of


@dataclass
class Model:
    name: str
    inputs: list[str]
    build: Callable[[dict[str, DataFrame]], DataFrame]


@dataclass
class Report:
    """Outcome of each model: ok, failed or skipped (an input failed), with seconds to plan and the error."""

    status: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    def slowest(self, n: int = 5) -> list[str]:
        return sorted(self.seconds, key=self.seconds.get, reverse=True)[:n]


def run_models(models: list[Model], staging: dict[str, DataFrame], keep: Callable[[str, DataFrame], DataFrame] | None = None, done: set[str] = frozenset()) -> tuple[dict[str, DataFrame], Report]:
    """Frames of all models (lazy unless `keep` writes them) and a report.

    A failed model marks those that need it as skipped; the others go on. `done` names are taken from staging (resume).
    """
    by = {m.name: m for m in models}
    try:
        order = list(TopologicalSorter({m.name: [i for i in m.inputs if i in by] for m in models}).static_order())
    except CycleError as e:
        raise ValueError(f"models depend on each other: {e.args[1]}") from e
    frames, report = dict(staging), Report()
    for name in order:
        if name in done:
            report.status[name] = "resumed"
            continue
        lacking = [i for i in by[name].inputs if i not in frames]
        if lacking:
            report.status[name] = "skipped"
            report.errors[name] = f"missing {lacking}"
            continue
        began = time.monotonic()
        try:
            df = by[name].build({i: frames[i] for i in by[name].inputs})
            frames[name] = keep(name, df) if keep else df
            report.status[name] = "ok"
        except Exception as e:  # one model's failure must not stop the others
            report.status[name], report.errors[name] = "failed", str(e)
        report.seconds[name] = time.monotonic() - began
    return frames, report


class RunStore:
    """Model outputs as tables of a run, and a log of all runs beside them, from which a run that was cut short resumes."""

    LOG = "run_id string, seq long, model string, status string, rows long, columns int, seconds double, error string"

    def __init__(self, spark: SparkSession, path: str, run_id: str) -> None:
        self.spark, self.path, self.run_id = spark, path, run_id
        self.sizes: dict[str, tuple[int, int]] = {}

    def log(self) -> DataFrame:
        """All entries of all runs."""
        try:
            return self.spark.read.schema(self.LOG).parquet(f"{self.path}/_runs")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], self.LOG)

    def latest(self) -> DataFrame:
        """The last entry of each model of this run (a row for each model)."""
        mine = self.log().filter(F.col("run_id") == self.run_id)
        return mine.groupBy("model").agg(F.max_by(F.struct(*mine.columns), "seq").alias("e")).select("e.*")

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{self.run_id}/{name}"
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.sizes[name] = (out.count(), len(df.columns))  # from the files' footers
        return out

    def run(self, models: list[Model], staging: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], Report]:
        """run_models with every output written and logged; models that the log has as ok in this run are read, not run."""
        wanted = {m.name for m in models}
        before = {r.model: r for r in self.latest().collect()}
        done = {n for n, r in before.items() if r.status == "ok" and n in wanted}
        frames = {n: self.spark.read.parquet(f"{self.path}/{self.run_id}/{n}") for n in done}
        frames, report = run_models(models, staging | frames, self.keep, done)
        seq = 1 + max((r.seq for r in before.values()), default=-1)
        rows = [(self.run_id, seq, n, st, *self.sizes.get(n, (None, None)), report.seconds.get(n), report.errors.get(n)) for n, st in report.status.items() if st != "resumed"]
        self.spark.createDataFrame(rows, self.LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/_runs")
        return frames, report

    def clear(self) -> None:
        """Forget what this run finished: the next one starts anew."""
        last = self.latest().select("run_id", (F.col("seq") + 1).alias("seq"), "model", F.lit("cleared").alias("status"), "rows", "columns", "seconds", "error")
        last.coalesce(1).write.mode("append").parquet(f"{self.path}/_runs")


def run_summary(log: DataFrame) -> DataFrame:
    """Models by status, rows and seconds of each run."""
    return log.groupBy("run_id").agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("ok", "failed", "skipped")), F.sum("rows").alias("rows"), F.sum("seconds").alias("seconds"))


def slowest(log: DataFrame, n: int = 5) -> DataFrame:
    """Each run's n slowest models."""
    return first_of(log, ["run_id"], F.desc_nulls_last("seconds"), F.col("model"), n=n).select("run_id", "model", "seconds")


def passthrough(output: str, source: str) -> Model:
    return Model(output, [source], lambda f: f[source])


def distinct(output: str, source: str) -> Model:
    return Model(output, [source], lambda f: f[source].distinct())


def projection(output: str, source: str, columns: dict[str, str]) -> Model:
    """columns: output name -> source name."""
    return Model(output, [source], lambda f: f[source].select(*(f[source][s].alias(o) for o, s in columns.items())))


def union(output: str, label: str, branches: dict[str, str]) -> Model:
    """branches: discriminator value -> source; sources that were not staged are left out by the caller."""
    return Model(output, list(branches.values()), lambda f: tagged_union({k: f[s] for k, s in branches.items()}, label))


def staged_passthroughs(staging: list[str], prefix: str = "stg_", output: str = "fact_") -> list[Model]:
    """A passthrough for each staged table by the naming rule stg_x -> fact_x."""
    return [passthrough(output + s.removeprefix(prefix), s) for s in staging if s.startswith(prefix)]
