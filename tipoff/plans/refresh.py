"""Incremental model runs: changed keys go through the model graph, only their groups are computed again.

Sources and models are keyed tables (see sources.buckets). A change of a source is its rows before and after, for the keys it
touches. A model says which of its own keys a changed row of an input touches; its inputs are cut down to those keys, it is built on them, and
its stored rows of those keys are replaced. What then differs goes on to the models that read it; a model whose rows stay the
same stops the change.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.sources.buckets import Buckets


@dataclass
class KeyedModel:
    """A model with one group of rows for each key.

    touches: for each input, the model's key columns from a row of that input; or a function of the changed rows and all
    frames for keys that need a look-up. limits: inputs that aren't cut down by the model's own key columns, as functions of the input
    and the touched keys (None: read whole).
    """

    name: str
    inputs: list[str]
    keys: list[str]
    build: Callable[[dict[str, DataFrame]], DataFrame]
    touches: dict[str, list[Column] | Callable[[DataFrame, dict[str, DataFrame]], DataFrame]] = field(default_factory=dict)
    limits: dict[str, Callable[[DataFrame, DataFrame], DataFrame] | None] = field(default_factory=dict)


class Warehouse:
    """Stored sources and models under a path."""

    def __init__(self, spark: SparkSession, path: str, sources: dict[str, list[str]], models: list[KeyedModel], n: int = 16) -> None:
        self.spark, self.path = spark, path
        self.models = {m.name: m for m in models}
        self.order = [k for k in TopologicalSorter({m.name: [i for i in m.inputs if i in self.models] for m in models}).static_order() if k in self.models]
        keys = sources | {m.name: m.keys for m in models}
        self.tables = {k: Buckets(spark, f"{path}/{k}", v, n) for k, v in keys.items()}
        self.step = 0

    def frames(self) -> dict[str, DataFrame]:
        return {k: t.read() for k, t in self.tables.items()}

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        """A small frame of changes, written so that it is made once."""
        self.step += 1
        path = f"{self.path}/_changes/{self.step}-{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _put(self, name: str, keys: DataFrame, rows: DataFrame) -> tuple[DataFrame, int]:
        """Replace the keys' rows; the rows that went or came (a row is in both versions if it stays), and the rewritten buckets."""
        t = self.tables[name]
        head = t.log.head()
        rows = self._keep(rows, name)
        done = t.replace(keys, rows)
        if head < 0:
            return rows, done.rewritten
        old = t.read(t.of(keys), head).join(keys, t.keys, "left_semi").select(*rows.columns)
        return self._keep(rows.exceptAll(old).unionByName(old.exceptAll(rows)), f"{name}-changed"), done.rewritten

    def update(self, changes: dict[str, tuple[DataFrame, DataFrame]]) -> list[dict]:
        """Apply changes of sources (touched keys, their rows now) and rebuild what they touch.

        A report for each table: keys computed again, changed rows, rewritten buckets.
        """
        changed, report = {}, []
        new = {k for k, t in self.tables.items() if t.log.head() < 0}
        for name, (keys, rows) in changes.items():
            keys = self._keep(keys.select(*self.tables[name].keys).distinct(), f"{name}-keys")
            changed[name], n = self._put(name, keys, rows)
            report.append({"table": name, "keys": keys.count(), "changed": changed[name].count(), "buckets": n})
        for name in self.order:
            m, keys = self.models[name], None
            frames = self.frames()
            for i in m.inputs:
                if i not in changed:
                    continue
                how = m.touches.get(i, [F.col(k) for k in m.keys])
                mine = how(changed[i], frames) if callable(how) else changed[i].select(*(x.alias(k) for x, k in zip(how, m.keys, strict=True)))
                keys = mine if keys is None else keys.unionByName(mine)
            if keys is None:
                continue
            keys = self._keep(keys.select(*m.keys).dropna().distinct(), f"{name}-keys")
            n_keys = keys.count()
            if not n_keys:
                continue
            if {name, *m.inputs} <= new:  # all rows of all inputs have come: every key is touched
                changed[name], n = self._put(name, keys, m.build({i: frames[i] for i in m.inputs}).dropna(subset=m.keys))
            else:
                changed[name], n = self._put(name, keys, m.build({i: self._limited(m, i, frames[i], keys) for i in m.inputs}))
            rows = changed[name].count()
            if not rows:
                changed.pop(name)  # nothing that later models read has changed
            report.append({"table": name, "keys": n_keys, "changed": rows, "buckets": n})
        return report

    def _limited(self, m: KeyedModel, i: str, df: DataFrame, keys: DataFrame) -> DataFrame:
        if i in m.limits:
            return m.limits[i](df, keys) if m.limits[i] else df
        t = self.tables[i]
        if t.keys == m.keys:  # bucketed alike: only the touched buckets are read
            df = t.read(t.of(keys))
        return df.join(keys, m.keys, "left_semi")
