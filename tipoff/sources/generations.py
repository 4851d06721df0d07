"""Dataset generations: immutable versions of a workload by pairs (for example season and type), named by their content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.sources import sinks
from tipoff.sources.buckets import Buckets

EMPTY = "_sentinel"


class Generations:
    """Rows of covered pairs; a pair that was looked for and has no rows keeps one sentinel row, so that it counts as covered.

    An upsert replaces the rows of the pairs that it covers and leaves all others; only their buckets are rewritten. Its generation is named by
    content, so a repeat names the generation that is there and writes none. The log entry is the pointer that swaps at once.
    """

    def __init__(self, spark: SparkSession, path: str, pair: list[str], n: int = 64) -> None:
        self.pair, self.table = pair, Buckets(spark, path, pair, n)

    def upsert(self, rows: DataFrame, covered: DataFrame | None = None) -> str:
        """The name of the generation that holds now. Rows without a whole pair, or outside the covered pairs, are an error."""
        rows = sinks.written(rows.distinct())
        pairs = sinks.written((covered if covered is not None else rows).select(*self.pair).distinct())
        bad = F.greatest(*(F.col(c).isNull().cast("int") for c in self.pair), F.lit(0)) > 0
        stray = rows.filter(bad).select(*self.pair).unionByName(pairs.filter(bad)).limit(1).collect() or rows.join(pairs, self.pair, "left_anti").select(*self.pair).limit(1).collect()
        if stray:
            raise ValueError(f"rows fall outside the covered pairs: {stray[0].asDict()}")
        lacking = pairs.join(rows.select(*self.pair).distinct(), self.pair, "left_anti")
        own = [c for c in rows.columns if c not in self.pair]
        sentinels = lacking.select(*self.pair, *(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in own), F.lit(True).alias(EMPTY))
        self.table.replace(pairs, rows.withColumn(EMPTY, F.lit(False)).unionByName(sentinels))
        return self.name()

    def name(self, version: int | None = None) -> str:
        return f"generation-{self.table.name(version)[:32]}"

    def load(self, pairs: DataFrame | None = None, version: int | None = None) -> DataFrame:
        """The rows, of some pairs if given (only their buckets are read)."""
        if pairs is None:
            return self.table.read(version=version).filter(~F.col(EMPTY)).drop(EMPTY)
        return self.table.read(self.table.of(pairs), version).filter(~F.col(EMPTY)).drop(EMPTY).join(pairs.select(*self.pair).distinct(), self.pair, "left_semi")

    def coverage(self, version: int | None = None) -> DataFrame:
        """Covered pairs and their rows (0 for those that only have a sentinel)."""
        return self.table.read(version=version).groupBy(*self.pair).agg(F.count_if(~F.col(EMPTY)).alias("rows"))

    def manifest(self, version: int | None = None) -> dict:
        """Name, version, schema, rows (with and without sentinels) and covered pairs."""
        state = self.table.state(version)
        c = self.coverage(version).agg(F.count(F.lit(1)), F.count_if(F.col("rows") == 0), F.coalesce(F.sum("rows"), F.lit(0))).collect()[0]
        return {"generation": self.name(version), "version": self.table.log.head() if version is None else version, "schema": state["schema"], "rows": c[2], "rows_stored": sum(b["rows"] for b in state["buckets"].values()), "pairs": c[0], "empty_pairs": c[1]}
