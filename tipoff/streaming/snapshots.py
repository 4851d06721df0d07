"""Incremental jobs: snapshot appends by Structured Streaming, marks, partition refresh, attempt states."""

from __future__ import annotations

import json
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


STORE = "spark.sql.streaming.stateStore"
#: A state store on local disk with a log of changes: a batch reads and writes its own keys, whatever the history's size.
ROCKS = {f"{STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", f"{STORE}.rocksdb.changelogCheckpointing.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def replay_snapshots(spark: SparkSession, landing: str, out: str, state: str, keys: list[str], source: str, schema: StructType, at: str | None = None, delay: str | None = None, most: int = 1 << 30) -> list[dict]:
    """Append landed files to a snapshot table: all that is new since the last run, each batch once. The progress of each batch.

    Rows without a natural key are refused. Exact duplicates (same key and row hash) are removed by streaming state: the query keeps
    the keys and hashes that it has seen in its state store, so a batch looks up its own rows and reads none of the table. With a time column
    `at` and a `delay`, duplicates count within the watermark only and older state is dropped. A batch writes its own folder, so one that is
    run again after a failure replaces what it wrote, from the same state. A batch takes files of up to `most` bytes, so their number
    grows with the landed bytes, not with the files that a job happened to write.
    """
    stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", most).option("recursiveFileLookup", True).parquet(landing)
    rows = stream.dropna(subset=keys).withColumn("row_hash", F.xxhash64(*(F.col(c) for c in schema.names)))
    rows = rows.withWatermark(at, delay).dropDuplicatesWithinWatermark([*keys, "row_hash"]) if at and delay else rows.dropDuplicates([*keys, "row_hash"])

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn("source_endpoint", F.lit(source)).withColumn("snapshot_at", F.current_timestamp())
        stamped.withColumn("snapshot_date", F.to_date("snapshot_at")).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    with settings(spark, ROCKS):
        query = rows.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress]


def merge_marks(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """High-water marks after an update: the larger mark, rows added up."""
    return old.unionByName(new).groupBy(*keys).agg(F.max("mark").alias("mark"), F.sum("n").alias("n"))


def refresh_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions that a frame holds; a large one is written by several tasks."""
    df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def attempt_status(log: DataFrame, keys: list[str], order: str, failed: Column, cap: int) -> DataFrame:
    """The state that a log of attempts leaves: done, failed (with retries), or abandoned beyond the cap."""
    n = F.count_if(failed)
    last = F.max_by(failed, order)
    return log.groupBy(*keys).agg(F.when(n > cap, "abandoned").when(last, "failed").otherwise("done").alias("status"), F.least(n, F.lit(cap)).alias("retries"))


def attempt_states(log: DataFrame, keys: list[str], order: str, at: str, kind: Column, cap: int, now: Column, stale: str) -> DataFrame:
    """The state that a log of starts, successes and failures leaves, without updates in place.

    kind is 'start', 'success' or 'failure' (others are ignored). The last attempt decides: done after a success; failed after a
    failure, or abandoned with cap failures or more; running after a start, or pending again (stale reset) where the start is more
    than the interval `stale` before now.
    """
    x = log.withColumn("_k", kind).filter(F.col("_k").isin("start", "success", "failure"))
    s = x.groupBy(*keys).agg(F.count_if(F.col("_k") == "failure").alias("retries"), F.max_by("_k", order).alias("_last"), F.max_by(at, order).alias("_at"), F.max(now).alias("_now"))
    old = F.col("_at") < F.col("_now") - F.expr(f"interval {stale}")
    status = F.when(F.col("_last") == "success", "done").when(F.col("_last") == "start", F.when(old, "pending").otherwise("running")).when(F.col("retries") >= cap, "abandoned").otherwise("failed")
    return s.select(*keys, status.alias("status"), F.least("retries", F.lit(cap)).alias("retries"))


def stateful_attempts(stream: DataFrame, cap: int = 5) -> DataFrame:
    """The streaming form: per key, a state of failures and the last outcome, one row for each key and batch (key, ok: boolean)."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key, frames, state: GroupState):
        fails, done = state.get if state.exists else (0, False)
        for pdf in frames:
            for ok in pdf.ok:
                fails, done = (fails, True) if ok else (fails + 1, False)
        state.update((fails, done))
        yield pd.DataFrame({"key": [key[0]], "status": ["abandoned" if fails > cap else "done" if done else "failed"], "retries": [min(fails, cap)]})

    return stream.groupBy("key").applyInPandasWithState(step, "key string, status string, retries int", "fails int, done boolean", "update", GroupStateTimeout.NoTimeout)
