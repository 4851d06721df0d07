"""Keyed tables in hash buckets: a commit rewrites only the buckets that its keys fall in.

A version is an entry of the folder's log that names each bucket's folder, rows and content hash, so versions share the folders of
buckets that didn't change, old ones stay readable, and equal content gives equal hashes. Writes are dealt by bucket and split by
size (Spark's rebalancing), so a bucket with a hot key is written by several tasks.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tipoff.sources.commits import CommitLog, Folder

BUCKET = "_bucket"


def row_hash(columns: list[str], seed: int = 0) -> Column:
    return F.xxhash64(F.lit(seed), *(F.col(f"`{c}`") for c in sorted(columns)))


@dataclass
class Outcome:
    """What a commit did: the version that holds now, the buckets that were rewritten, and whether anything changed."""

    version: int
    rewritten: int
    changed: bool


class Buckets:
    """A table under a path, keyed by columns that are never null."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], n: int = 64) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.log, self.files = CommitLog(spark, path), Folder(spark, path)
        first = self.log.entry(0) if self.log.head() >= 0 else None
        self.n = first["n"] if first else n

    def state(self, version: int | None = None) -> dict:
        """The entry of a version (the last one): schema, and for each bucket its folder, rows and hash."""
        number = self.log.head() if version is None else version
        return self.log.entry(number) or {"n": self.n, "schema": None, "buckets": {}, "note": {}}

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n)).cast("int")

    def of(self, keys: DataFrame) -> list[int]:
        """The buckets that some keys fall in (at most n rows)."""
        return sorted(r[0] for r in keys.select(self.bucket()).distinct().collect())

    def read(self, buckets: list[int] | None = None, version: int | None = None) -> DataFrame | None:
        """The table, or what some buckets hold; None before the first commit."""
        state = self.state(version)
        if state["schema"] is None:
            return None
        schema = StructType.fromJson(json.loads(state["schema"]))
        wanted = state["buckets"] if buckets is None else {str(b): state["buckets"][str(b)] for b in buckets if str(b) in state["buckets"]}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{b['folder']}" for b in wanted.values()))

    def replace(self, touched: DataFrame, rows: DataFrame, note: dict | None = None) -> Outcome:
        """All rows of the touched keys give way to `rows`, whose keys must be among them. touched: the key columns, distinct or not.

        A commit that another writer's commit comes before is refused (Conflict), with nothing changed.
        """
        head = self.log.head()
        state = self.state(head)
        schema = rows.schema if state["schema"] is None else StructType.fromJson(json.loads(state["schema"]))
        keys = touched.select(*self.keys).distinct()
        mine = self.of(keys)
        new = rows.select(*(F.col(f.name).cast(f.dataType) for f in schema))
        if mine and state["schema"] is not None:
            new = self.read(mine, head).join(keys, self.keys, "left_anti").select(*schema.names).unionByName(new)
        folder = f"data-{uuid.uuid4().hex}"
        new.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        wrote = self.spark.read.schema(StructType([*schema, StructField(BUCKET, IntegerType())])).parquet(f"{self.path}/{folder}") if any(n.startswith(BUCKET) for n in self.files.names(folder)) else None
        h = row_hash(schema.names)
        found = wrote.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("xor"), F.sum(F.pmod(h, F.lit(1000003))).alias("sum")).collect() if wrote is not None else []
        after = {b: v for b, v in state["buckets"].items() if int(b) not in mine}
        for r in found:  # a row for each rewritten bucket
            after[str(r[BUCKET])] = {"folder": f"{folder}/{BUCKET}={r[BUCKET]}", "rows": r.rows, "hash": f"{r.rows}-{r.xor}-{r.sum}"}
        same = state["schema"] is not None and {b: v["hash"] for b, v in after.items()} == {b: v["hash"] for b, v in state["buckets"].items()}
        if same and (note is None or note == state["note"]):
            self.files.delete(folder)
            return Outcome(head, len(mine), False)
        try:
            self.log.commit(head + 1, {"n": self.n, "schema": schema.json(), "buckets": after, "note": note or {}})
        except BaseException:
            self.files.delete(folder)
            raise
        return Outcome(head + 1, len(mine), True)

    def name(self, version: int | None = None) -> str:
        """A name by content: equal for versions with equal schema and rows."""
        s = self.state(version)
        return hashlib.sha256("|".join([str(s["schema"]), *(f"{b}:{s['buckets'][b]['hash']}" for b in sorted(s["buckets"], key=int))]).encode()).hexdigest()

    def vacuum(self, keep: int = 1) -> int:
        """Delete data that none of the last `keep` versions names; the number of bucket folders that went."""
        head = self.log.head()
        needed = {b["folder"] for v in range(max(0, head - keep + 1), head + 1) for b in self.state(v)["buckets"].values()}
        gone = 0
        for d in self.files.names():
            if d.startswith("data-"):
                inside = [f"{d}/{b}" for b in self.files.names(d) if b.startswith(BUCKET)]
                for b in inside:
                    if b not in needed:
                        self.files.delete(b)
                        gone += 1
                if not any(b in needed for b in inside):
                    self.files.delete(d)
        return gone
