"""Multiset appends by counts: an append adds what a table doesn't hold as often yet, and shuffles the new rows only.

The table keeps each distinct row with a number of occurrences, in files bucketed by a 128-bit row hash. An append groups its own
rows by that hash and joins them with the hashes and numbers of what is there, a scan of three columns that is bucketed as the join
needs it, so only new rows are shuffled. What it must add (occurrences beyond those that are there, as EXCEPT ALL has it) is appended
to the buckets under a number of its own, which counts once the log names it.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tipoff.sources.buckets import row_hash
from tipoff.sources.commits import CommitLog

HASHES, TIMES, APPEND = ["_hash_a", "_hash_b"], "_times", "_append"


class MultisetTable:
    """Rows of one schema under a path; repeated rows count."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, n: int = 32) -> None:
        self.spark, self.path, self.columns, self.n = spark, path.rstrip("/"), schema.names, n
        self.log = CommitLog(spark, path)
        self.name = f"multiset_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + [f"`{h}` bigint" for h in HASHES] + [f"`{TIMES}` bigint", f"`{APPEND}` bigint"]
        self.fields = ", ".join(fields)
        self._define((self.log.entry(self.log.head()) or {"folder": "rows"})["folder"])

    def _define(self, folder: str) -> None:
        """Any session that opens the path has the table in its catalogue."""
        self.folder = folder
        self.table = f"{self.name}_{hashlib.sha256(folder.encode()).hexdigest()[:8]}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({self.fields}) USING parquet CLUSTERED BY ({', '.join(HASHES)}) INTO {self.n} BUCKETS LOCATION '{self.path}/{folder}'")

    def _committed(self) -> DataFrame:
        entry = self.log.entry(self.log.head()) or {"appends": []}
        return self.spark.table(self.table).filter(F.col(APPEND).isin(entry["appends"]))

    def missing(self, new: DataFrame) -> DataFrame:
        """The distinct rows to add, with the number of occurrences that the table lacks."""
        hashed = new.select(*self.columns, *(row_hash(self.columns, k).alias(h) for k, h in enumerate(HASHES)))
        mine = hashed.groupBy(*HASHES).agg(F.count(F.lit(1)).alias("_new"), F.first(F.struct(*self.columns)).alias("_row"))
        mine = mine.repartition(self.n, *HASHES)  # as the table's buckets are
        there = self._committed().groupBy(*HASHES).agg(F.sum(TIMES).alias("_old"))
        lacking = F.col("_new") - F.coalesce("_old", F.lit(0))
        return mine.join(there.hint("merge"), HASHES, "left").filter(lacking > 0).select("_row.*", *HASHES, lacking.alias(TIMES))

    def append(self, new: DataFrame) -> int:
        """The version that holds the rows now. If another writer commits first this append is refused (Conflict) and leaves nothing that counts."""
        head = self.log.head()
        entry = self.log.entry(head) or {"folder": self.folder, "appends": []}
        number = uuid.uuid4().int >> 66
        self.missing(new).withColumn(APPEND, F.lit(number)).write.insertInto(self.table)
        self.log.commit(head + 1, entry | {"appends": [*entry["appends"], number]})
        return head + 1

    def read(self) -> DataFrame:
        """All rows, each as often as it occurs."""
        return self._committed().withColumn(TIMES, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(TIMES)))).select(*self.columns)

    def compact(self) -> int:
        """One row for each distinct row, in new files; a scan by bucket without a shuffle."""
        head, old = self.log.head(), self._committed()
        whole = old.groupBy(*HASHES).agg(F.first(F.struct(*self.columns)).alias("_row"), F.sum(TIMES).alias(TIMES))
        number, folder = uuid.uuid4().int >> 66, f"rows-{uuid.uuid4().hex}"
        self._define(folder)
        whole.select("_row.*", *HASHES, TIMES, F.lit(number).alias(APPEND)).write.insertInto(self.table)
        self.log.commit(head + 1, {"folder": folder, "appends": [number]})
        return head + 1
