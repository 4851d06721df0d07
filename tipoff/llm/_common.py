"""What the training-data operators share: shipping code, scratch tables, table checks."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Held-out rows have this remainder of crc32(doc_id) by FOLDS.
FOLDS, HELD_OUT = 4, 2


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so workers need no copy of the repository."""
    sc = spark.sparkContext
    if getattr(sc, "_tipoff_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="tipoff-"), "tipoff_code.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(d, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(out)
    sc._tipoff_shipped = True


def release() -> None:
    """Give freed memory back to the system: Python workers stay for later tasks, beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
    if trim:
        trim(0)


def tidy(rows: Callable) -> Callable:
    """A function from batches to batches that releases memory at the end of its task."""

    @functools.wraps(rows)
    def run(*args, **named):
        try:
            yield from rows(*args, **named)
        finally:
            release()

    return run


def tidied(group: Callable) -> Callable:
    """A function of groups that releases memory after each."""

    @functools.wraps(group)
    def run(*args):
        try:
            return group(*args)
        finally:
            release()

    return run


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a new local one where it is unset (tests)."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        there = getattr(spark.sparkContext, "_tipoff_dir", None)
        if there is None:
            there = spark.sparkContext._tipoff_dir = "file://" + tempfile.mkdtemp(prefix="tipoff-shared-")
    return there.rstrip("/")


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate Parquet tables in the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.base = f"{shared_dir(spark)}/tipoff-{uuid.uuid4().hex}"
        self.n, self.tables = 0, []

    def keep(self, df: DataFrame, name: str = "t", by: str | None = None) -> DataFrame:
        """The frame as a written table; with `by`, a folder for each of that column's few values, which can be dropped by itself."""
        self.n += 1
        path = f"{self.base}/{self.n}-{name}"
        was = self.spark.conf.get(CLEAN, None)
        self.spark.conf.set(CLEAN, "true")  # the job's shuffle files have no reader after the table is written
        try:
            (df.write.partitionBy(by) if by else df.write).parquet(path)
        finally:
            self.spark.conf.unset(CLEAN) if was is None else self.spark.conf.set(CLEAN, was)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._tipoff_path = path
        self.tables.append(out)
        return out

    def close(self, *kept: DataFrame) -> None:
        """Delete all tables but those that a result still reads."""
        paths = {t._tipoff_path for t in kept}
        self.drop(*(t for t in self.tables if t._tipoff_path not in paths))

    def free(self) -> None:
        """Let Spark delete the shuffle files of finished jobs now rather than when the driver next collects garbage."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *tables: DataFrame, folder: str = "") -> None:
        """Delete tables, or one folder of each, that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for t in tables:
            p = jvm.org.apache.hadoop.fs.Path(t._tipoff_path + folder)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def columns(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; extra columns never reach an operator, so clashing names can't matter."""
    return df.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """crc32 of doc_id as text, by FOLDS, is HELD_OUT; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fan_out(df: DataFrame, keys: Iterable[str], factor: int = 1) -> DataFrame:
    """Spread rows over the session's shuffle partitions by keys."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, n * factor), *keys)


def bounded(rows: DataFrame, n: int, *key: str) -> DataFrame:
    """At most n rows, those of the smallest hash of key: a sample that doesn't depend on the table's order.

    A first cut at about 2 n rows by the hash keeps the sort small on any table.
    """
    total, cells = rows.count(), 1 << 30
    h = F.pmod(F.xxhash64(*key), F.lit(cells))
    near = rows.filter(h < int(cells * 2.0 * n / total)) if total > 2 * n else rows
    return near.orderBy(h, *key).limit(n)
