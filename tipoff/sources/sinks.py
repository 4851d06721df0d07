"""Sinks: partitioned Parquet, CSV, tables, fan-out, multiset and chunk appends, manifests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.sources.commits import Conflict, Folder


def work_dir(spark: SparkSession) -> str:
    """A new folder in the cluster's shared folder (spark.checkpoint.dir); in local mode, a local one where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        return "file://" + tempfile.mkdtemp(prefix="tipoff-")
    return f"{base.rstrip('/')}/tipoff-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, by: str | None = None) -> None:
    """Replace a Parquet table (zstd); with `by`, one folder a value.

    Rows are dealt by value and split by size (Spark's rebalancing, files of spark.sql.adaptive.advisoryPartitionSizeInBytes): a value with most
    of the rows is written by many tasks, small values share one. The table is written beside the path and then renamed into
    place, so what is there stays readable until the new one is whole.
    """
    whole, _, name = path.rstrip("/").rpartition("/")
    whole = whole or "."
    folder, new, old = Folder(df.sparkSession, whole), f".new-{name}-{uuid.uuid4().hex}", f".old-{name}-{uuid.uuid4().hex}"
    w = (df.hint("rebalance", by) if by else df).write.option("compression", "zstd")
    (w.partitionBy(by) if by else w).parquet(f"{whole}/{new}")
    try:
        folder.rename(new, name)
    except Conflict:
        folder.rename(name, old)
        folder.rename(new, name)
        folder.delete(old)


def written(df: DataFrame) -> DataFrame:
    """The frame as it is now, as a written table."""
    path = work_dir(df.sparkSession) + "/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, name: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").saveAsTable(name)


def fan_out(df: DataFrame, sinks: dict, strict: bool = False) -> list[tuple[str, bool, str]]:
    """The frame to several sinks: the first must work; others may fail unless strict. (sink, ok, error) each."""
    report = []
    for k, (name, write) in enumerate(sinks.items()):
        try:
            write(df)
            report.append((name, True, ""))
        except Exception as e:  # a sink may raise anything
            if k == 0 or strict:
                raise
            report.append((name, False, str(e)))
    return report


def export_all(spark: SparkSession, database: str, base: str, formats: list[str], allow_partial: bool = False) -> list[tuple[str, str, bool, str]]:
    """Every table of a catalogue's database to every format: (table, format, ok, error) each, in order of the names.

    Tables whose name starts with an underscore are internal and stay. Each format's folder is replaced as a whole. A table that a format
    can't hold fails alone; the error is raised at the end, unless partial exports are allowed.
    """
    writers = {"parquet": write_parquet, "csv": write_csv, "json": lambda df, path: df.write.mode("overwrite").json(path)}
    if unknown := sorted(set(formats) - set(writers)):
        raise ValueError(f"unsupported formats: {unknown}")
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.name.startswith("_") and not t.isTemporary)
    if not names:
        raise ValueError(f"no table in {database}")
    folder, report = Folder(spark, base), []
    for f in formats:
        folder.delete(f)
    for name in names:
        for f in formats:
            try:
                writers[f](spark.table(f"`{database}`.`{name}`"), f"{base}/{f}/{name}")
                report.append((name, f, True, ""))
            except Exception as e:  # a writer may raise anything
                report.append((name, f, False, str(e)))
    failed = sorted({n for n, _, ok, _ in report if not ok})
    if failed and not allow_partial:
        raise RuntimeError(f"export failed for {failed}")
    return report


def new_rows(new: DataFrame, existing: DataFrame) -> DataFrame:
    """What an append must add: new EXCEPT ALL existing."""
    return new.exceptAll(existing)


def content_hash(df: DataFrame) -> DataFrame:
    """Rows and an order-insensitive hash of a frame, in one pass."""
    h = F.xxhash64(*(F.col(f"`{c}`") for c in sorted(df.columns)))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("xor"), F.sum(F.pmod(h, F.lit(1000003))).alias("sum"))


class ChunkStore:
    """Idempotent chunk appends: a folder for each chunk's content, and a journal table beside them that says which are valid.

    A chunk is written first and then entered in the journal, so one that was cut short is not seen, and any process that opens the
    path sees what earlier ones wrote.
    """

    JOURNAL = "chunk_id string, seq long, rows long, hash string, folder string"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def journal(self) -> DataFrame:
        """The latest entry of each chunk (a row for each chunk)."""
        j = self.spark.createDataFrame([], self.JOURNAL)
        try:
            j = self.spark.read.schema(self.JOURNAL).parquet(f"{self.path}/_journal")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        return j.groupBy("chunk_id").agg(F.max_by(F.struct("seq", "rows", "hash", "folder"), "seq").alias("e")).select("chunk_id", "e.*")

    def append(self, chunk_id: str, df: DataFrame, replace: bool = False) -> bool:
        """False for a replay of the same content; another content under a known id is an error unless replaced."""
        h = content_hash(df).collect()[0]
        mark = f"{h.rows}-{h.xor}-{h.sum}"
        known = self.journal().filter(F.col("chunk_id") == chunk_id).collect()
        if known and known[0].hash == mark:
            return False
        if known and not replace:
            raise ValueError(f"chunk {chunk_id} was written with other content")
        folder = f"chunk-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        self.spark.createDataFrame([(chunk_id, known[0].seq + 1 if known else 0, h.rows, mark, folder)], self.JOURNAL).coalesce(1).write.mode("append").parquet(f"{self.path}/_journal")
        return True

    def materialize(self) -> DataFrame:
        """The valid chunks by column name, missing columns null, without bookkeeping columns."""
        folders = [f"{self.path}/{r.folder}" for r in self.journal().select("folder").collect()]  # one for each chunk
        return self.spark.read.option("mergeSchema", True).parquet(*folders)


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, columns, hash) of each table."""
    out = None
    for name, df in tables.items():
        one = content_hash(df).select(F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"), F.sha2(F.concat_ws("|", "xor", "sum"), 256).alias("content"))
        out = one if out is None else out.unionByName(one)
    return out
