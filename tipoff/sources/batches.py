"""Atomic batches of chunks: several chunks of several tables become visible with one log entry, or not at all."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tipoff.sources.commits import CommitLog, Conflict, Folder
from tipoff.sources.sinks import content_hash

#: Bookkeeping columns of stored chunks.
CHUNK, INDEX, ROW = "_chunk_id", "_chunk_index", "_row_index"


@dataclass
class Chunk:
    """A table's rows from one source (its identity: endpoint, parameters, ...); index orders chunks on reading."""

    table: str
    frame: DataFrame
    source: dict
    index: int = 0
    replace: bool = False

    @property
    def id(self) -> str:
        """A digest of the source's identity, whatever the order of its parts."""
        return hashlib.sha256(json.dumps([self.table, self.source], sort_keys=True, default=str).encode()).hexdigest()


@dataclass
class Persisted:
    version: int
    inserted: int = 0
    replayed: int = 0
    replaced: int = 0
    rows: int = 0


@dataclass
class BatchStore:
    """Chunks of several tables under one path."""

    spark: SparkSession
    path: str
    log: CommitLog = field(init=False)

    def __post_init__(self) -> None:
        self.path = self.path.rstrip("/")
        self.log, self.files = CommitLog(self.spark, self.path), Folder(self.spark, self.path)

    ENTRY = "seq long, table string, chunk_id string, chunk_index long, rows long, hash string, folder string, schema string"

    def journal(self) -> DataFrame:
        """The last entry of every chunk of every table."""
        if self.log.head() < 0:
            return self.spark.createDataFrame([], self.ENTRY)
        all_ = self.spark.read.schema(f"chunks array<struct<{self.ENTRY.replace(' string', ':string').replace(' long', ':long')}>>").json(f"{self.log.folder.path}/*.json").select(F.explode("chunks").alias("c")).select("c.*")
        return all_.groupBy("table", "chunk_id").agg(F.max_by(F.struct(*all_.columns), "seq").alias("c")).select("c.*")

    def persist(self, chunks: list[Chunk], before_commit: Callable[[], None] | None = None) -> Persisted:
        """Store a batch: known chunks with the same content are replays, with other content an error unless they replace.

        Data is written first and seen only once the batch's one log entry is there; if anything fails before, what was written goes. A batch
        from another writer that came first is looked at: if it touched none of these chunks this one goes behind it, else it is refused.
        """
        if not chunks:
            return Persisted(self.log.head())
        ids = [(c.table, c.id) for c in chunks]
        if len(set(ids)) < len(ids):
            raise ValueError("a batch names a chunk twice")
        head, out, wrote, entries = self.log.head(), Persisted(-1), [], []
        known = self._known(chunks)
        try:
            for c in chunks:
                h = content_hash(c.frame).collect()[0]
                mark = f"{h.rows}-{h.xor}-{h.sum}"
                old = known.get((c.table, c.id))
                if old and old.hash == mark:
                    out.replayed += 1
                    continue
                if old and not c.replace:
                    raise ValueError(f"chunk {c.id[:12]} of {c.table} was stored with other content")
                folder = f"{c.table}/chunk-{uuid.uuid4().hex}"
                wrote.append(folder)
                rows = c.frame.withColumn(ROW, F.monotonically_increasing_id()).withColumn(CHUNK, F.lit(c.id)).withColumn(INDEX, F.lit(c.index).cast("long"))
                rows.write.parquet(f"{self.path}/{folder}")
                entries.append({"table": c.table, "chunk_id": c.id, "chunk_index": c.index, "rows": h.rows, "hash": mark, "folder": folder, "schema": c.frame.schema.json()})
                out.replaced += bool(old)
                out.inserted += not old
                out.rows += h.rows
            if before_commit:
                before_commit()
            while entries:
                try:
                    self.log.commit(head + 1, {"chunks": [e | {"seq": head + 1} for e in entries]})
                    break
                except Conflict:
                    theirs = self.log.entry(head + 1)["chunks"]
                    if {(e["table"], e["chunk_id"]) for e in theirs} & set(ids):
                        raise
                    head += 1
        except BaseException:
            for folder in wrote:
                self.files.delete(folder)
            raise
        out.version = head + bool(entries)
        return out

    def _known(self, chunks: list[Chunk]) -> dict:
        """The journal's entries of some chunks."""
        wanted = self.spark.createDataFrame([(c.table, c.id) for c in chunks], "table string, chunk_id string")
        return {(r.table, r.chunk_id): r for r in self.journal().join(F.broadcast(wanted), ["table", "chunk_id"], "left_semi").collect()}

    def materialize(self, table: str, types: dict[str, str] | None = None, ordered: bool = True) -> DataFrame:
        """A table's chunks without bookkeeping columns, by chunk index, row index and chunk id: columns by name, missing ones null, all cast to one type.

        types names the target columns; without it, each column has the type that the chunk of the highest index gives it. Chunks are read together by schema, and
        a column that one lacks is null there.
        """
        groups: dict[str, list] = {}
        for r in self.journal().filter(F.col("table") == table).orderBy("chunk_index", "chunk_id").collect():  # one for each chunk
            groups.setdefault(r.schema, []).append(r.folder)
        if not groups:
            raise ValueError(f"no chunk of {table}")
        schemas = {s: StructType.fromJson(json.loads(s)) for s in groups}
        if types is None:
            types = {f.name: f.dataType.simpleString() for s in schemas.values() for f in s}
        out = None
        for s, folders in groups.items():
            held = StructType([*schemas[s], StructField(ROW, LongType()), StructField(CHUNK, StringType()), StructField(INDEX, LongType())])
            df = self.spark.read.schema(held).parquet(*(f"{self.path}/{f}" for f in folders))
            cols = [(F.col(c).try_cast(t) if c in schemas[s].names else F.lit(None).cast(t)).alias(c) for c, t in types.items()]
            one = df.select(*cols, INDEX, ROW, CHUNK)
            out = one if out is None else out.unionByName(one)
        return (out.orderBy(INDEX, ROW, CHUNK) if ordered else out).select(*types)
