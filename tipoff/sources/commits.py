"""A folder's commit log: numbered JSON entries that are written whole, once, and never changed.

An entry is written under another name and then renamed; a number that is taken makes the rename fail, so of two writers that start
from the same entry only one gets through. Readers see whole entries only. This needs a file system whose rename is atomic and
refuses existing names.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer committed first."""


class Folder:
    """File operations on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.conf, self.jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
        self.fs = self.at().getFileSystem(self.conf)

    def at(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """Sorted names in a folder; none if it isn't there."""
        p = self.at(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.at(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def rename(self, old: str, new: str) -> None:
        """Fails with Conflict if the new name is there."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.at().toUri(), self.conf)
        kind = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        try:
            context.rename(self.at(old), self.at(new), how)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
                raise Conflict(f"{self.path}/{new} is there") from None
            raise

    def delete(self, name: str = "") -> None:
        self.fs.delete(self.at(name), True)


class CommitLog:
    """Entries 0, 1, ... of a folder; the last one tells the state."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.folder = Folder(spark, f"{path.rstrip('/')}/_log")

    def head(self) -> int:
        """The last entry's number, -1 before the first."""
        return max((int(n[:-5]) for n in self.folder.names() if n.endswith(".json")), default=-1)

    def entry(self, number: int) -> dict | None:
        return json.loads(self.folder.read(f"{number:012d}.json")) if number >= 0 else None

    def commit(self, number: int, entry: dict) -> None:
        """Write entry `number`, unless it is there."""
        temporary = f".{uuid.uuid4().hex}"
        self.folder.write(temporary, json.dumps(entry, sort_keys=True))
        try:
            self.folder.rename(temporary, f"{number:012d}.json")
        finally:
            self.folder.delete(temporary)
