"""Numbered commits beside a dataset: what of its files counts.

Spark writes directories; a job that dies, or that runs again, leaves directories
that must not be read, or not twice.  A commit log is a directory of small files
``00000001.json``, ``00000002.json``, ...  A file is made under a name of its own and
then renamed to the next number, which fails if another writer was first; it never
changes afterwards.  So

* a batch of rows counts from the moment its commit exists, and a batch id that
  has a commit is not written again (``BatchStore``);
* the current version of a corpus is the one that the last commit names, and going
  back is one more commit (``Versions``).

Paths are of any file system that Hadoop reads.  A commit is a few hundred bytes;
the driver lists them, never the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class CommitLog:
    """An append-only list of small records in ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        if not self._fs.exists(self._path(self.path)):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        return sorted(n for n in found if n.endswith(".json") and n[:-5].isdigit())

    def read(self) -> list[dict]:
        """All commits, oldest first."""
        out = []
        for name in self._names():
            stream = self._fs.open(self._path(f"{self.path}/{name}"))
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            out.append(json.loads(text) | {"commit": int(name[:-5])})
        return out

    def append(self, record: dict, after: int | None = None) -> int:
        """Add ``record``; returns its number.

        ``after``: the number of the last commit that the caller has seen.  If
        another writer committed since, nothing is added and ``RuntimeError`` is raised.
        """
        names = self._names()
        last = int(names[-1][:-5]) if names else 0
        if after is not None and last != after:
            raise RuntimeError(f"{self.path}: commit {last} was made since {after}")
        self._fs.mkdirs(self._path(self.path))
        made = self._path(f"{self.path}/_{uuid.uuid4().hex}")
        out = self._fs.create(made, False)
        try:
            out.write(bytearray(json.dumps(record).encode()))
        finally:
            out.close()
        target = self._path(f"{self.path}/{last + 1:08d}.json")
        if self._fs.exists(target) or not self._fs.rename(made, target):
            self._fs.delete(made, False)
            raise RuntimeError(f"{target}: another writer was first")
        return last + 1


class BatchStore:
    """Rows in batches under ``path``, each counted once however often its write is tried."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self.log = CommitLog(spark, f"{self.path}/_commits")

    def batches(self) -> dict[str, dict]:
        return {c["batch"]: c for c in self.log.read()}

    def write(self, df: DataFrame, batch: str, **note) -> bool:
        """Write ``df`` as the batch ``batch`` unless it is there; whether it was written.

        The rows lie in a directory of this attempt; what an attempt leaves that
        dies before its commit is never read.  Of two writers of a batch one commits.
        """
        done = self.log.read()
        if any(c["batch"] == batch for c in done):
            return False
        attempt = f"data/{uuid.uuid4().hex}"
        df.write.format(self.fmt).save(f"{self.path}/{attempt}")
        while True:
            try:
                self.log.append({"batch": batch, "dir": attempt, "schema": df.schema.json(), **note}, after=done[-1]["commit"] if done else 0)
                return True
            except RuntimeError:
                seen, done = len(done), self.log.read()
                if len(done) == seen:
                    raise
                if any(c["batch"] == batch for c in done):
                    return False

    def read(self, schema=None) -> DataFrame | None:
        """The rows of all committed batches; None if there is none and no ``schema`` says how nothing looks."""
        from pyspark.sql.types import StructType

        done = self.log.read()
        if not done:
            return None if schema is None else self.spark.createDataFrame([], schema)
        shape = schema or StructType.fromJson(json.loads(done[-1]["schema"]))
        return self.spark.read.schema(shape).format(self.fmt).load([f"{self.path}/{c['dir']}" for c in done])


class Versions:
    """Versions of a corpus under ``path``, one of them current.  The old ones stay until they are removed by hand."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/_versions")

    def current(self) -> str | None:
        """Directory of the current version; None before the first."""
        done = self.log.read()
        return f"{self.path}/{done[-1]['dir']}" if done else None

    def publish(self, write: Callable[[str], None], count: Callable[[str], int], expected: int, **note) -> str:
        """Make a new version current: write it, read it back, count it, and only then commit.

        ``write`` fills a new directory, ``count`` reads it.  If the count is not
        ``expected``, or anything fails before the commit, the old version stays current.
        """
        done = self.log.read()
        name = f"versions/{uuid.uuid4().hex}"
        where = f"{self.path}/{name}"
        write(where)
        found = count(where)
        if found != expected:
            raise ValueError(f"{where}: {found} rows were read back, {expected} were to be written; the current version stays")
        self.log.append({"dir": name, "rows": found, **note}, after=done[-1]["commit"] if done else 0)
        return where

    def rollback(self) -> str:
        """Make the version before the current one current again (a rollback of a rollback goes further back)."""
        done = self.log.read()
        trail: list[dict] = []
        for c in done:
            if "rollback" in c:
                trail.pop()
            else:
                trail.append(c)
        if len(trail) < 2:
            raise ValueError(f"{self.path}: there is no version to go back to")
        self.log.append({"dir": trail[-2]["dir"], "rows": trail[-2]["rows"], "rollback": done[-1]["commit"]}, after=done[-1]["commit"])
        return f"{self.path}/{trail[-2]['dir']}"
