"""Live tables as versioned snapshots, one complete version per micro-batch.

A version is derived only from the version before it and its own batch, so a
batch run again after a failure writes the same rows again. Versions are numbered in
the order of their batches and carry the writer and its batch id, so a query with a
new checkpoint, whose batch ids start anew, goes on from the newest state.
"""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, types as T

from tickloom.sources.layout import children

_PREFIX = "version="
# The newest version, the one a repeated batch builds on, and one more.
_RETAINED = 3
# A version is kept at least so long after a newer one: readers that hold it finish.
RETAIN_SECONDS = 3600


# How often versions are looked through for old ones: once in so many writes.
_CLEAN_EVERY = 64


class Version(NamedTuple):
    number: int
    writer: str
    batch_id: int
    name: str


class Snapshot:
    def __init__(self, spark: SparkSession, root: str, name: str, schema: T.StructType, retain_seconds: int = RETAIN_SECONDS):
        self._spark = spark
        self._path = f"{root.rstrip('/')}/{name}"
        self._retain_ms = retain_seconds * 1000
        self.name, self.schema = name, schema

    def _child(self, name: str):
        folder = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{name}")
        return folder.getFileSystem(self._spark._jsc.hadoopConfiguration()), folder

    def _entries(self) -> list[Version]:
        """Versions by number, also those whose write has not ended: one listing."""
        found = []
        for name in children(self._spark, self._path):
            if name.startswith(_PREFIX):
                number, rest = name[len(_PREFIX):].split("-", 1)
                writer, batch_id = rest.rsplit("-", 1)
                found.append(Version(int(number), writer, int(batch_id), name))
        return sorted(found)

    def _complete(self, version: Version) -> bool:
        filesystem, marker = self._child(f"{version.name}/_SUCCESS")
        return filesystem.exists(marker)

    def versions(self) -> list[tuple[str, int]]:
        """Writer and batch id of completed versions, oldest first."""
        return [(v.writer, v.batch_id) for v in self._entries() if self._complete(v)]

    def _read(self, entries: list[Version]) -> DataFrame:
        newest = next((v for v in reversed(entries) if self._complete(v)), None)
        if newest is None:
            return self._spark.createDataFrame([], self.schema)
        return self._spark.read.schema(self.schema).parquet(f"{self._path}/{newest.name}")

    def read(self) -> DataFrame:
        """Newest version; empty if there is none."""
        return self._read(self._entries())

    def before(self, batch_id: int, writer: str = "direct") -> DataFrame:
        """What this batch builds on: the newest version that precedes its own."""
        entries = self._entries()
        own = [v.number for v in entries if (v.writer, v.batch_id) == (writer, batch_id)]
        return self._read([v for v in entries if not own or v.number < own[0]])

    def write(self, rows: DataFrame, batch_id: int, writer: str = "direct") -> DataFrame:
        """Write the batch's version and return it as a table."""
        entries = self._entries()
        own = [v.name for v in entries if (v.writer, v.batch_id) == (writer, batch_id)]
        number = entries[-1].number + 1 if entries else 0
        name = own[0] if own else f"{_PREFIX}{number:012d}-{writer}-{batch_id}"
        rows.select(self.schema.names).write.mode("overwrite").parquet(f"{self._path}/{name}")
        if number % _CLEAN_EVERY == _CLEAN_EVERY - 1:
            self.drop_old()
        return self._spark.read.schema(self.schema).parquet(f"{self._path}/{name}")

    def drop_old(self) -> None:
        """Remove versions, from the oldest on, that a newer one replaced long enough ago."""
        oldest, entries = time.time() * 1000 - self._retain_ms, self._entries()
        for version, newer in zip(entries[:-_RETAINED], entries[1:]):
            filesystem, folder = self._child(newer.name)
            if filesystem.getFileStatus(folder).getModificationTime() >= oldest:
                break
            filesystem, folder = self._child(version.name)
            filesystem.delete(folder, True)
