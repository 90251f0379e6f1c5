"""What the training-data operators share: reading, batches, shared folders, hashes."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tickloom.session import new_work_dir, prepare_session

# Rows of one Arrow batch: whole texts of many kilobytes must fit a small worker.
ROWS_PER_BATCH = 500


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(prepare_session(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


# Where the library lies, for Python workers whose working folder is another one.
_HOME = str(Path(__file__).resolve().parents[2])


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so a Python worker holds few whole texts at once."""
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _HOME not in known:
        environment["PYTHONPATH"] = os.pathsep.join([_HOME, *known])
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) != str(ROWS_PER_BATCH):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: later steps read files, not lineage."""
    spark = df.sparkSession
    path = new_work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and one length per row."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Whole texts of a batch; a null text counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def map_batches(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(step, schema)


def shared_file(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a file in the shared folder, whatever its scheme."""
    return fs.FileSystem.from_uri(path) if urlparse(path).scheme else (fs.LocalFileSystem(), path)


_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an array of uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
