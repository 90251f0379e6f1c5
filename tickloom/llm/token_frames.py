"""Token files of independent zstandard frames with a trailing seek table.

A file holds one zstandard frame per document, its ids as little-endian unsigned
32-bit integers, then a skippable frame with the document ids and a skippable frame
with the seek table: per frame its compressed and plain size and the crc32 of its
plain bytes. Any zstandard reader can decompress the whole; a reader of a few
documents reads the tables and then only the frames it wants.

Files are written in ascending doc_id order, one per range of ids, to the shared
folder. A task that runs again writes under a new name; the manifest names the file
of the attempt that was committed.

Rows: a null text counts as empty and has the end id alone; rows with equal ids are
kept, in the order of their texts (null first), and null ids come first. An empty
table gives no rows. Memory: a batch of texts and one document's frame.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.common import map_batches, shared_file, texts_of, written
from tickloom.llm.token_cache import cache
from tickloom.session import new_work_dir

# Magic numbers of the zstandard format and of its seekable form.
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("crc", "<u4")])
DOC = np.dtype([("doc_id", "<i8"), ("known", "u1")])
LEVEL = 3

MANIFEST = "part int, path string, documents bigint, ids bigint"


class FrameWriter:
    """Appends documents to a file; ``close`` writes the tables."""

    def __init__(self, path: str):
        system, inner = shared_file(path)
        self.file = system.open_output_stream(inner, compression=None)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int]] = []

    def append(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.file.write(frame)
        self.entries.append((len(frame), len(ids), zlib.crc32(ids)))
        self.docs.append((doc_id or 0, doc_id is not None))

    def close(self) -> None:
        docs = np.array(self.docs, dtype=DOC).tobytes()
        self.file.write(struct.pack("<II", SKIPPABLE, len(docs)) + docs)
        table = np.array(self.entries, dtype=ENTRY).tobytes() + FOOTER.pack(len(self.entries), CHECKSUMS, SEEKABLE)
        self.file.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)
        self.file.close()


class FrameReader:
    """Reads the tables at once and frames on demand."""

    def __init__(self, path: str):
        system, inner = shared_file(path)
        self.file = system.open_input_file(inner)
        end = self.file.size()
        count, flags, magic = FOOTER.unpack(self._at(end - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        table = end - FOOTER.size - count * ENTRY.itemsize
        self.entries = np.frombuffer(self._at(table, count * ENTRY.itemsize), dtype=ENTRY)
        self.docs = np.frombuffer(self._at(table - 8 - count * DOC.itemsize, count * DOC.itemsize), dtype=DOC)
        self.offsets = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        self.starts = np.concatenate([[0], np.cumsum(self.entries["plain"] // 4, dtype=np.int64)])
        self.unpacker = zstandard.ZstdDecompressor()

    def _at(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset)

    def doc_id(self, k: int) -> int | None:
        return int(self.docs["doc_id"][k]) if self.docs["known"][k] else None

    def ids(self, k: int) -> bytes:
        """The ids of the k-th document; its frame alone is decompressed."""
        ids = self.unpacker.decompress(self._at(int(self.offsets[k]), int(self.entries["packed"][k])), max_output_size=int(self.entries["plain"][k]))
        if zlib.crc32(ids) != self.entries["crc"][k]:
            raise ValueError(f"frame {k} does not match its checksum")
        return ids

    def find(self, doc_ids: set[int]) -> list[int]:
        """Places of the wanted documents, from the tables alone."""
        return np.flatnonzero(np.isin(self.docs["doc_id"], list(doc_ids)) & (self.docs["known"] == 1)).tolist()

    def close(self) -> None:
        self.file.close()


def write_frames(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Encode and write all documents; returns the manifest, one row per file."""
    root = new_work_dir(docs.sparkSession, "token-frames")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = cache(tokenizer_path), TaskContext.get()
        path = f"{root}/ids-{task.partitionId():07d}-{task.taskAttemptId()}.zst"
        end, writer, total = np.array([end_id], dtype="<u4").tobytes(), None, 0
        for batch in batches:
            if writer is None:
                system, inner = shared_file(root)
                system.create_dir(inner)
                writer = FrameWriter(path)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch))):
                writer.append(doc_id, ids + end)
                total += len(ids) // 4 + 1
        if writer is not None:
            writer.close()
            row = [[task.partitionId()], [path], [len(writer.docs)], [total]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=t) for x, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                ["part", "path", "documents", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return written(map_batches(ordered, step, MANIFEST), "token-manifest")


def read_frames(spark: SparkSession, manifest: DataFrame, doc_ids: set[int] | None = None) -> DataFrame:
    """doc_id, start and ids of all documents, or of the wanted ones, from the files.

    The manifest has one short row per file, so its running total is made on the
    driver; files are read by as many tasks.
    """
    files = sorted(manifest.collect(), key=lambda x: x.part)
    before = np.concatenate([[0], np.cumsum([x.ids for x in files], dtype=np.int64)]).tolist()
    schema = "doc_id bigint, start bigint, ids binary"
    if not files:
        return spark.createDataFrame([], schema)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                reader = FrameReader(path)
                wanted = range(len(reader.docs)) if doc_ids is None else reader.find(doc_ids)
                for at in range(0, len(wanted), 200):
                    some = wanted[at:at + 200]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([reader.doc_id(k) for k in some], type=pa.int64()),
                         pa.array([base + int(reader.starts[k]) for k in some], type=pa.int64()),
                         pa.array([reader.ids(k) for k in some], type=pa.binary())],
                        ["doc_id", "start", "ids"])
                reader.close()

    listed = spark.createDataFrame([(x.path, b) for x, b in zip(files, before)], "path string, base bigint")
    return map_batches(listed.repartition(len(files)), step, schema)
