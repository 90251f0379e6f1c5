"""Shortest-pack-first packing of token pieces over their length histogram.

Documents are cut into pieces of at most ``part`` ids. The histogram of piece lengths
has at most ``part`` rows, so the packing itself runs on counts: lengths are placed
longest first, each into the shortest kind of pack that has room, and a kind of pack
(a pattern: which lengths, how often) carries the number of packs of that kind. The
patterns are joined back to the pieces by rank: the r-th piece of a length takes the
r-th slot of that length.

Ranks are not made by a window per length, as one length may hold a third of the
pieces: each task numbers its own pieces per length, and the tasks' counts are summed.
Those counts grow with the tasks, so they are merged with the pieces, never broadcast; a
key of that join is one task's pieces of one length.

Rows: a null text counts as empty and has the end id alone; repeated rows and null
document ids are packed like others. An empty table gives no rows. Memory: a batch of
texts; on the driver the histogram and the patterns, which depend on ``part`` alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.common import map_batches, texts_of, written
from tickloom.llm.token_cache import cache

CAPACITY = 2048
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task int, rank_in_task bigint"


@dataclass(frozen=True)
class Slots:
    """A run of slots: ranks from ``rank`` on of ``length`` lie in packs from ``sequence`` on, ``times`` in each."""

    length: int
    rank: int
    sequence: int
    times: int
    offset: int


def cut_documents(docs: DataFrame, tokenizer_path: str, part: int, end_id: int = 1) -> DataFrame:
    """Encode all texts and cut them; a piece knows its rank among its task's pieces of that length."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = cache(tokenizer_path), TaskContext.get().partitionId()
        end, met = np.array([end_id], dtype="<u4").tobytes(), Counter()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, part):
                    length = min(part, total - start)
                    rows.append((doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), total, task, met[length]))
                    met[length] += 1
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], [x.split()[0] for x in PIECES.split(", ")])

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), step, PIECES)


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Place all lengths, longest first, each into the shortest packs with room for it.

    ``kinds`` holds, per filled length, the patterns of that length with their number
    of packs; a pattern is a tuple of (length, times).
    """
    kinds: dict[int, dict[tuple, int]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            filled = min((x for x in kinds if x + length <= capacity), default=None)
            if filled is None:
                # New packs take as many of this length as fit, one after another.
                times = capacity // length
                full, rest = divmod(left, times)
                for n, packs in ((times, full), (rest, 1)):
                    if n and packs:
                        kinds.setdefault(n * length, {})[((length, n),)] = packs
                break
            pattern, packs = kinds[filled].popitem()
            taken = min(packs, left)
            if not kinds[filled] and taken == packs:
                del kinds[filled]
            elif taken < packs:
                kinds[filled][pattern] = packs - taken
            longer = pattern[:-1] + ((length, pattern[-1][1] + 1),) if pattern[-1][0] == length else (*pattern, (length, 1))
            group = kinds.setdefault(filled + length, {})
            group[longer] = group.get(longer, 0) + taken
            left -= taken
    slots, sequence, ranks = [], 0, Counter()
    for filled in sorted(kinds):
        for pattern, packs in kinds[filled].items():
            offset = 0
            for length, times in pattern:
                slots.append(Slots(length, ranks[length], sequence, times, offset))
                ranks[length] += times * packs
                offset += times * length
            sequence += packs
    return slots


def place(pieces: DataFrame, slots: list[Slots]) -> DataFrame:
    """Adds sequence_id and offset to pieces that have length and rank."""
    ordered = sorted(slots, key=lambda s: (s.length, s.rank))
    names = ("length", "rank", "sequence", "times", "offset")
    table = np.array([[getattr(s, n) for n in names] for s in ordered], dtype=np.int64).reshape(-1, len(names))
    lengths = table[:, 0]
    columns = [c for c in pieces.columns if c != "rank"]
    schema = ", ".join(f"{c} bigint" for c in [*columns, "sequence_id", "offset"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.zeros(len(length), dtype=np.int64)
            for n in np.unique(length):
                own = length == n
                first, last = np.searchsorted(lengths, [n, n + 1])
                at[own] = first + np.searchsorted(table[first:last, 1], rank[own], side="right") - 1
            pack, turn = np.divmod(rank - table[at, 1], table[at, 3])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(table[at, 2] + pack), pa.array(table[at, 4] + turn * length)],
                [*columns, "sequence_id", "offset"])

    return map_batches(pieces, step, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, part: int | None = None, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their sequence and offset there."""
    pieces = written(cut_documents(docs, tokenizer_path, part or capacity, end_id), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.max("rank_in_task").alias("last"))
    by_length = Window.partitionBy("length").orderBy("task")
    before = written(
        counts.select("task", "length", (F.col("last") + 1).alias("n")).select(
            "task", "length", "n", (F.sum("n").over(by_length) - F.col("n")).alias("before")), "piece-counts")
    histogram = {x["length"]: x["n"] for x in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = pieces.join(before.drop("n").hint("merge"), ["task", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("rank_in_task")).alias("rank"))
    return place(ranked, pack_histogram(histogram, capacity))
