"""Removal of passages that recur, located by sharded Aho-Corasick automata.

A window is 35 consecutive words. Each window has an anchor, the least hash of the
eight-word phrases in it; equal windows have equal anchors, and neighbouring windows
mostly share theirs, so a text is a list of short runs of windows with one anchor.

1. Anchors are counted over all texts. Runs whose anchor recurs are the candidates:
   their words are cut out as segments. Equal texts are cut once and count as two.
2. Segments are dealt by anchor into shards of bounded size. All equal windows meet in
   a shard, which confirms those that occur twice by their words, compiles them into an
   automaton and streams its segments through it to locate every occurrence.
3. An anchor of very many segments (a passage that a large part of the texts share)
   is split over several shards. Its windows are counted by a shuffle that combines
   before it sends, and the recurring ones are told to each of its shards.
4. The places found are merged per text, and the words they cover are taken out.

Rows: a null text has no words; a text of fewer words than a window is unchanged; rows
with equal texts, ids or both are all treated; an empty table gives no rows. Memory: a
slice of texts, a shard, one text's runs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import map_batches, texts_of, written
from tickloom.llm.words import WHITE_PATTERN, joined, slices, sliding_least, words_of

WINDOW, ANCHOR = 35, 8
SHARD_SEGMENTS = 3000
RUNS = "t bigint, u bigint, anchor bigint, first int, last int, weight int"
SEGMENTS = "anchor bigint, parts int, t bigint, u bigint, first int, copies int, words binary"


def text_key(text: Column) -> tuple[Column, Column]:
    """Two hashes that name a text; a null text counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.xxhash64(whole).alias("t"), F.xxhash64(F.lit(1), whole).alias("u")


def _table(columns: dict[str, tuple[object, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, type=k) for x, k in columns.values()], list(columns))


def runs_of(texts: list[bytes], window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, anchor, first and last window, weight.

    The weight is 2 where the anchor stands twice in one text, which may hold the
    same window twice.
    """
    words = words_of(texts)
    counts = np.diff(words.first)
    owner = np.repeat(np.arange(len(texts)), counts)
    n = len(words.hashes) - window + 1
    if n <= 0:
        return (np.zeros(0, dtype=np.int64),) * 5
    anchors = joined(words.hashes, anchor)
    least = sliding_least(anchors, window - anchor + 1)[:n]
    whole = owner[:n] == owner[window - 1:]
    at = np.flatnonzero(whole)
    if not len(at):
        return (np.zeros(0, dtype=np.int64),) * 5
    new = np.concatenate([[True], (np.diff(at) != 1) | (least[at[1:]] != least[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])])
    first = at[new]
    last = at[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])]
    value, text = least[first], owner[first]
    inside = np.flatnonzero(owner[:len(anchors)] == owner[anchor - 1:])
    own = np.sort(anchors[inside] ^ (owner[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    twice = own[1:][own[1:] == own[:-1]]
    weight = 1 + np.isin(value ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), twice)
    base = words.first[text]
    return text, value.view(np.int64), first - base, last - base, weight


def all_runs(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in texts_of(batch)]
            t, u = (batch.column(c).to_numpy() for c in ("t", "u"))
            for a, b in slices(texts):
                text, value, first, last, weight = runs_of(texts[a:b], window, anchor)
                yield _table({
                    "t": (t[a + text], pa.int64()), "u": (u[a + text], pa.int64()), "anchor": (value, pa.int64()),
                    "first": (first, pa.int32()), "last": (last, pa.int32()), "weight": (weight, pa.int32())})

    return map_batches(docs.select(*text_key(F.col("text")), "text"), step, RUNS)


def one_of_each(texts: DataFrame) -> DataFrame:
    """Drop the rows of a text that its task has passed on already: a text of any number
    of copies goes on once per task, so no later step meets them all."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            first = []
            for t, u, copies in zip(*(batch.column(c).to_pylist() for c in ("t", "u", "copies"))):
                first.append(copies == 1 or (t, u) not in seen)
                if copies > 1:
                    seen.add((t, u))
            yield batch.filter(pa.array(first, type=pa.bool_()))

    return map_batches(texts, step, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema))


def segments_of(texts: DataFrame, window: int) -> DataFrame:
    """Cut the words of all candidate runs out of their texts."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            keys = zip(batch.column("t").to_pylist(), batch.column("u").to_pylist())
            for key, text, runs in zip(keys, texts_of(batch), batch.column("runs").to_pylist()):
                words = text.encode().split()
                rows += [
                    (r["anchor"], r["parts"], *key, r["first"], min(r["copies"], 2), b" ".join(words[r["first"]:r["last"] + window]))
                    for r in runs]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], [x.split()[0] for x in SEGMENTS.split(", ")])

    return map_batches(texts, step, SEGMENTS)


def window_counts(segments: DataFrame, window: int) -> DataFrame:
    """Hashes of the windows of the segments with counts, combined per batch."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(batch.column("words").to_pylist())
            if len(words.hashes) < window:
                continue
            owner = np.repeat(np.arange(len(batch)), np.diff(words.first))
            whole = owner[:len(owner) - window + 1] == owner[window - 1:]
            at = owner[:len(whole)][whole]
            anchor, copies = batch.column("anchor").to_numpy()[at], batch.column("copies").to_numpy()[at]
            pairs = np.stack([anchor, joined(words.hashes, window)[whole].view(np.int64)], axis=1)
            unique, place = np.unique(pairs, axis=0, return_inverse=True)
            counts = np.bincount(place.ravel(), copies, len(unique)).astype(np.int64)
            yield _table({"anchor": (unique[:, 0], pa.int64()), "window": (unique[:, 1], pa.int64()), "n": (counts, pa.int64())})

    counted = map_batches(segments.select("anchor", "copies", "words"), step, "anchor bigint, window bigint, n bigint")
    return counted.groupBy("anchor", "window").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor", "window")


FOUND = pa.schema([("t", pa.int64()), ("u", pa.int64()), ("begin", pa.int32()), ("end", pa.int32())])


def locate(segments: pa.Table, told: set[int], window: int) -> pa.Table:
    """Places of the recurring windows of one shard, by an automaton over word numbers."""
    number: dict[bytes, int] = {}
    lines = [[number.setdefault(w, len(number) + 1) for w in words.split()] for words in segments.column("words").to_pylist()]
    parts, copies = segments.column("parts").to_pylist(), segments.column("copies").to_pylist()
    whole: Counter[tuple[int, ...]] = Counter()
    split: set[tuple[int, ...]] = set()
    for line, n, more in zip(lines, parts, copies):
        windows = [tuple(line[k:k + window]) for k in range(len(line) - window + 1)]
        if n == 1:
            for w in windows:
                whole[w] += more
        else:
            split.update(windows)
    recurring = [w for w, n in whole.items() if n > 1]
    if told and split:
        names = list(number)
        listed = list(split)
        hashes = joined(words_of([b" ".join(names[k - 1] for k in w) for w in listed]).hashes, window)[::window]
        recurring += [w for w, h in zip(listed, hashes.view(np.int64).tolist()) if h in told]
    whole.clear()
    split.clear()
    if not recurring:
        return FOUND.empty_table()
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for w in recurring:
        automaton.add_word(w)
    automaton.make_automaton()
    ts, us, firsts = (segments.column(c).to_pylist() for c in ("t", "u", "first"))
    rows: list[tuple[int, int, int, int]] = []
    for line, t, u, first in zip(lines, ts, us, firsts):
        begin = end = -1
        for stop, _ in automaton.iter(tuple(line)):
            start = stop + 1 - window
            if start > end:
                if end >= 0:
                    rows.append((t, u, first + begin, first + end))
                begin = start
            end = stop + 1
        if end >= 0:
            rows.append((t, u, first + begin, first + end))
    return pa.table([pa.array(c, type=k.type) for c, k in zip(list(zip(*rows)) or [[]] * 4, FOUND)], schema=FOUND)


def kept_words(texts: DataFrame) -> DataFrame:
    """Take the places out of the texts and join what is left by one space."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, places in zip(texts_of(batch), batch.column("places").to_pylist()):
                words = text.encode().split()
                stays = np.ones(len(words), dtype=bool)
                for p in places:
                    stays[p["begin"]:p["end"]] = False
                removed.append(int(len(words) - stays.sum()))
                kept.append(b" ".join([words[k] for k in np.flatnonzero(stays)]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("t"), batch.column("u"), pa.array(removed, type=pa.int64()), pa.array(kept, type=pa.string())],
                ["t", "u", "n_removed", "kept"])

    return map_batches(texts, step, "t bigint, u bigint, n_removed bigint, kept string")


def changed_texts(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """t, u, n_removed and kept text of every distinct text that has a recurring window."""
    runs = written(all_runs(docs, window, anchor), "phrase-runs")
    recurring = runs.groupBy("anchor").agg(F.sum("weight").alias("n")).filter("n > 1")
    # Of an anchor of many runs each part is a shard of its own.
    parts = F.ceil(F.col("n") / shard_segments).cast("int")
    candidates = runs.join(recurring.select("anchor", parts.alias("parts")), "anchor")
    once = candidates.groupBy("t", "u", "anchor", "first", "last", "parts").agg(F.count("*").cast("int").alias("copies"))
    per_text = once.groupBy("t", "u").agg(
        F.collect_list(F.struct("anchor", "parts", "first", "last", "copies")).alias("runs"), F.max("copies").alias("copies"))
    texts = docs.select(*text_key(F.col("text")), "text").join(per_text, ["t", "u"])
    texts = written(one_of_each(texts), "phrase-texts")
    segments = written(segments_of(texts, window), "phrase-segments")
    shards = max(1, -(-segments.count() // shard_segments))

    # Anchors in one part share shards; a part of a split one is dealt by its own.
    salt = F.pmod(F.col("t"), F.col("parts")).cast("int")
    shard = lambda salt: F.pmod(F.xxhash64("anchor", salt), F.lit(shards)).cast("int").alias("shard")
    held = segments.select(shard(F.when(F.col("parts") > 1, salt).otherwise(0)), *segments.columns)
    split = segments.filter("parts > 1")
    told = window_counts(split, window).join(split.select("anchor", "parts").distinct(), "anchor")
    told = told.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    told = told.select(shard(F.col("salt")), "window").distinct()

    def of_shard(segments: pa.Table, told: pa.Table) -> pa.Table:
        return locate(segments, set(told.column("window").to_pylist()), window)

    places = held.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(of_shard, "t bigint, u bigint, begin int, end int")
    per_text = places.groupBy("t", "u").agg(F.collect_set(F.struct("begin", "end")).alias("places"))
    return kept_words(texts.select("t", "u", "text").join(per_text, ["t", "u"])).dropDuplicates(["t", "u"])


def with_kept(docs: DataFrame, columns: list[Column], window: int = WINDOW) -> DataFrame:
    """The given columns of the documents, with n_removed and kept (null where nothing is removed)."""
    changed = written(changed_texts(docs, window), "phrase-changed")
    keyed = docs.select(*columns, *text_key(F.col("text")))
    return keyed.join(changed, ["t", "u"], "left").drop("t", "u").withColumn("n_removed", F.coalesce("n_removed", F.lit(0)))


def normal_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_PATTERN), lambda w: w != "")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their recurring passages; a changed text has its new n_chars."""
    out = with_kept(docs, [F.struct(*docs.columns).alias("doc")])
    new = {"text": F.coalesce(F.col("kept"), F.col("doc.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length("kept"), F.col("doc.n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
