"""Stretches of a text that repeat with a period, found while its words go by.

A run is a stretch of words with smallest period q (words q apart are the same) of at least
``max(SHORTEST, TIMES * q)`` words that no neighbouring word extends. Words i and i - q that
are the same lie on diagonal q, and a run is a stretch of diagonal q of at least that
length less q.

The words go by in order, and a diagonal's match length grows with each word whose earlier
occurrence lies on it. A word counts by the w words that begin with it, and what an
occurrence is worth depends on its lag: for lags below w only the nearest occurrence of
these w words can belong to a run. Were a run's period d < w not the lag of the nearest
occurrence, the nearer lag p would repeat w + p >= d + p words of the run, so (by the
theorem of Fine and Wilf) p would divide d and be the period of the whole run. And a run of
period d < w = 2 * lag class holds 2 * d >= w matches, so no run is too short for its w.
So one diagonal is active per class of lags (below 16, 16 to 31, 32 to 63, ...), whatever
the text: its length goes up, or it ends, and emits its run if it was long enough. A text
of n words takes n log n time and memory for one class at a time.

Rows: a null or empty text has no words, no run and an empty kept text. Repeated doc_ids
are texts of their own; a null doc_id is kept as it is. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.common import map_batches, texts_of

SHORTEST, TIMES = 24, 3
# Matches that every run has: the least of max(SHORTEST - q, (TIMES - 1) * q) over all q.
_SEED = 16


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _names(words: list[bytes]) -> np.ndarray:
    """The same number for the same word."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))


def _paired(names: np.ndarray, step: int) -> np.ndarray:
    """Names of sequences twice as long, from those ``step`` apart; equal only if all words are."""
    both = names[:-step] * np.int64(len(names) + 1) + names[step:]
    return np.unique(both, return_inverse=True)[1]


def _nearest_lags(names: np.ndarray) -> np.ndarray:
    """Per place how far back its name last stood; 0 if nowhere."""
    order = np.argsort(names, kind="stable")
    lags = np.zeros(len(names), dtype=np.int64)
    same = names[order[1:]] == names[order[:-1]]
    lags[order[1:][same]] = (order[1:] - order[:-1])[same]
    return lags


def _diagonal_runs(lags: np.ndarray, width: int) -> Iterator[Run]:
    """Runs of one class: its active diagonal grows word by word, and emits when it ends."""
    least = 1 if width == _SEED else width // 2
    places = np.flatnonzero((lags >= least) & (lags < width))
    active = begin = at = -1
    for place, lag in zip(places.tolist(), lags[places].tolist()):
        if lag == active and place == at + 1:
            at = place
            continue
        if active > 0:
            yield Run(begin - active, at + width - begin + active, active)
        active, begin, at = lag, place, place
    if active > 0:
        yield Run(begin - active, at + width - begin + active, active)


def runs_of(words: list[bytes]) -> list[Run]:
    """All runs by start, then period."""
    found: list[Run] = []
    if len(words) < SHORTEST:
        return found
    names, width = _names(words), 1
    while True:
        if width >= _SEED:
            lags = _nearest_lags(names)
            if not lags.any():  # nothing so long recurs, nor does anything longer
                break
            found += [r for r in _diagonal_runs(lags, width) if r.length >= max(SHORTEST, TIMES * r.period)]
        # The next class holds lags from ``width`` on, and a run as many times that.
        if width >= _SEED and TIMES * width > len(words) or 2 * width > len(words):
            break
        names = _paired(names, width)
        width *= 2
    return sorted(found, key=lambda r: (r.start, r.period))


def with_planted_run(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """For one doc_id in ten the words from a place on repeat with a period; both follow from its crc32."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def kept_words(words: list[bytes], runs: Iterable[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for run in runs:
        edges[run.start + run.period] += 1
        edges[run.start + run.length] -= 1
    gone = np.cumsum(edges) > 0
    return [w for w, out in zip(words, gone.tolist()) if not out] if gone.any() else words


def longest(runs: list[Run]) -> Run | None:
    """The run of most periods, compared exactly; then the first start, then the least period."""
    best = None
    for run in runs:
        if best is None or run.length * best.period > best.length * run.period:
            best = run
    return best


_COLUMNS = {
    "doc_id": pa.int64(), "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
    "exponent_milli": pa.int64(), "runs_text": pa.string(), "collapsed": pa.string(),
}
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_text string, collapsed string"
DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _row(doc_id: int | None, text: str, planted: bool) -> tuple:
    words = text.encode().split()  # of bytes: at 9 to 13 and 32
    if planted:
        words = with_planted_run(doc_id, words)
    runs = runs_of(words)
    best = longest(runs)
    four = (None,) * 4 if best is None else (*best, 1000 * best.length // best.period)
    listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs).encode()
    return doc_id, len(runs), *four, listed, b" ".join(kept_words(words, runs))


def collapse(docs: DataFrame, *, planted: bool = False, digests: bool = False) -> DataFrame:
    """Per document its runs and its text without their repeats, or the sha256 of both.

    The run listed has the most periods; ``runs_text`` lists all as lines start,length,period.
    ``planted`` changes the words first (see ``with_planted_run``).
    """

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c[:c.index(" ")] for c in (DIGESTS if digests else SCHEMA).split(", ")]
        text = (lambda b: hashlib.sha256(b).hexdigest()) if digests else bytes.decode
        for batch in batches:
            rows = [_row(i, t, planted) for i, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch))]
            rows = [(*r[:6], text(r[6]), text(r[7])) for r in rows]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _COLUMNS.values())], names=names)

    return map_batches(docs.select("doc_id", "text"), step, DIGESTS if digests else SCHEMA)
