"""Words of many texts at once, as arrays: places, document, 64-bit hash."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from tickloom.llm.common import mix

WHITE_PATTERN = r"[ \t-\r]+"
_STEP = np.uint64(0x9E3779B97F4A7C15)  # an odd factor


class Words(NamedTuple):
    raw: bytes
    starts: np.ndarray  # of each word in ``raw``
    ends: np.ndarray
    first: np.ndarray  # of each text its first word; one more at the end
    hashes: np.ndarray


def lower_ascii(raw: bytes) -> bytes:
    return raw.lower()  # of bytes: A-Z only


def words_of(texts: list[bytes]) -> Words:
    """Words are runs of bytes other than 9 to 13 and 32; UTF-8 letters have no such byte."""
    raw = b" ".join(texts)
    letters = np.frombuffer(raw, dtype=np.uint8)
    inside = (letters != 32) & ((letters < 9) | (letters > 13))
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sizes = ends - starts
    if len(starts):
        place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        powers = np.multiply.accumulate(np.full(int(sizes.max()), _STEP, dtype=np.uint64))
        terms = (letters[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
        hashes = mix(np.add.reduceat(terms, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))
    else:
        hashes = np.zeros(0, dtype=np.uint64)
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths)]) if len(lengths) else np.zeros(1, dtype=np.int64)
    return Words(raw, starts, ends, np.searchsorted(starts, begin), hashes)


def joined(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive hashes, by doubling; one per start that has n."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    size, level, done, out = 1, hashes, 0, None
    while True:
        if n & size:
            part = level[done:done + len(hashes) - n + 1]
            out = part.copy() if out is None else mix(out * _STEP + part)
            done += size
        size *= 2
        if size > n:
            return out
        level = mix(level[:-(size // 2)] * _STEP + level[size // 2:])


def sliding_least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of every n consecutive values."""
    size = 1
    while 2 * size <= n:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (n - size)], values[n - size:]) if n > size else values


def slices(texts: list[bytes], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes, so that arrays over them stay small."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= most):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end
