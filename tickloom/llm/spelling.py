"""Words that differ by one letter, found by composing a vocabulary with a one-edit transducer.

The vocabulary V is an acceptor, the edit a transducer T of two states (no edit yet, one
edit made), and V o T o V accepts the pairs of words one inserted, deleted or replaced
code point apart. The composition is enumerated per initial state: a partition holds the
words that agree outside an interval of places, and all its pairs differ inside of it, at
the first place where they differ. So the state reached by what they agree on is the
initial state of both acceptors, and the minimised acceptor of a partition is that of the
letters inside the interval.

For pairs whose shorter word has m code points the places 0..m where they first differ
are cut into two intervals, so a word lies in four partitions (as the shorter or equal
word and as the longer one). A pair is found in one of them. A partition of more than
``most`` words is cut again into partitions of half its interval, until the interval is
one place: such words differ in the one letter there, so their number is bounded by the
alphabet. No partition's pairs leave it: what leaves is a word's number of near words and
the best of them.

Rows: a null text has no words; a null doc_id is read as the empty string before the
colon, so its runs may lose a letter too; repeated doc_ids and texts count each time. An
empty table gives no words. Other columns are not read. Words may be of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import map_batches, texts_of, written

LEAST_LETTERS, LEAST_COUNT, FORM_TIMES = 7, 2, 10
# Words of a partition that one task holds at a time.
PARTITION_WORDS = 5000
# Keys of larger partitions that are broadcast; more of them are joined by a shuffle.
BROADCAST_KEYS = 100_000
# A count is at least ten times the one it is the form of, and below 2 ** 63.
_DOUBLINGS = 5
# Distinct words whose counts a task keeps before it sends them on.
_COUNTED_AT_ONCE = 200_000

_LONG_RUNS = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}")


def _lowered(text: str) -> str:
    return text.encode().lower().decode()  # of bytes: A-Z only


def thinned(doc_id: int | None, run: str) -> str:
    """The run, without one code point if 31 divides the crc32 of ``<doc_id>:<run>``."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of at least ``LEAST_LETTERS`` letters that occur ``LEAST_COUNT`` times."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                # A shorter run cannot become a word: letters are only deleted.
                for run, n in Counter(_LONG_RUNS.findall(_lowered(text))).items():
                    counts[thinned(doc_id, run)] += n
            if len(counts) > _COUNTED_AT_ONCE:
                yield sent()
        yield sent()

    partial = map_batches(docs.select("doc_id", "text"), step, "word string, n long")
    return partial.filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# --- Partitions ---------------------------------------------------------------------------

_ROWS = ["word", "n", "m", "lo", "hi"]


def _key(word: str, m: str, lo: str, hi: str) -> str:
    """SQL of what the words of a partition agree on: ``lo`` letters, and ``m - hi`` at the end."""
    return f"concat(left({word}, {lo}), ' ', right({word}, greatest({m} - {hi}, 0)))"


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.select(*_ROWS, F.expr(_key("word", "m", "lo", "hi")).alias("key"))


def _first_partitions(words: DataFrame) -> DataFrame:
    """Each word as the shorter or equal (m letters) and as the longer one (m + 1) of a pair."""
    as_either = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m"))
    half = F.expr("(m + 1) DIV 2").cast("int")
    cut = F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), (F.col("m") + 1).alias("hi")))
    return _keyed(as_either.withColumn("_cut", F.explode(cut)).select("word", "n", "m", "_cut.lo", "_cut.hi"))


def _halved(rows: DataFrame) -> DataFrame:
    middle = F.expr("(lo + hi) DIV 2").cast("int")
    cut = F.array(F.struct("lo", middle.alias("hi")), F.struct(middle.alias("lo"), "hi"))
    return _keyed(rows.withColumn("_cut", F.explode(cut)).select("word", "n", "m", "_cut.lo", "_cut.hi"))


def partitions(words: DataFrame, most: int = PARTITION_WORDS) -> DataFrame:
    """Words by partition (m, lo, hi, key); those of more than ``most`` words are cut on."""
    parts, done = ["m", "lo", "hi", "key"], None
    rows = _first_partitions(words)
    while True:
        large = rows.groupBy(*parts).count().filter((F.col("count") > most) & (F.col("hi") - F.col("lo") > 1)).drop("count")
        large = written(large, "spelling-large")
        n_large = large.count()
        if not n_large:
            return rows if done is None else done.unionByName(rows)
        large = F.broadcast(large) if n_large <= BROADCAST_KEYS else large.hint("shuffle_hash")
        small = rows.join(large, parts, "left_anti").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        rows = written(_halved(rows.join(large, parts, "left_semi").select(*rows.columns)), "spelling-halved")


# --- Acceptor, transducer, composition ------------------------------------------------------

class Acceptor:
    """The minimised acceptor of sorted words: states with equal right languages are one.

    Words come in order, so once a word leaves a path, the states below are final: each is
    looked up by what it accepts (``final`` and its arcs), from the last letter backward.
    """

    def __init__(self, words: Iterable[str]):
        self.final: list[bool] = []
        self.arcs: list[dict[str, int]] = []
        self._known: dict[tuple, int] = {}
        path: list[tuple[str, bool, dict[str, int]]] = [("", False, {})]
        before = ""
        for word in words:
            same = 0
            while same < len(before) and same < len(word) and before[same] == word[same]:
                same += 1
            self._close(path, same)
            for letter in word[same:]:
                path.append((letter, False, {}))
            path[-1] = (path[-1][0], True, path[-1][2])
            before = word
        self._close(path, 0)
        self.start = self._state(path[0][1], path[0][2])

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = len(self.arcs)
            self.final.append(final)
            self.arcs.append(arcs)
        return found

    def _close(self, path: list[tuple[str, bool, dict[str, int]]], depth: int) -> None:
        while len(path) > depth + 1:
            letter, final, arcs = path.pop()
            path[-1][2][letter] = self._state(final, arcs)


# The letters read so far: those before and the last one. Words are spelled when accepted.
_Read = tuple["_Read | None", str] | None


def _spelled(read: _Read) -> str:
    letters = []
    while read:
        read, letter = read
        letters.append(letter)
    return "".join(reversed(letters))


def _endings(acceptor: Acceptor, left: int, right: int, not_first: str = "") -> Iterator[str]:
    """What both states accept: the composition after its edit, where both read the same letters."""
    open_: list[tuple[int, int, _Read]] = [(left, right, None)]
    while open_:
        a, b, read = open_.pop()
        if acceptor.final[a] and acceptor.final[b]:
            yield _spelled(read)
        arcs, others = acceptor.arcs[a], acceptor.arcs[b]
        for letter, state in arcs.items():
            if letter in others and (read or letter != not_first):
                open_.append((state, others[letter], (read, letter)))


def near_pairs(words: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Pairs of distinct sorted words one edit apart, each once: V o T o V from its initial state.

    Before the edit both sides are in one state, reached by the letters they agree on. The
    edit replaces a letter by a later one or puts one in, and it does so at the first place
    where the words differ, so an inserted letter is not the one that follows.
    """
    acceptor = Acceptor(words)
    open_: list[tuple[int, _Read]] = [(acceptor.start, None)]
    while open_:
        state, read = open_.pop()
        arcs = list(acceptor.arcs[state].items())
        for k, (letter, target) in enumerate(arcs):
            open_.append((target, (read, letter)))
            for other, target_of_other in arcs[k + 1:]:
                for ending in _endings(acceptor, target, target_of_other):
                    before = _spelled(read)
                    yield before + letter + ending, before + other + ending
            for ending in _endings(acceptor, state, target, letter):
                before = _spelled(read)
                yield before + ending, before + letter + ending


_BEST = "word string, n_near long, form_n long, form string"


def _near_of_group(rows: list[tuple[str, int]], m: int, lo: int, hi: int, tail: int, best: dict[str, list]) -> None:
    """Adds the near words that a partition's words find in each other to ``best``."""
    first = rows[0][0]
    begin, end = first[:lo], first[len(first) - tail:]
    counts = {word[lo:len(word) - tail]: n for word, n in rows}
    for a, b in near_pairs(sorted(counts)):
        # The shorter word has m letters, or both have, and they first differ below hi: if not,
        # the pair is of another partition.
        shorter, longer = (a, b) if len(a) <= len(b) else (b, a)
        if lo + len(shorter) + tail != m or lo + len(shorter) >= hi and longer.startswith(shorter):
            continue
        for own, other in ((a, b), (b, a)):
            word, near, n = begin + own + end, begin + other + end, counts[other]
            entry = best.setdefault(word, [0, 0, ""])
            entry[0] += 1
            if n > entry[1] or n == entry[1] and near < entry[2]:
                entry[1:] = n, near


def _near_in_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    best: dict[str, list] = {}
    key, rows = None, []

    def close() -> None:
        if len(rows) > 1:
            m, lo, hi, _ = key
            _near_of_group(rows, m, lo, hi, max(m - hi, 0), best)

    def sent() -> pa.RecordBatch:
        entries = list(best.values())
        out = pa.RecordBatch.from_arrays([
            pa.array(list(best), pa.string()), pa.array([e[0] for e in entries], pa.int64()),
            pa.array([e[1] for e in entries], pa.int64()), pa.array([e[2] for e in entries], pa.string())],
            names=[c.split(" ")[0] for c in _BEST.split(", ")])
        best.clear()
        return out

    for batch in batches:
        for word, n, *own in zip(*(batch.column(c).to_pylist() for c in (*_ROWS, "key"))):
            if own != key:
                close()
                key, rows = own, []
            rows.append((word, n))
        if len(best) > _COUNTED_AT_ONCE:
            yield sent()
    close()
    yield sent()


def near_words(words: DataFrame, most: int = PARTITION_WORDS) -> DataFrame:
    """Per word that has any: n_near, and of its near words the most frequent, ties to the first in code-point order."""
    # Numbering the rows is what keeps a partition together and in order, whatever the plan becomes.
    parts = ["m", "lo", "hi", "key"]
    together = Window.partitionBy(*parts).orderBy("word")
    rows = partitions(words, most).withColumn("_k", F.row_number().over(together)).select(*_ROWS, "key", "_k")
    found = map_batches(rows, _near_in_task, _BEST)
    # The least of (minus n, word) is the largest n and then the first word.
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("word"))).alias("_best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("_best.less")).alias("best_n"), F.col("_best.word").alias("best"))


# --- Forms and roots ------------------------------------------------------------------------

def variants(words: DataFrame, most: int = PARTITION_WORDS) -> DataFrame:
    """Per word: form, root, n, n_near, form_n.

    A form is at least ``FORM_TIMES`` times as frequent, so a chain of forms has fewer than
    20 members and is followed in five doublings. The near words of one word are bounded by
    its length and the alphabet, so no form has a large part of the words.
    """
    near = near_words(words, most)
    is_form = F.col("best_n") >= F.lit(FORM_TIMES) * F.col("n")
    table = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    steps = table.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(_DOUBLINGS):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        steps = written(steps.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "spelling-roots")
    return table.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, most: int = PARTITION_WORDS) -> DataFrame:
    return variants(written(vocabulary(docs), "spelling-words"), most)
