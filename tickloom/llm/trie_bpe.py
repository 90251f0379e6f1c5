"""Byte-pair encoding of distinct words by one walk over a trie of them.

A prefix is described by the last token of its encoding. The encoding of a longer
prefix ends in the one vocabulary token t that is a suffix of it and whose pair
with the last token of what stands before t survives the merges. So each trie node
needs its own last token only, and words that share a prefix share the work.

The texts are cut at spaces before the tokenizer's own pattern is applied: a space
between two other characters always starts a new word there. Pieces of runs of white
space are the exception; a text that has them goes through the pattern as a whole.

Rows: a null text counts as empty and has no ids; rows are kept one for one, repeats
and null document ids included; other columns are left out. An empty table gives an
empty result. Memory: a batch of texts, its trie, and a bounded table of words.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tickloom.llm.common import list_array, map_batches, texts_of

# The byte-level pattern of the vocabulary's family: a fixed value.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_WORDS = 800_000
NEVER = 1 << 40


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, merge ranks and added tokens of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        to_byte = {letter: b for b, letter in byte_letters().items()}
        raw = {token: bytes(to_byte[c] for c in token) for token in data["model"]["vocab"]}
        self.id_of = {raw[token]: i for token, i in data["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.added = {x["content"]: x["id"] for x in data["added_tokens"]}
        self.bytes_of |= {i: content.encode() for content, i in self.added.items()}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.pair: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(data["model"]["merges"]):
            a, b = self.id_of[raw[left]], self.id_of[raw[right]]
            whole = self.id_of[raw[left] + raw[right]]
            self.pair[a, b] = rank
            self.rank.setdefault(whole, rank)
            self.parts.setdefault(whole, (a, b))
        self.longest = max(map(len, self.id_of))
        self.packed = {i: np.array([i], dtype="<u4").tobytes() for i in self.bytes_of}

    def stays_split(self, a: int, b: int) -> bool:
        """Whether the merges, run over the text of a and b, end in exactly these two.

        The merges that built a and b are undone, latest first; a pair that meets at
        the border and ranks before the merge undone last would have been joined.
        Of equal ranks the left one is joined first.
        """
        limit, rank, pair = NEVER, self.rank, self.pair
        while True:
            if pair.get((a, b), NEVER) < limit:
                return False
            of_a, of_b = rank.get(a, -1), rank.get(b, -1)
            if of_a > of_b:
                limit, a = of_a, self.parts[a][1]
            elif of_b >= 0:
                limit, b = of_b + 1, self.parts[b][0]
            else:
                return True


class TrieEncoder:
    """Encodes texts; keeps the words met so far, at most ``max_words`` of them."""

    def __init__(self, vocabulary: Vocabulary, max_words: int = MAX_WORDS):
        self.vocabulary = vocabulary
        self.max_words = max_words
        self.pattern = regex.compile(WORDS)
        self.added = regex.compile("(" + "|".join(map(regex.escape, vocabulary.added)) + ")") if vocabulary.added else None
        self.joins: dict[int, bool] = {}  # of pairs of tokens met: whether they stay two
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def encode_words(self, words: set[str]) -> None:
        """Insert the words into a trie and walk it depth first.

        Of the tokens that are suffixes of a prefix exactly one fits, so the order of
        trial is free: first the parent's last token made longer, then short tokens.
        """
        end, root = 256, {}
        for word in words:
            node = root
            for byte in word.encode():
                child = node.get(byte)
                if child is None:
                    child = node[byte] = {}
                node = child
            node[end] = word
        id_of, packed, joins = self.vocabulary.id_of.get, self.vocabulary.packed.__getitem__, self.joins
        longest, split = self.vocabulary.longest, self.vocabulary.stays_split
        # Per depth of the path the last token of the prefix and where it starts: the ids of
        # a prefix are read back from there, so a long word takes no more than its letters.
        last: list[int] = [-1]
        back: list[int] = [0]
        path = bytearray()
        stack = [(0, byte, child) for byte, child in root.items()]
        while stack:
            depth, byte, node = stack.pop()
            if depth + 1 < len(last):
                del last[depth + 1:], back[depth + 1:], path[depth:]
            path.append(byte)
            first = back[depth]
            for start in (first, *range(depth, max(-1, depth - longest), -1)):
                token = id_of(bytes(path[start:]))
                if token is None:
                    continue
                if start:
                    pair = last[start] << 20 | token
                    fits = joins.get(pair)
                    if fits is None:
                        fits = joins[pair] = split(last[start], token)
                    if not fits:
                        continue
                last.append(token)
                back.append(start)
                break
            for key, child in node.items():
                if key == end:
                    ids, at = [], depth + 1
                    while at:
                        ids.append(last[at])
                        at = back[at]
                    self.words[child] = b"".join(map(packed, reversed(ids)))
                else:
                    stack.append((depth + 1, key, child))

    def _ensure(self, lists: list[list[str]]) -> None:
        new = {w for words in lists for w in words if w not in self.words}
        if new:
            if len(self.joins) > self.max_words:
                self.joins.clear()
            if len(self.words) + len(new) > self.max_words:
                self.words.clear()
                new = {w for words in lists for w in words}
            self.encode_words(new)

    def _whole(self, text: str) -> bytes:
        """By the pattern over the whole text, added tokens cut out first."""
        out = []
        for part in self.added.split(text) if self.added else [text]:
            if part in self.vocabulary.added:
                out.append(self.vocabulary.packed[self.vocabulary.added[part]])
            elif part:
                words = self.pattern.findall(part)
                self._ensure([words])
                out.extend(map(self.words.__getitem__, words))
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.pieces) > self.max_words:
            self.pieces.clear()
        added, pieces = list(self.vocabulary.added), self.pieces
        cut = [text.split(" ") for text in texts]
        # A piece after a space has that space; the first piece of a text has none.
        met = {piece for row in cut for piece in row[1:] if piece not in pieces}
        # A piece of letters is one word: the pattern need not be asked.
        new = {
            piece: [" " + piece] if piece.isalpha() else self.pattern.findall(" " + piece)
            for piece in met if piece and not piece[0].isspace()
        }
        self._ensure(list(new.values()))
        for piece, words in new.items():
            pieces[piece] = b"".join(map(self.words.__getitem__, words))
        out = []
        for text, row in zip(texts, cut):
            if any(x in text for x in added):
                out.append(self._whole(text))
                continue
            found = list(map(pieces.get, row[1:]))
            out.append(self._whole(text) if None in found else self._whole(row[0]) + b"".join(found))
        return out


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        size = max(vocabulary.bytes_of) + 1
        self.table = [vocabulary.bytes_of.get(i, b"") for i in range(size)]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


_made: dict[str, tuple[TrieEncoder, Decoder]] = {}


def _tools(path: str) -> tuple[TrieEncoder, Decoder]:
    """One encoder for all tasks of a worker, so that words met once stay known."""
    if path not in _made:
        vocabulary = Vocabulary(path)
        _made[path] = TrieEncoder(vocabulary), Decoder(vocabulary)
    return _made[path]


def encode_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids (array of int) and the text decoded from these ids, per row.

    Map-only: nothing is shuffled, and a document of any length is one row.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(tokenizer_path)
        for batch in batches:
            coded = encoder.encode(texts_of(batch))
            flat = np.frombuffer(b"".join(coded), dtype="<i4")
            ids = list_array(flat, np.array([len(x) // 4 for x in coded], dtype=np.int64), pa.int32())
            decoded = pa.array([decoder.decode(x) for x in coded], type=pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, decoded], ["doc_id", "ids", "decoded"])

    return map_batches(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), "text"), step, "doc_id bigint, ids array<int>, decoded string")
