"""Ids of whole texts from a tokenizers file, with bounded tables of pieces met before.

A piece's place in the table leads to arrays of ids, so a batch looks up its distinct
pieces and gathers all ids at once; a full table keeps the half met last. Words within pieces have two generations: a full one becomes the old one, and what is met
again moves from there to the new one.

A text is cut at spaces and each distinct piece goes through the library once per
worker. Both kinds of vocabulary file start a new word at a space that stands between
two other characters, so the ids of the pieces in order are the ids of the text:
where the vocabulary drops white space, pieces are taken without their space; where
it keeps it, with it, and texts with runs of white space go through as a whole.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tickloom.llm.trie_bpe import byte_letters

MAX_PIECES = 900_000


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its count says."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class PieceCache:
    def __init__(self, path: str, max_pieces: int = MAX_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self.keeps_space = data["pre_tokenizer"]["type"] == "ByteLevel"
        self.added = [x["content"] for x in data["added_tokens"]]
        self.max_pieces = max_pieces
        # The table: the place of each piece and, by place, where its ids start in ``ids``,
        # how many there are, and the turn that met it last.
        self.pieces: dict[str, int] = {}
        self.starts = self.sizes = self.met = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")
        self.turn = 0
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.letters = str.maketrans({chr(b): letter for b, letter in byte_letters().items()})

    def _plain(self, word: str) -> str | None:
        """The word as the model sees it, if it is letters only and stays so; else None."""
        core = word[1:] if word[:1] == " " else word
        if not core.isalpha():
            return None
        if self.keeps_space:
            return word
        if core.isascii():
            return core.lower()
        core = unicodedata.normalize("NFC", core).lower()
        return core if core.isalpha() and "\u03a3" not in word else None  # a last sigma has a lower case of its own

    def _words(self, words: list[str]) -> list[bytes]:
        """Words of letters go straight to the library's model, others through all of it."""
        plain = [self._plain(w) for w in words]
        rest = iter(self._library([w for w, p in zip(words, plain) if p is None]))
        tokenize, letters = self.model.tokenize, self.letters
        return [
            next(rest) if p is None else
            packed([t.id for t in tokenize(p if p.isascii() and " " not in p else p.encode().decode("latin-1").translate(letters))])
            for p in plain]

    def _library(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [packed(x.ids) for x in coded]

    def _cut(self, piece: str) -> list[str]:
        """Texts whose ids, one after another, are those of the piece with its space.

        Letters are a word of their own before a full stop, a comma or a line end, and
        a single line end between two words is one too.
        """
        lead = " " if self.keeps_space else ""
        if "\n" not in piece:  # most pieces
            if piece[-1:] in (".", ",") and self._plain(piece[:-1]) is not None:
                return [lead + piece[:-1], piece[-1]]
            return [lead + piece] if piece else []
        lines = piece.split("\n")
        if self.keeps_space and any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            return [lead + piece]
        out = []
        for n, line in enumerate(lines):
            if n and self.keeps_space:
                out.append("\n")
            if len(line) > 1 and line[-1] in ".," and self._plain(line[:-1]) is not None:
                out += [("" if n else lead) + line[:-1], line[-1]]
            elif line:
                out.append(("" if n else lead) + line)
        return out

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces not met before; each word in them goes through the library once."""
        if len(self.words) > self.max_pieces // 4:
            self.old_words, self.words = self.words, {}
        cut = [self._cut(piece) for piece in pieces]
        unmet = []
        for word in {w for row in cut for w in row}.difference(self.words):
            known = self.old_words.get(word)
            if known is None:
                unmet.append(word)
            else:
                self.words[word] = known
        for at in range(0, len(unmet), 5000):
            some = unmet[at:at + 5000]
            self.words.update(zip(some, self._words(some)))
        words = self.words
        return [words[row[0]] if len(row) == 1 else b"".join([words[w] for w in row]) for row in cut]

    def _places(self, distinct: pa.LargeStringArray) -> np.ndarray:
        """Where each distinct piece lies in the table; -1 if its text must be seen as a whole."""
        names = distinct.to_numpy(zero_copy_only=False)
        known = self.pieces.get
        places = np.array([known(x, -1) for x in names.tolist()], dtype=np.int64)
        unmet = np.flatnonzero(places < 0)
        if len(unmet):
            missing = distinct.take(pa.array(unmet))
            alone = np.ones(len(missing), dtype=bool)
            for token in self.added:
                alone &= ~pc.match_substring(missing, token).to_numpy(zero_copy_only=False)
            if self.keeps_space:  # beside other white space; an empty piece stands for two spaces
                alone &= ~pc.match_substring_regex(missing, r"^(\s|\pZ|[\x0B\x1C-\x1F\x85]|$)").to_numpy(zero_copy_only=False)
            unmet = unmet[alone]
            new, first = names[unmet].tolist(), len(self.pieces)
            coded = self._new(new)
            places[unmet] = first + np.arange(len(new))
            self.pieces.update(zip(new, range(first, first + len(new))))
            sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(coded), dtype="<u4")])
            self.met = np.concatenate([self.met, np.zeros(len(unmet), dtype=np.int64)])
        self.turn += 1
        self.met[places[places >= 0]] = self.turn
        return places

    def _shrink(self) -> None:
        """A full table keeps the half met last."""
        if len(self.pieces) <= self.max_pieces:
            return
        kept = np.sort(np.argsort(-self.met, kind="stable")[:self.max_pieces // 2])
        names = np.array(list(self.pieces), dtype=object)[kept]
        self.pieces = dict(zip(names.tolist(), range(len(names))))
        self.ids = self.ids[spread(self.starts[kept], self.sizes[kept])]
        self.sizes, self.met = self.sizes[kept], self.met[kept]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.

        Only pieces not in the table are seen one by one; the ids of all texts are then
        one gather from it. No added token holds a space, so one that is in a text is in
        one of its pieces.
        """
        if not texts:
            return []
        self._shrink()
        split = pc.split_pattern(pa.array(texts, type=pa.large_string()), " ")
        borders = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        place = self._places(coded.dictionary)[coded.indices.to_numpy()]
        unclear = place < 0
        counts = np.where(unclear, 0, self.sizes[place]) if len(self.sizes) else np.zeros(len(place), dtype=np.int64)
        firsts: list[str] = []
        if self.keeps_space:  # the first piece of a text has no space: the library is asked
            counts[borders[:-1]] = 0
            unclear[borders[:-1]] = False
            firsts = [t.split(" ", 1)[0] for t in texts]
        as_whole = np.logical_or.reduceat(unclear, borders[:-1]).tolist()
        if self.keeps_space:
            as_whole = [w or any(x in p for x in self.added) for w, p in zip(as_whole, firsts)]
        starts = self.starts[place] if len(self.starts) else counts
        flat = self.ids[spread(starts, counts)].tobytes()
        bounds = (4 * np.concatenate([[0], np.cumsum(counts)]))[borders].tolist()
        rest = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
        if self.keeps_space:
            library = self._library([t if w else p for t, p, w in zip(texts, firsts, as_whole)])
            return [x if w else x + r for x, r, w in zip(library, rest, as_whole)]
        library = iter(self._library([t for t, w in zip(texts, as_whole) if w]))
        return [next(library) if w else r for r, w in zip(rest, as_whole)]


_made: dict[str, PieceCache] = {}


def cache(path: str) -> PieceCache:
    """One table for all tasks of a worker."""
    if path not in _made:
        _made[path] = PieceCache(path)
    return _made[path]
