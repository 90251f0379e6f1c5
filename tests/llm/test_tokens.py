"""Token ids, files of frames, packing: against the library and exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.brute import sha
from tickloom.llm import packing, queries, token_frames, trie_bpe
from tickloom.llm.token_cache import PieceCache

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = [*"abcthe  \n\t'sllé漢字🙂1234.,!?  \x1c\x85", "<|endoftext|>", " the", "ing", "'ll", "'S", "\r\n", "  ", "á", "é", "Σ", "İ,", " ́"]
DOCS = "doc_id long, text string, ids string, n_tokens string"


@pytest.fixture(scope="module")
def texts():
    random.seed(7)
    made = ["".join(random.choices(PARTS, k=random.randint(0, 60))) for _ in range(1500)]
    return made + ["", "a" * 3000, " " * 500, " \n " * 40, "the cat, the dog.\nThe End." * 30]


def library(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("most", [1000000, 50])
def test_piece_cache_equals_library(texts, path, most):
    cache = PieceCache(path, most)
    coded = [x for k in range(0, len(texts), 100) for x in cache.encode(texts[k:k + 100])]
    assert [np.frombuffer(x, "<u4").tolist() for x in coded] == library(path, texts)


@pytest.mark.parametrize("most", [1000000, 50])
def test_trie_encoder_equals_library_and_decodes(texts, most):
    vocabulary = trie_bpe.Vocabulary(BYTE)
    encoder, decoder = trie_bpe.TrieEncoder(vocabulary, most), trie_bpe.Decoder(vocabulary)
    coded = [x for k in range(0, len(texts), 100) for x in encoder.encode(texts[k:k + 100])]
    assert [np.frombuffer(x, "<u4").tolist() for x in coded] == library(BYTE, texts)
    assert [decoder.decode(x) for x in coded] == texts


def test_shared_prefixes_are_computed_once():
    encoder = trie_bpe.TrieEncoder(trie_bpe.Vocabulary(BYTE))
    encoder.encode([" unbelievable unbelievably unbelieving"])
    assert {" unbelievable", " unbelievably", " unbelieving"} <= set(encoder.words)


def rows_of(spark):
    rows = [(3, "the cat", "x", "y"), (1, None, None, None), (2, "", "", ""), (None, "lost", "", ""), (3, "the cat", "x", "y"), (9, "b " * 9000, "", "")]
    return spark.createDataFrame(rows, DOCS)


def test_trie_rows(spark):
    out = trie_bpe.encode_decode(rows_of(spark), BYTE).collect()
    assert sorted((r.doc_id or 0, len(r.ids), r.decoded[:7]) for r in out) == [
        (0, len(library(BYTE, ["lost"])[0]), "lost"), (1, 0, ""), (2, 0, ""), (3, 2, "the cat"), (3, 2, "the cat"), (9, len(library(BYTE, ["b " * 9000])[0]), "b b b b")]
    assert trie_bpe.encode_decode(rows_of(spark).filter("doc_id = 77"), BYTE).count() == 0


def test_trie_query(spark):
    found = {r.doc_id: r for r in queries.op9_trie_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for d, ids in zip(docs, library(BYTE, [d.text for d in docs])):
        r = found[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(d.text))


def test_frames_are_read_alone_and_checked(tmp_path):
    path = str(tmp_path / "ids.zst")
    writer = token_frames.FrameWriter(path)
    frames = {5: b"\1\0\0\0" * 900, None: b"", 7: b"\2\0\0\0"}
    for doc_id, ids in frames.items():
        writer.append(doc_id, ids)
    writer.close()
    reader = token_frames.FrameReader(path)
    assert reader.find({7, 5, 0}) == [0, 2] and reader.ids(2) == frames[7] and reader.ids(0) == frames[5] and reader.doc_id(1) is None
    raw = bytearray(open(path, "rb").read())
    start = int(reader.offsets[2])
    import zstandard
    assert zstandard.ZstdDecompressor().decompress(bytes(raw[start:int(reader.offsets[3])])) == frames[7]
    reader.entries = reader.entries.copy()
    reader.entries["crc"][2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        reader.ids(2)
    raw[-1] ^= 1
    (tmp_path / "bad.zst").write_bytes(raw)
    with pytest.raises(ValueError, match="seek table"):
        token_frames.FrameReader(str(tmp_path / "bad.zst"))


def test_frame_files(spark):
    manifest = token_frames.write_frames(rows_of(spark), WORD)
    found = sorted(token_frames.read_frames(spark, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 2, 3, 3, 9]
    for r, ids in zip(found, library(WORD, ["lost", "", "", "the cat", "the cat", "b " * 9000])):
        assert np.frombuffer(r.ids, "<u4").tolist() == ids + [1]
    assert [r.start for r in found] == np.cumsum([0, *[len(r.ids) // 4 for r in found[:-1]]]).tolist()
    assert [r.doc_id for r in token_frames.read_frames(spark, manifest, {9, 1}).orderBy("doc_id").collect()] == [1, 9]
    empty = token_frames.write_frames(rows_of(spark).filter("doc_id = 77"), WORD)
    assert token_frames.read_frames(spark, empty).count() == 0


def test_frame_query(spark):
    found = queries.op3_token_frames(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for r, ids in zip(found, library(WORD, [d.text for d in docs]), strict=True):
        raw = np.array(ids + [1], "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids) + 1, zlib.crc32(raw))
        start += len(ids) + 1


def test_histogram_is_packed_longest_first():
    slots = packing.pack_histogram({2048: 2, 1500: 3, 500: 4, 48: 5, 1: 1})
    taken = {}
    for s in slots:
        taken[s.length] = taken.get(s.length, []) + [s]
    assert packing.pack_histogram({}) == []
    assert {s.sequence for s in taken[2048]}.isdisjoint({s.sequence for s in taken[500]})
    # 500 and 48 fill 1500 up, and no more than five packs and one for the rest are used.
    assert max(s.sequence for s in slots) <= 5


def check_packing(rows, texts):
    """Every id once, sequences gapless from 0, nothing beyond the capacity."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for (doc_id, _), ids in zip(texts, library(BYTE, [t or "" for _, t in texts])):
        ids, at = ids + [1], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            part = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return sequences


def test_packing_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 5000), (4, "the cat"), *[(k, "the cat sat " * (k % 90)) for k in range(10, 200)]]
    check_packing(packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), BYTE).collect(), rows)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), BYTE).count() == 0
    repeated = packing.pack(spark.createDataFrame([(None, "a"), (5, "a"), (5, "a")], "doc_id long, text string"), BYTE).collect()
    assert len(repeated) == 3 and len({(r.sequence_id, r.offset) for r in repeated}) == 3


def test_packing_query_pads_little(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    sequences = check_packing(queries.op4_histogram_packing(spark, "/root/testdata/sf0.001").collect(), docs)
    used = sum(n for parts in sequences.values() for _, n in parts)
    assert used / (2048 * len(sequences)) > 0.98


def test_trie_takes_words_of_any_length():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = trie_bpe.TrieEncoder(trie_bpe.Vocabulary(path)), Tokenizer.from_file(path)
    random.seed(9)
    texts = ["".join(random.choices("abcdefgh", k=30_000)), "a" * 50_000, "ab" * 20_000 + " " + "ab" * 20_001]
    assert encoder.encode(texts) == [np.array(x.ids, dtype="<u4").tobytes() for x in library.encode_batch_fast(texts, add_special_tokens=False)]
    # What is kept per letter does not grow with the word: a million of them take seconds.
    long_run = "".join(random.choices("abcdefgh", k=1_000_000))
    (ids,) = encoder.encode([long_run])
    assert trie_bpe.Decoder(trie_bpe.Vocabulary(path)).decode(ids) == long_run
