"""Mixing, runs of words and spelling variants against brute force."""

import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tickloom.llm import mixing, queries, spelling, word_runs

SF = "/root/testdata/sf0.001"
# Extra columns, some with names the operators use themselves.
DOCS = "doc_id long, text string, source string, at long, word string, _range int, block long, n int"


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 5, "w", 1, 2, 3) for r in rows], DOCS).repartition(parts)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- Runs of words ------------------------------------------------------------------------

def nested(depth):
    if not depth:
        return random.choices([b"a", b"b", b"c"][:random.randint(1, 3)], k=random.randint(1, 6))
    return [w for _ in range(random.randint(1, 3)) for w in nested(depth - 1) * random.randint(1, 9)]


def test_runs_equal_brute_force():
    random.seed(1)
    found = 0
    for _ in range(300):
        words = nested(random.randint(1, 3))[:300]
        runs = [tuple(r) for r in word_runs.runs_of(words)]
        assert runs == brute.word_runs(words)
        found += len(runs)
    assert found > 500


def test_runs_of_long_texts():
    started = time.time()
    assert word_runs.runs_of([b"x"] * 1_000_000) == [(0, 1_000_000, 1)]
    nested_runs = word_runs.runs_of(([b"a"] * 1000 + [b"b"]) * 1000)
    assert len(nested_runs) == 1001 and nested_runs[1] == (0, 1_001_000, 1001)
    assert time.time() - started < 60


def test_longest_run_ties():
    runs = [word_runs.Run(0, 24, 8), word_runs.Run(5, 48, 16), word_runs.Run(9, 30, 9)]
    assert word_runs.longest(runs) == (9, 30, 9) and word_runs.longest(runs[:2]) == (0, 24, 8) and word_runs.longest([]) is None


def test_runs_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert tuples(queries.op13_diagonal_runs(spark, SF)) == sorted((brute.collapsed(*r) for r in rows), key=repr)


def test_runs_of_odd_rows(spark):
    planted = next(i for i in range(1000) if not word_runs.zlib.crc32(str(i).encode()) % 10)
    rows = [(planted, None, "s"), (planted, "", None), (7, " \t\n ", "s"), (planted, "a b c d e f g h " * 9, "s"), (7, "x " * 30, "s"), (7, "x " * 30, "s")]
    got = tuples(word_runs.collapse(docs(spark, rows), planted=True, digests=True))
    assert got == sorted((brute.collapsed(i, t) for i, t, _ in rows), key=repr)
    null_id = word_runs.collapse(docs(spark, [(None, "x " * 30, "s")]), planted=True).collect()[0]
    assert null_id.doc_id is None and null_id.runs_text == "0,30,1\n" and null_id.collapsed == "x"
    assert word_runs.collapse(docs(spark, rows).limit(0)).count() == 0


# --- Spelling variants ----------------------------------------------------------------------

def test_composition_equals_brute_force():
    random.seed(2)
    for _ in range(1000):
        words = sorted({"".join(random.choices("abc"[:random.randint(1, 3)], k=random.randint(0, 7))) for _ in range(random.randint(1, 25))})
        got = sorted(tuple(sorted(p)) for p in spelling.near_pairs(words))
        assert got == [(a, b) for k, a in enumerate(words) for b in words[k + 1:] if brute.one_edit(a, b)]


def test_acceptor_is_minimal():
    acceptor = spelling.Acceptor(sorted(a + b + "ing" for a in "abc" for b in "xyz"))
    assert len(acceptor.arcs) == 6


@pytest.mark.parametrize("most", [2, 5000])
def test_variants_equal_brute_force(spark, most):
    random.seed(3)
    stems = ["abcdefg", "abcdefgh", "bbbbbbbb", "straßeñez", "ab" * 20]
    texts = []
    for i in range(60):
        words = []
        for _ in range(60):
            w = random.choice(stems)
            k = random.randrange(len(w))
            words.append(random.choice([w] * 12 + [w.upper(), w[:k] + w[k + 1:], w[:k] + random.choice("abß") + w[k:], w[:k] + "z" + w[k + 1:]]))
        texts.append((i, " ".join(words), "s"))
    texts += [(3, None, "s"), (4, "", "s"), (5, "z" * 3000 + " " + "z" * 3001 + " " + "z" * 3000 + "," + "z" * 3001, "s"), (5, texts[5][1], "s")]
    texts.append((8, "lanternly " * 300 + "lanternlyx " * 25 + "lanternlyxy " * 2, "s"))  # a chain of forms
    want = brute.spelling_variants([(i, t) for i, t, _ in texts])
    got = spelling.spelling_variants(docs(spark, texts), most).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == want
    assert any(w[1] for w in want) and any(w[2] not in (w[0], w[1]) for w in want) and max(w[4] for w in want) > 10


def test_variants_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op12_edit_composition(spark, SF).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == brute.spelling_variants(rows)


def test_variants_of_odd_tables(spark):
    empty = docs(spark, [(1, "abcdefg abcdefg", "s")]).limit(0)
    assert spelling.spelling_variants(empty).count() == 0
    assert spelling.spelling_variants(docs(spark, [(None, "short words only", None)])).count() == 0


# --- Mixing ---------------------------------------------------------------------------------

def mix_rows():
    random.seed(4)
    sources = ["a"] * 20 + ["b", None, "ß", "z", "Z", "c"]
    rows = [(i, " w\x0b" * random.randint(0, 900) if i % 7 else None, random.choice(sources)) for i in range(600)]
    return rows + [(1, "same words here", "b")] * 3 + [(None, "no id", "b"), (9, "", "only-empty"), (10, "x " * 100_000, "long")]


def by_source(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(brute.words(text))
    return dict(sorted(sizes.items(), key=lambda e: (e[0] is None, (e[0] or "").encode())))


def test_mix_meets_targets(spark):
    rows = mix_rows()
    sizes = by_source(rows)
    targets = brute.mix_targets(sizes)
    source_of = {(i, t): s for i, t, s in rows}
    got = mixing.takes(docs(spark, rows)).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(brute.words(t))) for i, t, _ in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    taken = Counter()
    for r in got:
        taken[(r.source_size, round(r.target, 6))] += r.taken
    assert taken == Counter({(sizes[s], round(float(t), 6)): round(float(t)) for s, t in targets.items()})
    assert any(float(t) == 3 * sizes[s] > 0 for s, t in targets.items()) and len(source_of) > 500


def test_mix_is_whole_and_repeatable(spark):
    sizes = mixing.sized(docs(spark, mix_rows()))
    sources = mixing.targets(sizes)
    first = mixing.mixed(sizes, sources, block_words=64, shard_slots=32)
    second = mixing.mixed(mixing.sized(docs(spark, mix_rows(), 7)), sources, block_words=64, shard_slots=32)
    rows = first.collect()
    columns = ["shard", "place", "source_name", "block", "start", "length"]
    assert sorted(map(tuple, first.select(columns).collect())) == sorted(map(tuple, second.select(columns).collect()))
    slots = {}
    for r in rows:
        slots.setdefault((r["shard"], r["place"]), []).append(r)
    assert all(len({(r["no_source"], r["source_name"], r["block"]) for r in s}) == 1 and sum(r["length"] for r in s) <= 64 for s in slots.values())
    assert all(0 <= r["start"] for r in rows)
    per_shard = Counter(shard for shard, _ in slots)
    assert max(per_shard.values()) <= 32 and len(per_shard) > 20
    assert all({p for s, p in slots if s == shard} == set(range(n)) for shard, n in per_shard.items())


def test_permutations():
    for size in (1, 2, 3, 17, 64, 1000):
        for key in (1, 99):
            n = np.full(size, size)
            assert sorted(mixing.permuted(np.arange(size), n, np.full(size, key))) == list(range(size))
    orders = {tuple(mixing.permuted(np.arange(20), np.full(20, 20), np.full(20, k))) for k in range(10)}
    assert len(orders) == 10


def test_shard_counts_add_up():
    rng = np.random.default_rng(5)
    quotas = np.array([1000, 1, 300, 0])
    counts = mixing.draw_counts(quotas, 16, rng)
    assert (counts.sum(axis=0) == quotas).all() and set(counts.sum(axis=1)) <= {81, 82} and len(set(counts[:, 0])) > 1


def test_mix_query(spark):
    got = queries.op11_block_mixing(spark, SF)
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    targets, sizes = brute.mix_targets(by_source(rows)), by_source(rows)
    source_of = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got.collect():
        assert (r["size"], r.source_size) == (len(brute.words(next(t for i, t, _ in rows if i == r.doc_id))), sizes[source_of[r.doc_id]])
        assert r.target == pytest.approx(float(targets[source_of[r.doc_id]]), rel=1e-12)
        taken[source_of[r.doc_id]] += r.taken
    assert all(taken[s] == round(float(t)) for s, t in targets.items())


def test_mix_of_odd_tables(spark):
    assert mixing.takes(docs(spark, mix_rows()).limit(0)).count() == 0
    empty = mixing.takes(docs(spark, [(1, None, "a"), (1, "", None)])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in empty] == [(0, 0, 0.0, 0)] * 2
