"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import (
    html_extract, metric_tree, mixing, multi_index, packing, phrase_automata, pii, rule_ensemble, shingle_join, spelling, token_frames,
    trie_bpe, word_runs,
)
from tickloom.llm.common import read

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def op1_block_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extract.extract(read(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(read(spark, sf_dir, "embeddings"))


def op3_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_frames.write_frames(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return token_frames.read_frames(spark, manifest).select(
        "doc_id", "start", F.floor(F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op4_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op5_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(read(spark, sf_dir, "documents"), pii.train(spark))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), *[count(kind) for kind in pii.BASE],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op6_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_tree.search(read(spark, sf_dir, "embeddings"))


def op7_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = rule_ensemble.score(docs, rule_ensemble.train(docs, labels))
    return scored.select(
        F.col("doc.doc_id").alias("doc_id"), rule_ensemble.held_out(F.col("doc.doc_id")).alias("held_out"), "score", "predicted")


def op8_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = phrase_automata.normal_words(F.col("text"))
    columns = [
        F.col("doc_id"), F.size(words).cast("bigint").alias("n_words"), F.sha2(F.array_join(words, " "), 256).alias("whole_sha256")]
    found = phrase_automata.with_kept(read(spark, sf_dir, "documents"), columns)
    return found.select("doc_id", "n_words", "n_removed", F.coalesce(F.sha2("kept", 256), "whole_sha256").alias("kept_sha256"))


def op9_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = trie_bpe.encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op10_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.groups(read(spark, sf_dir, "documents"))


def op11_block_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.takes(read(spark, sf_dir, "documents"))


def op12_edit_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def op13_diagonal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.collapse(read(spark, sf_dir, "documents"), planted=True, digests=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_block_tree": op1_block_tree,
    "op2_multi_index": op2_multi_index,
    "op3_token_frames": op3_token_frames,
    "op4_histogram_packing": op4_histogram_packing,
    "op5_boosted_pii": op5_boosted_pii,
    "op6_metric_tree": op6_metric_tree,
    "op7_rule_ensemble": op7_rule_ensemble,
    "op8_phrase_automata": op8_phrase_automata,
    "op9_trie_bpe": op9_trie_bpe,
    "op10_partenum": op10_partenum,
    "op11_block_mixing": op11_block_mixing,
    "op12_edit_composition": op12_edit_composition,
    "op13_diagonal_runs": op13_diagonal_runs,
}
# The others have none: SQL has no such tokenizers, trees or index, or takes too long.
ORACLES: dict[str, str] = {
    "op6_metric_tree": """WITH rows_ AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS z FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.z, c.z), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM rows_ AS q, rows_ AS c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10""",
    "op8_phrase_automata": r"""WITH texts AS (
  SELECT row_number() OVER () AS n, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (
  SELECT n, k, md5(array_to_string(w[k:k + 34], ' ')) AS window_ FROM (
    SELECT n, w, unnest(range(1, len(w) - 33)) AS k FROM texts WHERE len(w) >= 35)),
recurring AS (SELECT window_ FROM windows GROUP BY window_ HAVING count(*) > 1),
gone AS (SELECT DISTINCT n, unnest(range(k, k + 35)) AS k FROM windows JOIN recurring USING (window_)),
kept AS (
  SELECT n, string_agg(word, ' ' ORDER BY k) AS kept, count(*) AS n_kept FROM (
    SELECT n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM texts) ANTI JOIN gone USING (n, k) GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (n)""",
    "op10_partenum": r"""WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[k:k + 4], ' ')) AS shingle FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM texts WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM sets AS a JOIN sets AS b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
  WHERE 100 * both_ >= 80 * (x.n + y.n - both_)),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(a, b) AS (SELECT a, b FROM either UNION SELECT r.a, e.b FROM reached AS r JOIN either AS e ON r.b = e.a),
least_ AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN least_ ON a = doc_id""",
}
