"""A corpus through the stages of a training-data pipeline.

Each stage but the last returns the columns of ``documents``; a stage that changes a
text sets its n_chars. Rows that a stage keeps are all the next one sees.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import packing, phrase_automata, pii, rule_ensemble, shingle_join
from tickloom.llm.common import bounded_batches, read, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is trained on what it is given."""
    return rule_ensemble.keep_good(docs, read(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays: that of the smallest id."""
    return shingle_join.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words and more that recur are taken out everywhere."""
    return phrase_automata.remove_repeats(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become their kind in brackets."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]
# The classifier and the tokenizer cannot be said in SQL; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage reads what its predecessor has written to the shared folder."""
    bounded_batches(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
