"""The corpus pipeline: what of the documents goes into training, and how it is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from routeloom.llm import language, ngram_join, packing, pii, toxicity
from routeloom.llm.common import stored, table
from routeloom.llm.queries import pii_key


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus' languages."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return language.accepted(docs, language.learn(docs, path), path, times=language.FOREIGN)


def ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return toxicity.accepted(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard 0.8 or more."""
    return ngram_join.keep_first(docs, width=5, percent=80)


def pseudonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced."""
    return pii.pseudonymized(docs, pii_key(spark))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens as pieces of training sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language_id),
    ("toxicity", ordinary),
    ("n-gram Jaccard join", distinct),
    ("PII", pseudonymous),
    ("packing", sequences),
]

# Trained models and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
