"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_text, language, near_vectors, ngram_join, packing, partial_match, pii
from . import piece_merges, ranked_search, token_counts, topk, toxicity, whitening
from .common import table

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


@query
def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


@query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with surrogates, and how many entities each had."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymized(docs, pii_key(spark))


def pii_key(spark: SparkSession) -> str:
    """The secret of the surrogates; a deployment sets its own."""
    return spark.conf.get("routeloom.pii.key", "set routeloom.pii.key to a secret")


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path)


@query
def op8_piece_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return piece_merges.piece_digests(table(spark, sf_dir, "documents"), path)


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs, path), path)


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(table(spark, sf_dir, "documents"), path)


@query
def op11_partial_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partial_match.scores(table(spark, sf_dir, "documents"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond 64 bits, possible from some million vectors on, is null here."""
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"), most=32)
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
