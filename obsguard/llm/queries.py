"""One query for each training-data operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from obsguard.llm import (
    bestfit, jaccard, languages, merkle, mixing, packing, quality, secrets, suffixes, toxicity, variants, vectors,
)
from obsguard.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(documents, toxicity.fit_toxicity(documents, table(spark, sf_dir, "labels")))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.exact_top_k(table(spark, sf_dir, "embeddings"))


@query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest_neighbours(table(spark, sf_dir, "embeddings"))


ORACLES["op6_exact_top_k"] = vectors.EXACT_SQL


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_proofs(table(spark, sf_dir, "documents")).drop("siblings")


ORACLES["op11_merkle_manifest"] = merkle.MANIFEST_SQL


@query
def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack_best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


ORACLES["op13_spelling_variants"] = variants.VARIANTS_SQL
