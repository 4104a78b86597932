"""A training-corpus pipeline over ``documents``: five stages, each one operator, each on all that the last kept.

Toxic documents go; of each group of near duplicates the smallest doc_id stays; secrets are replaced
by a mark; documents are left out or repeated so that domain token totals meet their targets; what
remains is packed into token sequences. SQL cannot express the stages (compressed lengths, a byte-pair
vocabulary), so tests compare them with plain versions over a small table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from obsguard.llm import jaccard, mixing, packing, secrets, toxicity
from obsguard.llm.common import stored, table

#: Near copies share 80 % of their five-word shingles; op4's own contract is narrower.
NEAR_WIDTH, NEAR_SHARE = 5, 80

#: Weights of the mix, and its tokens against the input's: plain documents are repeated rather than left out.
#: What looks toxic keeps its share: the first stage has decided on it.
MIX: dict[str, float | None] = {"plain": 0.95, "poor": 0.05, "toxic": None}
MIX_TOTAL = 1.1

#: Documents are long rows: a batch between Spark and Python holds so many rows and bytes at most.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(fn: Stage) -> Stage:
    """``fn`` with batches bounded for whole texts."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in BATCHES.items():
            spark.conf.set(name, value)
        return fn(spark, docs, sf_dir)

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_civil(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one_of_each(docs, NEAR_WIDTH, NEAR_SHARE)


@stage
def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


@stage
def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_rates(docs, table(spark, sf_dir, "labels"), MIX, MIX_TOTAL)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scan", replace_secrets),
    ("mixing", mix_to_targets),
    ("packing", pack_sequences),
]
#: Compressed lengths and byte-pair tokens have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
