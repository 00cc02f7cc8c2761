"""The corpus pipeline: quality, near-duplicates, secrets, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
and read again before the next one, so a stage works on what its predecessor
kept and a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalograph.llm import bpe, mixing, quality, secrets, setsketch
from catalograph.llm.queries import table, vocabulary
from catalograph.llm.support import ship, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold."""
    ship(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    ship(spark)
    return setsketch.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text and ``n_chars`` counted again."""
    return secrets.mask(docs, secrets.labelled_findings(spark))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate towards the target mixture says."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns, with the ids of each text and the text that they decode to."""
    ship(spark)
    return bpe.with_ids(docs, vocabulary("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixture", mix_to_targets),
    ("token_ids", encode_tokens),
]

# Trained models decide in four of the stages, which SQL cannot express; tests/llm holds
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
