"""A corpus pipeline of five stages, each one operator; every stage's output is written and read again.

language ID (documents without a recognised language go) -> SimHash near-duplicates (one document of
each group stays) -> benchmark decontamination (documents with a benchmark window go) -> mixing of the
sources to target weights -> token-id shards, described from the files.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lanefold.llm import decontaminate, language, mixing, simhash, sstable
from lanefold.llm._common import load, shared_dir, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model recognises; rejected are those without any letter."""
    return language.recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest identifier."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.decontaminated(docs, load(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources: a document is there as often as the mix takes it."""
    return mixing.mixed(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as sorted token shards; a row for each document, read back from the files."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return sstable.read_shards(sstable.write_shards(docs, shared_dir(spark, "token-shards"), path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_shards", token_shards),
]

#: Trained models and seeded draws: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
