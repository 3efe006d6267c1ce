"""A corpus pipeline of five stages over ``documents``; each reads what the last one wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import decontamination, jaccard_join, language_id, mixing, token_files
from tidepool.llm.queries import tokenizer_path
from tidepool.llm.tables import table
from tidepool.sources.scratch import application_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; the others have no letters, or fit two languages alike."""
    return language_id.keep_identified(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    return jaccard_join.keep_first(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards smoothed shares of sources, languages and topics."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's token ids are in the written files, read back from them."""
    path = f"{application_dir(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(docs, path, tokenizer_path())
    return token_files.read_tokens(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("mixture", mixture),
    ("tokens", tokens),
]

# Language models, hashed shingles, sampling and token files are beyond SQL; the stages are
# compared with brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{application_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
