"""A training-data pipeline over ``documents``: its stages, applied one after the other.

Toxic documents go, one document of each near-duplicate group stays, strings
that repeat are cut out, sources are mixed to target weights, and what is left
is encoded. Each stage takes (spark, docs, sf_dir) and works on all that the one
before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from notemill.llm import bpe, mixing, simhash, suffix, toxicity
from notemill.session import drop_scratch, saved_alone


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't predict to be toxic; learned from labels as in its own query."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean_documents(docs, toxicity.fit(docs, labels, ~toxicity.held_out()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of linked fingerprints."""
    return simhash.one_per_group(docs, words=4, distance=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings of 100 bytes that start earlier in the corpus."""
    return suffix.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: up to twice, or not at all."""
    return mixing.taken_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and the decoded text of each document."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("mix", mix_sources),
    ("bpe", encode),
]

#: The stages learn from labels and encode with a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each returns is written as Parquet and read again.

    Once a stage's rows are written, its input and the copies it made go.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs, path = saved_alone(spark, lambda docs=docs, stage=stage: stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            drop_scratch(spark, before)
        before = path
    return docs
