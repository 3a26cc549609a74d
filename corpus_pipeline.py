"""A corpus pipeline of five of the operators: toxic documents go, then exact and near copies, then sources are mixed
to their target weights, and the mix is packed into sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fernglass.llm import exact_dedup, minhash, mixing, packing, toxicity
from fernglass.llm.shared import stash

#: Percent of their word shingles that near copies share at least; the 85 of minhash.PERCENT is op2_minhash's own.
SHARED = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on these documents and the labels, does not reject."""
    return toxicity.reject(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal without white space, the longest, then that of the smallest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the document of the smallest id."""
    return minhash.drop_near_copies(docs, SHARED)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each use that the mix makes of a document, in training order."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, their places in sequences of 2,048 tokens, and the place of each sequence in training.

    The mix is stored in training order; its rows' places in the files say which sequence comes first.
    """
    return packing.pack_in_order(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL can't express the first stage; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
