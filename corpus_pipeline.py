"""A training corpus from the documents table, in five stages; each reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import bpe_tree, language_id, mixing, ngram_join, suffix_dedup
from siltstone.llm.common import configure, stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    configure(spark)
    return language_id.recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    configure(spark)
    return ngram_join.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words that repeat elsewhere; ``n_chars`` follows the text."""
    configure(spark)
    left = suffix_dedup.without_repeats(docs, params=suffix_dedup.Params(length=suffix_dedup.PASSAGE))
    return left.selectExpr(*["CAST(length(text) AS BIGINT) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of the sources take them."""
    configure(spark)
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' number and digest, and the digest of the text they decode to."""
    configure(spark)
    return bpe_tree.round_trip(docs)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("mixing sources", mixture),
    ("BPE encoding and decoding", tokens),
]

# Language profiles and suffix arrays are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
