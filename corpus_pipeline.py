"""Corpus pipeline over ``documents``: line-first quality rules, site-relative line dedup,
n-gram Jaccard join (one document of each near-duplicate group stays), benchmark
decontamination and mixing to target weights.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
``documents``; the last adds the mixing columns. Each one's result is written as Parquet
and read again as the next one's documents.

Defined results are those of the operators: null texts count as empty and are rejected by
the first stage, null ids are never duplicates and never leaks, repeated rows stay or go
together (of rows that share an id the join drops only those whose text has an earlier match),
of a group of near duplicates the smallest id stays, very long texts go through whole, an empty
table gives an empty result, and extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.llm import decontaminate, linededup, mixing, quality, simjoin
from tablelearn.llm.common import spill
from tablelearn.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.drop_boilerplate(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word n-grams, similarity 0.8; of each group the smallest id stays."""
    return simjoin.keep_one(docs, n=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaked(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents with topic, tokens, weight and probability."""
    mixed = mixing.mix(docs, out_col="__mix").where("__mix.sampled")
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns], *[
        F.col(f"__mix.{c}").alias(f"mix_{c}") for c in ("topic", "tokens", "weight", "probability")])


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_weights", mixing_weights),
]

#: Alignment and similarity classes are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
