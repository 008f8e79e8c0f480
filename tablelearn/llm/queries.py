"""Registered queries of the subpackage: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tablelearn.sources.tables import read_table

from . import (brown, decontaminate, htmltree, linededup, mixing, packing, pii, quality, repair, simjoin,
               toxicity, trie, warc)
from .common import crc_mod, spill

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii_semi_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(read_table(spark, sf_dir, "documents")))


def op2_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model, vocab = brown.train(docs)
    return brown.score(docs, model, vocab)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"))


def op5_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages")).drop("html", "url")


def op6_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    text = docs["text"]
    keys = spill(docs.select("doc_id", "source", "lang", mixing.topic(text).alias("topic"),
                             mixing.n_tokens(text).alias("tokens")), "mixing-keys")
    m = mixing.mix(keys, topic_col="topic", tokens_col="tokens")
    return m.select("doc_id", "source", "lang", "mix.topic", "mix.tokens",
                    F.round("mix.weight", 6).alias("weight"),
                    F.round("mix.probability", 6).alias("probability"), "mix.sampled")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.drop_boilerplate(docs, count_col="n_dropped")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simjoin.join_components(read_table(spark, sf_dir, "documents"))


def op9_html_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltree.extract(read_table(spark, sf_dir, "pages"))


def op10_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(read_table(spark, sf_dir, "documents"))
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.place(spill(digest, "packing-pieces"))


def op12_conversation_repair_of(conversations: DataFrame) -> DataFrame:
    found = repair.digest(repair.repair(repair.damage(conversations)))
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    none = {c: F.lit(0).cast("bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    none |= {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return every.join(found, F.col("id").eqNullSafe(found["conv_id"]), "left").select(
        F.col("id").alias("conv_id"), *[F.coalesce(F.col(c), v).alias(c) for c, v in none.items()])


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_conversation_repair_of(read_table(spark, sf_dir, "conversations"))


def op13_conversation_trie_of(conversations: DataFrame) -> DataFrame:
    """The first crc32(c) % 6 turns of conversation c come from conversation c - c % 100."""
    c = F.col("conv_id")
    seqs = spill(trie.turns(conversations), "trie-turns")
    return trie.trie(trie.share_heads(seqs, c - c % 100, crc_mod(c, 6), 5))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_conversation_trie_of(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_pii_semi_markov": op1_pii_semi_markov,
    "op2_brown_lm": op2_brown_lm,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_warc_normaliser": op5_warc_normaliser,
    "op6_mixing_weights": op6_mixing_weights,
    "op7_line_dedup": op7_line_dedup,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_html_style_tree": op9_html_style_tree,
    "op10_toxicity_fm": op10_toxicity_fm,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_conversation_trie": op13_conversation_trie,
}
ORACLES: dict[str, str | None] = {
    "pipeline": corpus_pipeline.ORACLE_SQL,
    "op4_quality_rules": quality.SQL,
    "op6_mixing_weights": mixing.SQL,
    "op7_line_dedup": linededup.SQL,
}
