"""The registered queries of this package: each operator over its whole table, and SQL where SQL can state it."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, gru, jaccard, licenses, mixing, packing, pages, phrases, quality, rules, suffix, trie, viterbi
from .kit import table

#: The folder of the vocabulary files of public tokenizers; every machine has it.
TOKENIZERS = os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))
MIX_WEIGHTS = {"src0": 8, "src1": 6, "src2": 5, "src3": 4, "src4": 4, "src5": 3, "src6": 3, "src7": 2, "src8": 2, "src9": 1}
MIX_OTHERS, MIX_BLOCK_CHARS = 12, 100_000


def fold(id_col: str, folds: int):
    """CRC-32 of the id as text, modulo `folds`."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicated(table(spark, sf_dir, "documents"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(fold("doc_id", 5) != 0))
    score = F.col(quality.SCORE)
    return quality.score(docs, model, ["doc_id"]).select(
        "doc_id", (F.coalesce(fold("doc_id", 5), F.lit(0)) == 0).alias("held_out"), score.alias("score"), F.when(score >= 0.3, 1).otherwise(0).alias("predicted"))


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru.scored(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs.select("doc_id", "source", F.length("text").alias("n"), F.xxhash64("text").alias("h")), MIX_WEIGHTS, MIX_OTHERS, MIX_BLOCK_CHARS, size="n", ties="h")
    return mixed.select("doc_id", "mix_source", "mix_start", "mix_block", "mix_slot")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.token_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a folder for each source, in it one for each thousand ids."""
    path = F.concat_ws("/", F.lit(""), "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return licenses.inherited(licenses.scanned(files))


def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_ngram_jaccard_join": ngram_jaccard_join,
    "op2_suffix_array_dedup": suffix_array_dedup,
    "op3_best_fit_packing": best_fit_packing,
    "op4_quality_classifier": quality_classifier,
    "op5_lm_scoring": lm_scoring,
    "op6_mixing_sources": mixing_sources,
    "op7_token_counts": token_counts,
    "op8_nearest_neighbours": nearest_neighbours,
    "op9_quality_rules": quality_rules,
    "op10_license_scans": license_scans,
    "op11_phrase_collocations": collocations,
    "op12_conversation_trie": conversation_trie,
    "op13_html_extraction": html_extraction,
}
ORACLES = {
    "op6_mixing_sources": mixing.mixed_sql(MIX_WEIGHTS, MIX_OTHERS, MIX_BLOCK_CHARS),
    "op11_phrase_collocations": phrases.collocations_sql(),
    "op12_conversation_trie": trie.nodes_sql(),
}
