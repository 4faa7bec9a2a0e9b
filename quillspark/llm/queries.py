"""The registered queries of the corpus operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import bpe
from quillspark.llm import oracles
from quillspark.llm.common import table
from quillspark.llm import toxicity
from quillspark.llm import decontam
from quillspark.llm import hard_negatives
from quillspark.llm import line_dedup
from quillspark.llm import packing
from quillspark.llm import quality
from quillspark.llm import substring_dedup
from quillspark.llm import tandem
from quillspark.llm import secrets_scan
from quillspark.llm import pii
from quillspark.llm import token_counts
from quillspark.llm.near_dedup import near_duplicates


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 85 percent of their 3-word shingles; the least doc_id of a group is kept."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score of every document by a lexicon that is learnt from labelled rows outside the held-out fold."""
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrase matches, and in n_near and near_sha256 the items with proximity matches only."""
    found = op4_proximity(spark, sf_dir)
    return found.withColumn("near_sha256", F.sha2(decontam.listed("near_items"), 256)).drop("near_items")


def op4_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the items themselves."""
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), decontam.REACH)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated lines of 8 words or more: what each document loses, the first copies staying."""
    return line_dedup.digest(table(spark, sf_dir, "documents"), min_words=8)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, the base rules, and the verdict of the robust distances."""
    return quality.digest(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without bytes covered by strings of 400 that start elsewhere too."""
    return substring_dedup.digest(table(spark, sf_dir, "documents"), length=400)


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with weak candidates that others complement."""
    return secrets_scan.digest(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base matches, and looser candidates that the trees select."""
    return pii.digest(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the lines of every document."""
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; each seventh vector has the next label."""
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, after planting, and what is left of it."""
    return tandem.digest(table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, and the bytes that they decode to."""
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {f.__name__: f for f in (op7_minhash_near_dedup, op8_toxicity, op4_decontamination, op2_line_dedup, op1_best_fit_packing, op9_quality_rules, op10_substring_dedup, op6_secret_scans, op3_pii, op5_token_counts, op11_hard_negatives, op12_periodic_runs, op13_byte_bpe)}
ORACLES: dict[str, str] = {"op7_minhash_near_dedup": oracles.OP7, "op4_decontamination": oracles.OP4, "op2_line_dedup": oracles.OP2, "op10_substring_dedup": oracles.OP10, "op11_hard_negatives": oracles.OP11}
