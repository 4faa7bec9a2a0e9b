"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of docs. ``run`` writes what a stage returns to the shared scratch folder and reads it again for the next.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables, and further columns under any
name, which it hands on. What becomes of each case stands with the stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontam, line_dedup, near_dedup, packing, toxicity
from quillspark.llm.common import durable, fresh, table

MIN_WORDS, SHINGLE_WORDS, PERCENT, WINDOW = 8, 5, 80, 10


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the lexicon scores as toxic; it is learnt from labelled documents of docs.

    Null and empty texts have no hits and stay. A null doc_id is scored and not learnt from. Repeated rows share their verdict; without
    labels of both classes all stay.
    """
    return toxicity.keep_civil(docs, toxicity.learn(docs, toxicity.learnable(table(spark, sf_dir, "labels"))))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are cut out of the texts, and n_chars follows; a document of which nothing is left goes.

    The first copy is that of the least doc_id, null before all others. Null and empty texts have no lines and stay, and so do
    short lines, however often they occur. Rows that repeat doc_id and text share their verdict, so none of them is a later copy of the other.
    """
    gone = fresh("n_removed", docs.columns)
    cut = line_dedup.dedup_lines(docs, MIN_WORDS).toDF(*docs.columns, fresh("n_lines", docs.columns), gone, fresh("n_runs", docs.columns))
    cut = cut.where(f"{gone} = 0 or text <> ''")
    return cut.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select([f"`{c}`" for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least doc_id of each near-duplicate group.

    Null and empty texts, and rows with a null doc_id, are in no group and stay. Rows that repeat a doc_id stay or go together.
    """
    kept = near_dedup.near_duplicates(docs, SHINGLE_WORDS, PERCENT).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item, as a phrase or with all its words nearby.

    Null and empty texts hold none and stay. Items without id or words ask nothing. Repeated rows share their verdict.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"), WINDOW, reach=decontam.REACH)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece with the end token. Repeated rows are packed each for itself.
    """
    return packing.digest(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", civil),
    ("line_dedup", without_repeated_lines),
    ("minhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", uncontaminated),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The learnt lexicon, the token counts and the sequences can't be expressed in SQL.
ORACLE_SQL = None
