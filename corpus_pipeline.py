"""The corpus pipeline: quality rules, near-duplicates, repeated passages, secrets, packing.

Each stage works on all that its predecessor kept, as a stored table. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.common import numbered, stored, table
from loomframe.llm.near_dedup import drop_near_duplicates
from loomframe.llm.packing import best_fit_packing
from loomframe.llm.quality import keep_good
from loomframe.llm.secret_scan import redact_secrets
from loomframe.llm.suffix_dedup import cut_passages

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows the text that the stage leaves."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return keep_good(docs.select(*COLUMNS))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest doc_id."""
    return drop_near_duplicates(docs.select(*COLUMNS))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand elsewhere too are cut out; a document stays with what is left of it.

    Cuts are made on bytes. Where one falls inside a character, what remains of that character goes as well. Documents without any text
    left stay, with an empty text.
    """
    return _with_length(cut_passages(numbered(docs.select(*COLUMNS)), as_text=True).withColumn("text", F.col("kept")))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark."""
    return _with_length(redact_secrets(docs.select(*COLUMNS)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in the training sequences."""
    return best_fit_packing(docs.select("doc_id", "text"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", passage_stage),
    ("secret_scan", secrets_stage),
    ("best_fit_packing", packing_stage),
]
#: SQL has no tokenizer for the last stage, and none of its own for repeated passages: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
