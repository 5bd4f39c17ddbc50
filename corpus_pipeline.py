"""The corpus pipeline: five stages over ``documents``, each one operator of the llm subpackage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept.
``run`` writes every stage's result as Parquet in the shared folder and reads it back as
the next one's input, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import line_dedup, packing, pii, simhash, toxicity
from touchline.llm.common import materialise, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones, does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def strip_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines found on many sites; documents that held no other line go."""
    return line_dedup.strip_boilerplate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each SimHash component (3-word shingles, 2 bits)."""
    return simhash.keep_one_per_group(docs)


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each span of personal data replaced by its kind."""
    return pii.redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The manifest of the packed sequences: which piece of which document goes where."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", strip_boilerplate),
    ("simhash", drop_near_copies),
    ("pii", redact_private),
    ("packing", pack_sequences),
]

#: The toxicity model, fingerprints and the packing search are beyond SQL; see tests/llm/test_methods.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
