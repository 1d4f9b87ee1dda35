"""Filter, deduplicate, decontaminate and pack a corpus: five stages over `documents`.

Every stage takes what its predecessor kept, is written as Parquet and read again
by the next one.  All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.common import stored, table
from plumbline.llm.decontamination import drop_contaminated
from plumbline.llm.exact_dedup import drop_exact_duplicates
from plumbline.llm.ngram_join import drop_near_duplicates
from plumbline.llm.packing import pack_documents
from plumbline.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3 stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a Jaccard similarity of 0.8 on 5-word shingles the smallest id stays."""
    return drop_near_duplicates(docs, size=5, share=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return pack_documents(docs, with_ids=False)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can't express the toxicity score and the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
