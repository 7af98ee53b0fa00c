"""Documents to token ids: toxic texts, copies, near copies and benchmark items out, then encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freightloom.llm import queries
from freightloom.llm.common import staged, table
from freightloom.llm.decontaminate import drop_leaks
from freightloom.llm.exact_dedup import drop_exact_duplicates
from freightloom.llm.simhash import MAX_BITS, WIDTH, drop_near_duplicates
from freightloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, trained on the labelled ones, does not call toxic."""
    return drop_toxic(docs, queries.toxicity_chain(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return drop_exact_duplicates(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the one with the smallest id."""
    return drop_near_duplicates(docs, width=WIDTH, max_bits=MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the token ids, and of the bytes they decode to."""
    return queries.byte_bpe_of(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]

#: SQL cannot fit the classifier of the first stage; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
