"""From raw documents to encoded training text, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written to
the shared folder and read again as the next stage's docs. All stages but the last
return the columns of the documents.

Defined cases are those of the operators: null texts fail the quality rules, so no
later stage sees one; of equal rows one is left; a document that the mix takes twice
is there twice; an empty table passes through all stages as an empty table; columns
beyond those of the documents go through every stage but the last, whatever they
are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import bpe, exact_dedup, fertility, mixing, simhash
from strandline.llm.common import documents, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the bands of their script."""
    return fertility.kept_documents(spark, docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.deduplicated(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-equal texts the document with the smallest id."""
    return simhash.deduplicated(spark, docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(spark, docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again; as counts and hashes."""
    return bpe.stage(spark, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("source_mixing", source_mix),
    ("bpe_round_trip", encoding),
]

#: Fingerprints, vocabularies and merges have no SQL form; tests hold a brute-force twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
