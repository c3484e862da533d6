"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents. The stages are those of quire.llm; without that
subpackage this module cannot be imported, and the entry point leaves its query out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import dart_minhash, exact_dedup, language_id, mixing, packing
from quire.llm.common import documents
from quire.session import ship
from quire.tables import materialize, release, release_since, written_tables

#: no SQL can express the language model, the signatures and the tokenizer
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are far from every language learned go."""
    ship(spark)
    return language_id.keep_known(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return dart_minhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.keep_mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        mark = written_tables()
        left = materialize(stage(spark, docs, sf_dir), name)
        release_since(mark, left)  # what the stage wrote on its way
        if hasattr(docs, "_quire_path"):
            release(docs)
        docs = left
    return STAGES[-1][1](spark, docs, sf_dir)
