"""The corpus pipeline: five stages over ``documents``, each on all rows that
the stage before it kept, written as Parquet and read back in between.

Rows of the result are pieces of packed sequences: doc_id, start, length,
ids_crc32, doc_tokens, sequence_id, offset. A document that is mixed in several
times has its pieces as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationlake.llm import line_dedup, minhash, mixing, packing, toxicity
from stationlake.llm.catalog import vocabulary
from stationlake.llm.common import DOCUMENT_COLUMNS, documents, forget, step, table

NEAR_PERCENT = 80  # of the union of five-word shingles; op9 has a bound of its own


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go; documents stay."""
    return line_dedup.without_frequent_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash.without_near_duplicates(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents cut, encoded and packed into sequences."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_frequent_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned scores and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(*DOCUMENT_COLUMNS)
    for name, stage in STAGES:
        before, docs = docs, step(stage(spark, docs, sf_dir), f"stage-{name}")
        if name != STAGES[0][0]:
            forget(before)
    return docs
