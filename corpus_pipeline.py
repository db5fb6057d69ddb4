"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and read again
as the next stage's ``docs``. All stages but the last return the columns of
``documents``, so a stage's decisions reach every later one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import minhash, packing, radix_dedup, toxicity
from tidemark.llm.queries import WORD_BPE
from tidemark.llm.staging import stage
from tidemark.sources.tables import table

#: Chunks a worker remembers the ids of in packing, a third of the operator's own number: a worker
#: goes from stage to stage beside a heap that the stages before have filled, and keeps what it took.
PACKING_CHUNKS = 300_000


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores 0.5 or more go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white-space runs as one space) the smallest doc_id stays."""
    return radix_dedup.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked on five-word shingles at 0.8 the smallest doc_id stays."""
    return minhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences of 4,096."""
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), cache_entries=PACKING_CHUNKS)


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", pack),
]

#: Tokenizer ids and a trained classifier are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to the ``documents`` table, each over a stored table."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
