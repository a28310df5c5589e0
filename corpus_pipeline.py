"""Training-corpus pipeline: documents to packed token sequences.

``STAGES`` are run in order, each written as Parquet and read as the next
one's documents: documents of low quality go, exact copies go, one document of
each near-duplicate group stays, sources are mixed to target weights, and the
mix is packed. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.common import table, tokenizer_path, written
from seqprep.llm.dedup import drop_exact_duplicates
from seqprep.llm.mixing import mixed_documents
from seqprep.llm.packing import pack_documents
from seqprep.llm.quality import drop_low_quality
from seqprep.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.7 or more."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    return drop_near_duplicates(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weighing 5, 2, 1 in turn, none taken more than three times."""
    mixed = mixed_documents(docs, cycle=(5, 2, 1), cap=3)
    # a document taken in part is shorter than it was
    return mixed.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    # the executors' heaps are full by now, so the workers beside them are kept small
    return pack_documents(
        docs, tokenizer_path(), end_id=0, capacity=1024, with_ids=True, batch_bytes=1 << 20, kept_pieces=150_000
    )


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", packing)]

# The classifier cannot be stated in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
