"""Token-ID files: Parquet list columns in ascending document order.

Documents are range-partitioned and sorted by id, encoded, and written as
``doc_id, n_tokens, ids`` with dictionary-coded ids (bit-packed indexes),
delta-coded document columns, bounded row groups and pages with page indexes,
so a reader can fetch metadata alone or the ids of a few documents. File
numbers follow the order, so the global place of each document's ids is the
prefix sum over files plus the running sum inside its file.

Defined results: a null or empty text has only the end id; null ids come
first; rows with equal ids are in no stated order but all kept; an empty
table gives files without rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqprep.llm.common import bounded_batches, partitions_for
from seqprep.plans.rank import part_number

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10

# Parquet settings: version-2 pages (delta coding), a dictionary for the ids only.
LAYOUT = {
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "compression": "snappy",
}


def _encode(tokenizer_path: str, end_id: int):
    def encode(batches):
        from seqprep.llm.encoding import encoder

        enc = encoder(tokenizer_path)
        for batch in batches:
            ids, sizes = enc.encode(batch.column(1))
            ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<i4")
            offsets = np.concatenate(([0], np.cumsum(sizes + 1))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes + 1, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                names=["doc_id", "n_tokens", "ids"],
            )

    return encode


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every text, append ``end_id``, and write the token files to ``path``."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange(partitions_for(rows), "doc_id").sortWithinPartitions("doc_id")
    coded = ordered.mapInArrow(_encode(tokenizer_path, end_id), "doc_id long, n_tokens int, ids array<int>")
    coded.write.options(**LAYOUT).parquet(path)


def _checksums(batches):
    """Length and unsigned crc32 of each document's ids, as little-endian unsigned
    32-bit integers, over slices of the batch's flat buffer."""
    for batch in batches:
        lists = batch.column(1)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        flat = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
        crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(bounds)), pa.array(crc, pa.int64()), batch.column(2), batch.column(3)],
            names=["doc_id", "n_tokens", "ids_crc32", "_file", "_row"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` and each document's place: ``_file``, the number
    of its file, and ``_row``."""
    return spark.read.parquet(path).select(
        "doc_id", "n_tokens", "ids", part_number(F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.row_index").alias("_row")
    )


def with_starts(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before a row's, to rows with
    ``_file, _row, n_tokens``; ``totals`` has the ids of each file, which are
    ordered by number. The prefix over files has one row per file."""
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("_file").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(bases, "_file").withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("base")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files: ``start`` counts
    the ids of all documents before it. Only lengths and checksums are shuffled."""
    # ids are only read through here, so small batches cost little and hold little
    bounded_batches(spark, rows=500, size=8 << 20)
    read = read_token_files(spark, path)
    rows = read.select("doc_id", "ids", "_file", "_row").mapInArrow(_checksums, "doc_id long, n_tokens long, ids_crc32 long, _file long, _row long")
    totals = read.groupBy("_file").agg(F.sum(F.col("n_tokens").cast("long")).alias("total"))
    return with_starts(rows, totals).select("doc_id", "start", "n_tokens", "ids_crc32")
