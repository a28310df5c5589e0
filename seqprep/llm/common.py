"""Helpers shared by the operators: texts, locators, written tables."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.plans.state import DEFAULT_BROADCAST_BYTES
from seqprep.session import ensure_checkpoint_dir

# White space of the contracts: space and the control characters 9 to 13.
WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file; it is read where it is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_of(text: Column) -> Column:
    """The text as a string, null read as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of white-space separated words (null: 0), as long."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def scratch_path(df_or_spark, kind: str) -> str:
    """A new folder under the session's shared checkpoint folder."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    return os.path.join(ensure_checkpoint_dir(spark), f"{kind}-{uuid.uuid4().hex}")


def written(df: DataFrame, kind: str = "table") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the
    lineage, survives lost executors, and is computed once."""
    path = scratch_path(df, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, row_bytes: int, limit: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``df`` as a join side: broadcast when ``rows * row_bytes`` (a counted
    number of rows of a stated width) is within ``limit``; plain otherwise,
    and then the join shuffles both sides and AQE splits skewed keys."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


def is_plain_scan(df: DataFrame) -> bool:
    """Whether the plan is a file scan with only projections and filters on it."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = re.findall(r"^[\s:+\-]*([A-Z]\w+)", plan, re.M)
    return bool(nodes) and set(nodes) <= {"Project", "Filter", "Relation"}


def as_scan(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows have a place (a plain Parquet scan), else a copy
    written as Parquet."""
    if "_metadata" not in docs.columns and is_plain_scan(docs):
        try:
            docs.select("_metadata.row_index")
            return docs
        except AnalysisException:
            pass  # a scan of another format has no row index
    return written(docs, "docs")


def with_locator(scan: DataFrame, columns: list) -> DataFrame:
    """``columns`` of a scan (see ``as_scan``) and the place of each row:
    ``_file``, ``_row`` (its index in the file), unique whatever the ids are."""
    return scan.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def whole_rows(scan: DataFrame) -> DataFrame:
    """``doc`` (the row as one struct, so that its names clash with nothing) and
    the place of each row."""
    return with_locator(scan, [F.struct(*[F.col(f"`{c}`") for c in scan.columns]).alias("doc")])


def partitions_for(df: DataFrame, bytes_each: int = 64 << 20) -> int:
    """Number of shuffle partitions: the session's, or more where the
    optimizer's size of ``df`` would put over ``bytes_each`` in one."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a plan without a known size counts as enormous: then the session decides
    return least if size >= 1 << 60 else max(least, -(-size // bytes_each))


def few_parts(df: DataFrame, source: DataFrame, bytes_each: int = 64 << 20) -> DataFrame:
    """``df``, derived from ``source``, in two partitions for each core at most, or
    more where one would stand for over ``bytes_each`` of ``source``.

    Each file of a table takes its writer two processes (Hadoop's ``chmod`` on a
    local file system, for the file and its checksum), so a table of many small
    shuffle partitions or splits is written by fewer tasks."""
    size = int(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= 1 << 60:  # a plan without a known size
        return df
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-size // bytes_each)))


def bounded_batches(spark, rows: int = 2000, size: int = 32 << 20) -> None:
    """Bound Arrow batches by bytes too, so a run of long texts cannot fill a
    Python worker (a session setting that changes no result)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
