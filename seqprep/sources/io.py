"""Readers and writers: Parquet under a declared schema, single-quoted JSON
signal records, per-sport outputs, and fitted state tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from seqprep.session import ensure_checkpoint_dir
from seqprep.sources.schema import WORKOUT, conform

# Schema of a raw signal record (workout id, timestamps, altitudes).
SIGNAL_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.ArrayType(T.LongType())),
        T.StructField("altitude", T.ArrayType(T.DoubleType())),
    ]
)


class MissingInputError(FileNotFoundError):
    """An input of a stage is missing; the message names the step that makes it."""


def _require(spark: SparkSession, path: str, stage: str, fn):
    try:
        return fn()
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex) or "Path does not exist" in str(ex):
            raise MissingInputError(f"{path} not found: run the '{stage}' step first") from ex
        raise


def read_sequences(spark: SparkSession, path: str, schema: T.StructType = WORKOUT, stage: str = "prepare",
                   recursive: bool = False, pattern: str | None = None) -> DataFrame:
    """Read sequence Parquet under an explicit schema (no inference). With
    ``recursive``/``pattern`` many files are read; ``_metadata.file_path``
    identifies the file of each row (a fit group key)."""
    reader = spark.read.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return _require(spark, path, stage, lambda: reader.parquet(path))


def with_source_file(df: DataFrame, out: str = "source_file") -> DataFrame:
    return df.withColumn(out, F.col("_metadata.file_path"))


def write_sequences(df: DataFrame, path: str, schema: T.StructType = WORKOUT, partition_by: list[str] | None = None,
                    mode: str = "overwrite") -> None:
    """Cast-and-select to the declared schema (extra partition columns kept), then write."""
    extra = [c for c in (partition_by or []) if c not in schema.fieldNames()]
    out = conform(df, schema, keep=extra)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], mode: str = "overwrite") -> None:
    """One dataset per value of ``partition_by`` (e.g. sport and std_scale);
    readers prune partitions by directory."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_signal_json(spark: SparkSession, path: str, schema: T.StructType = SIGNAL_SCHEMA,
                     stage: str = "download") -> DataFrame:
    """Line-delimited records written with single quotes (Python literals).
    The JSON reader accepts single quotes natively, apostrophes inside values
    included. ``_rec`` = (file path, start of the split in the file, position
    in the split) orders records whatever tasks read them, so a later
    duplicate wins."""
    df = _require(spark, path, stage,
                  lambda: spark.read.schema(schema).option("allowSingleQuotes", "true").json(path))
    return df.withColumn("_rec", F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"),
                                          F.monotonically_increasing_id().alias("i")))


def write_state(state: DataFrame, path: str) -> None:
    """Store fitted state (scaler moments, encoder map, clip bounds) as a new
    version: a whole table in a folder of its own, then one line of the manifest
    table that names it. The line is committed last, so a reader sees the whole
    version before or the whole new one, and a job that dies leaves the old one
    in force. Earlier versions stay until the user removes them. Of writers at
    one time the later by name wins."""
    spark = state.sparkSession
    folder = f"version-{uuid.uuid4().hex}"
    state.write.parquet(f"{path}/{folder}")
    last = _current_version(spark, path)
    line = spark.range(1).select(F.lit((last[0] if last else 0) + 1).cast("long").alias("number"), F.lit(folder).alias("folder"))
    line.write.mode("append").parquet(f"{path}/manifest")


def _current_version(spark: SparkSession, path: str):
    """``number, folder`` of the last version in the manifest, None without one."""
    try:
        lines = spark.read.schema("number long, folder string").parquet(f"{path}/manifest")
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex):
            return None
        raise
    return lines.agg(F.max(F.struct("number", "folder")).alias("last")).first()["last"]


def read_state(spark: SparkSession, path: str, stage: str = "fit") -> DataFrame:
    """The current version of a stored state. It goes on reading that version
    when a newer one is stored meanwhile."""
    last = _current_version(spark, path)
    return _require(spark, path, stage, lambda: spark.read.parquet(f"{path}/{last['folder'] if last else 'manifest'}"))


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new folder name under the session's checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{kind}-{uuid.uuid4().hex}")


def write_scratch_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the session's checkpoint folder and read
    it back: cuts lineage, survives executor loss, and later passes read only
    the columns they need."""
    path = scratch_path(df.sparkSession, "table")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def sql_head(spark: SparkSession, path: str, n: int = 1, order_by: str | None = None) -> DataFrame:
    """``SELECT … LIMIT n`` straight over a Parquet path with Spark SQL (the
    reference's one-row SQL reads), ordered when ``order_by`` is given."""
    order = f" ORDER BY {order_by}" if order_by else ""
    safe = path.replace("`", "``")
    return spark.sql(f"SELECT * FROM parquet.`{safe}`{order} LIMIT {int(n)}")


def write_head(df: DataFrame, path: str, n: int = 10, order_by: str = "id") -> None:
    """Write the first ``n`` rows (by ``order_by``) as a small example file."""
    df.orderBy(order_by).limit(n).write.mode("overwrite").parquet(path)
