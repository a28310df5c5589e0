"""Streaming use of the transforms.

Every transform in ``seqprep.operators`` is a per-row array expression plus,
where it needs fitted state, a join with a static state table. So the same
functions apply to a streaming DataFrame as a stream–static join; fitting
stays a batch job. These helpers wire a file-source stream through a
transform into a sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seqprep.operators import clean
from seqprep.sources.io import write_scratch_table


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def run_stream(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    sink_path: str,
    checkpoint_path: str,
    fmt: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Apply ``transform`` to a stream and write it (append mode, exactly-once
    file sink with a checkpoint). ``available_now`` processes what is there
    and stops."""
    out = transform(stream)
    w = out.writeStream.format(fmt).option("path", sink_path).option("checkpointLocation", checkpoint_path)
    w = w.outputMode("append")
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def clean_arriving_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sink_path: str,
    checkpoint_path: str,
    config: clean.CleaningConfig | None = None,
    dataset: str = "(.*)",
    out: str = "dataset",
) -> StreamingQuery:
    """Clean the files that came since the last run, each by bounds fitted on
    itself. ``dataset`` is a pattern over the file's path whose first group names
    the data set (default: the file): the files of one data set that come together are
    fitted together. Files already cleaned are not read again.

    Every micro-batch is written once, as both the fit and the cleaning read it,
    and its result goes to the folder ``batch=<id>`` of the sink, which a
    repeated batch overwrites: after a failure no row is lost or doubled."""
    files = read_stream(spark, path, schema).withColumn(out, F.regexp_extract(F.col("_metadata.file_path"), dataset, 1))

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = write_scratch_table(batch)
        bounds = clean.fit_bounds(rows, config, group_by=[out])
        clean.clean(rows, bounds, config, group_by=[out]).write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    writer = files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_path)
    return writer.trigger(availableNow=True).start()
