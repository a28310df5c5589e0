"""Exact deduplication with streaming state.

Digests of the normalised texts flow through a Structured Streaming
aggregation whose keyed state (RocksDB on disk, no watermark, so nothing
expires) holds per digest the smallest identifier, the place of that row's
content and the number of rows seen. Rows that hit an existing key are then
checked byte by byte against the content found at the stored place.

Native throughout: DataFrame and SQL functions only.

Defined results: a null text counts as empty; rows with a null id rank after
all others, ties (repeated ids) by file and row; repeated rows are copies of
each other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.common import WS, as_scan, partitions_for, scratch_path, small_side, text_of, whole_rows, with_locator, written

# The state store: RocksDB, which does not reserve disk ahead of use (a store
# exists per state partition, so reserved space would be many times the state). All
# stores of an executor share one bounded cache; their write buffers lie outside its heap.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
}
# Bytes of one locator row (path, index, digest) in a broadcast table.
LOCATOR_BYTES = 320


def normalised(text: Column) -> Column:
    """Every run of white space as one space; null as empty."""
    return F.regexp_replace(text_of(text), WS, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def run_state(spark: SparkSession, keys_path: str, schema, checkpoint: str, partitions: int | None = None) -> DataFrame:
    """Feed every new file of ``keys_path`` (``digest, id, _file, _row``) through
    the keyed state at ``checkpoint`` and return the state: ``digest, keeper, n``.

    Calling it again after more files arrived resumes from the same state. The
    number of state partitions follows the keys' size at the first run and is then
    fixed in the checkpoint: a state meant to grow gets its ``partitions``."""
    partitions = partitions or partitions_for(spark.read.schema(schema).parquet(keys_path))
    with _settings(spark, STATE_STORE | {"spark.sql.shuffle.partitions": str(partitions)}):
        rows = spark.readStream.schema(schema).parquet(keys_path)
        first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "_file", "_row"))
        state = rows.groupBy("digest").agg(first.alias("keeper"), F.count(F.lit(1)).alias("n"))
        query = (
            state.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    stored = spark.read.format("statestore").load(checkpoint)
    keeper, n = (f.name for f in stored.schema["value"].dataType.fields)
    return stored.select(
        F.col("key")["digest"].alias("digest"), F.col("value")[keeper].alias("keeper"), F.col("value")[n].alias("n")
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per input row: ``id``, ``keep_id`` (the row of its group that
    stays), ``group_size``, ``kept``, ``digest``, and its place ``_file, _row``.

    Rows are equal when their normalised texts are the same bytes. ``digest``
    only routes: texts that share a digest but differ are told apart."""
    spark = docs.sparkSession
    placed = with_locator(as_scan(docs), [F.col(id_col).alias("id"), F.col(text_col).alias("text")])
    keys_path = scratch_path(spark, "digests")
    placed.select(digest(normalised(F.col("text"))).alias("digest"), "id", "_file", "_row").write.parquet(keys_path)
    keys = spark.read.parquet(keys_path)
    with _settings(spark, STATE_STORE):  # reading the state opens the stores again
        state = written(run_state(spark, keys_path, keys.schema, scratch_path(spark, "state")), "groups")

    place = F.struct("_file", "_row")
    keeper = F.struct(F.col("keeper._file"), F.col("keeper._row"))
    joined = keys.join(state, "digest").select(
        "id", F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"), (place == keeper).alias("kept"),
        "digest", "_file", "_row",
    )
    differs = _differing(placed, joined)
    if differs is None:
        return joined
    regrouped = differs.groupBy("digest", "text").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "_file", "_row")).alias("keeper"),
        F.count(F.lit(1)).alias("n"),
    )
    fixed = differs.join(regrouped, ["digest", "text"]).select(
        "id", F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"), (place == keeper).alias("kept"),
        "digest", "_file", "_row",
    )
    return joined.join(differs.select("digest").distinct(), "digest", "left_anti").select(*fixed.columns).unionByName(fixed)


def _differing(placed: DataFrame, joined: DataFrame) -> DataFrame | None:
    """Rows (with texts) of the digests whose texts are not all the same bytes;
    None where every hit equals the content its state points to."""
    members = written(joined.filter("group_size > 1").select("digest", "kept", "_file", "_row"), "hits")
    side = small_side(members, members.count(), LOCATOR_BYTES)
    texts = written(
        placed.join(side, ["_file", "_row"]).withColumn("text", normalised(F.col("text"))), "texts"
    )
    kept = texts.filter("kept").select("digest", F.col("text").alias("kept_text"))
    wrong = written(
        texts.filter("not kept").join(kept, "digest").filter("text <> kept_text").select("digest"), "wrong"
    )
    if wrong.isEmpty():
        return None
    return texts.join(wrong, "digest", "left_semi")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    scan = as_scan(docs)
    dropped = written(exact_dedup(scan, id_col, text_col).filter("not kept").select("_file", "_row"), "dropped")
    side = small_side(dropped, dropped.count(), LOCATOR_BYTES)
    return whole_rows(scan).join(side, ["_file", "_row"], "left_anti").select("doc.*")
