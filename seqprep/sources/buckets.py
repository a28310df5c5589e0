"""Bucketed tables: rows hashed on a key once, when they are stored.

A table stored in buckets keeps its layout, so every later join or grouping on
the key reads matching buckets in one task and shuffles nothing. Two tables that
are joined must have the same number of buckets: ``write_bucketed_together``
takes it from the largest of them.

Bucket keys that repeat make uneven buckets, and a scan of buckets is not split
for skew: bucket on a key such as the record id, not on a user who may have a
third of all rows.

The layout lies beside the rows as a one-row table, so a stored table can be
opened in any session without a shared catalog. Defined results: rows with a
NULL key are kept (in one bucket); an empty table has no rows and keeps its
schema; a path that holds a table is not overwritten.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seqprep.sources.io import MissingInputError

# Bytes of a bucket at which their number is chosen.
BUCKET_BYTES = 128 << 20
_LAYOUT = "bucket_key string, buckets int, columns string"


def buckets_for(*tables: DataFrame, bytes_each: int = BUCKET_BYTES) -> int:
    """Buckets for tables that are joined: the session's shuffle partitions, or
    more where the largest would put over ``bytes_each`` in one."""
    spark = tables[0].sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = [int(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for t in tables]
    known = [s for s in sizes if s < 1 << 60]  # a plan of unknown size counts as enormous
    return max([least, *(-(-s // bytes_each) for s in known)])


def write_bucketed(df: DataFrame, path: str, key: str = "id", buckets: int | None = None) -> DataFrame:
    """Store ``df`` at ``path`` in buckets of ``key`` and return it as stored. One
    shuffle on the key; each task writes one bucket as one sorted file."""
    spark = df.sparkSession
    buckets = buckets or buckets_for(df)
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = df.repartition(buckets, F.col(f"`{key}`"))
    rows.write.mode("error").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{path}/rows").saveAsTable(name)
    # the layout is committed last: a table without it was not finished
    spark.createDataFrame([(key, buckets, df.schema.json())], _LAYOUT).coalesce(1).write.parquet(f"{path}/layout")
    return spark.table(name)


def write_bucketed_together(tables: dict[str, DataFrame], path: str, key: str = "id", buckets: int | None = None) -> dict[str, DataFrame]:
    """Store each table at ``path/<name>``, all in the same number of buckets."""
    buckets = buckets or buckets_for(*tables.values())
    return {name: write_bucketed(df, f"{path}/{name}", key, buckets) for name, df in tables.items()}


def read_bucketed(spark: SparkSession, path: str, stage: str = "store") -> DataFrame:
    """A table that ``write_bucketed`` stored, in this or an earlier session."""
    try:
        layout = spark.read.schema(_LAYOUT).parquet(f"{path}/layout").first()
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex):
            raise MissingInputError(f"{path} not found: run the '{stage}' step first") from ex
        raise
    name, key = _table_name(path), layout["bucket_key"].replace("`", "``")
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(layout["columns"])))
    place = f"{path}/rows".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {layout['buckets']} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def _table_name(path: str) -> str:
    """The catalog's name for the table at a path; it only points to the files."""
    return f"bucketed_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:32]}"
