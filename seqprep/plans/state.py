"""Fitted state as small tables, and size-checked lookup joins.

Fitted state (per-user statistics, category indexes, clip bounds, segment
plans, rank cuts) is a DataFrame. Before it is joined to a large table it is
materialized once -- written as Parquet into the shared folder the session
names, so a lost executor never forces the fit to run again -- and its rows and
the widest encoded row are measured. Only a table whose measured size is under
the limit is broadcast; a larger one is joined by shuffle.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqprep.session import ensure_checkpoint_dir

# Upper bound for a broadcast side, in bytes (rows x bytes of the mean row).
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED = (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType, T.IntegerType, T.FloatType, T.DateType,
          T.BooleanType, T.ShortType, T.ByteType)


def _row_bytes(schema: T.StructType):
    """Column with the bytes of a row in memory: 8 per fixed-width field, strings
    and nested values by their content (as JSON, which is no shorter than the
    binary form of numbers with few digits, doubled to stay above it)."""
    fixed = 24 + 8 * sum(isinstance(f.dataType, _FIXED) for f in schema.fields)
    size = F.lit(fixed).cast("long")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _FIXED):
            continue
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + 24 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, _FIXED):
            size = size + 24 + 8 * F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
        else:
            size = size + 24 + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return size


@dataclass
class State:
    """A materialized state table, its rows and the bytes of its mean row."""

    df: DataFrame
    rows: int
    row_bytes: float = 0.0

    @property
    def est_bytes(self) -> int:
        if self.rows < 0:
            raise ValueError("state was materialized without measuring its size")
        return int(self.rows * self.row_bytes)

    def side(self, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
        """The table as a join side: broadcast if measured small, else plain."""
        return self.side_for(self.df, max_bytes)

    def side_for(self, derived: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
        """A projection of this state as a join side, sized by the measured bytes."""
        return F.broadcast(derived) if self.est_bytes <= max_bytes else derived


def materialize(df: DataFrame, measure: bool = True) -> State:
    """Write a state table as Parquet into the session's checkpoint folder,
    read it back and measure it.

    A written table -- not an RDD checkpoint, which computes the plan once
    for the action and again to write it -- cuts the lineage, survives the
    loss of executors, and later readers load only the columns they use."""
    folder = ensure_checkpoint_dir(df.sparkSession)
    path = os.path.join(folder, f"state-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    if not measure:
        return State(saved, -1)
    rows, mean = saved.agg(F.count(F.lit(1)), F.avg(_row_bytes(df.schema))).first()
    return State(saved, rows, mean or 0.0)


def as_state(state) -> State:
    return state if isinstance(state, State) else materialize(state)
