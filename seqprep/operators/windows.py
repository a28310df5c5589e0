"""Sliding windows: one example row per (sequence, time step)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.functions.arrays import let
from seqprep.plans.rank import null_safe_join
from seqprep.plans.state import materialize
from seqprep.sources.schema import require_columns


def sliding_windows(
    df: DataFrame,
    numerical_columns: Sequence[str],
    target_column: str,
    heartrate_input_column: str | None = None,
    window_size: int = 10,
    static_columns: Sequence[str] = (),
    id_col: str = "id",
) -> DataFrame:
    """Rows ``(id, t, features, target, static…)`` for t = 0 … L−1.

    ``features`` is ``array<array<float>>`` of shape [window, F]: the
    numerical columns over steps t−w+1 … t (zero padded on the left) and,
    when ``heartrate_input_column`` is given, that column over t−w … t−1 as
    the last feature (the input never contains the target step). ``target``
    is ``target_column[t]``. Lengths may differ between rows. Static columns
    ride along on every window row (no lookup join). Padded copies are built
    once per sequence; windows are generated lazily by ``explode``.
    """
    staged, steps = _staged_steps(df, numerical_columns, target_column, heartrate_input_column, window_size,
                                  [id_col, *static_columns])
    out = staged.select(id_col, *static_columns, F.explode(steps).alias("_w"))
    return out.select(
        id_col, F.col("_w.t").cast("long").alias("t"), F.col("_w.features").alias("features"),
        F.col("_w.target").alias("target"), *static_columns,
    )


def _staged_steps(df: DataFrame, numerical_columns: Sequence[str], target_column: str,
                  heartrate_input_column: str | None, window_size: int, keep: Sequence[str]):
    """Padded copies of the inputs (built once per sequence) and the column
    expression of all windows of a row as ``array<struct<t, features, target>>``."""
    if window_size < 1:
        raise ValueError("window_size must be >= 1")
    cols = list(numerical_columns)
    require_columns(df, [*keep, target_column, *cols]
                    + ([heartrate_input_column] if heartrate_input_column else []), "sliding_windows")
    w = window_size
    staged = df.select(
        *keep,
        F.col(target_column).alias("_y"),
        *[F.concat(F.array_repeat(F.lit(0.0), w - 1), F.col(c).cast("array<double>")).alias(f"_p{i}")
          for i, c in enumerate(cols)],
        *([F.concat(F.array_repeat(F.lit(0.0), w), F.col(heartrate_input_column).cast("array<double>")).alias("_ph")]
          if heartrate_input_column else []),
    )
    n = F.size(F.col("_y"))
    # the padded arrays are bound once per row (``let``): a staged column used
    # only inside a lambda would otherwise be inlined there by Catalyst and
    # rebuilt for every element
    names = [f"_p{i}" for i in range(len(cols))] + (["_ph"] if heartrate_input_column else [])
    padded = F.struct(*[F.col(c).alias(c) for c in names], F.col("_y").alias("_y"))

    def all_steps(P):
        def step(t):
            def row(k):
                return F.transform(F.array(*[P[c][t + k] for c in names]), lambda v: v.cast("float"))

            return F.struct(
                t.alias("t"),
                F.transform(F.sequence(F.lit(0), F.lit(w - 1)), row).alias("features"),
                P["_y"][t].cast("float").alias("target"),
            )

        return F.transform(F.sequence(F.lit(0), F.size(P["_y"]) - 1), step)

    return staged, F.when(n > 0, let(padded, all_steps))


def predict_inline(df: DataFrame, scorer, numerical_columns: Sequence[str], target_column: str,
                   heartrate_input_column: str | None = None, window_size: int = 10,
                   out: str = "predicted_heart_rate") -> DataFrame:
    """Score every window of a row without leaving the row: the prediction
    array is computed from the row's own padded arrays (no explode, no
    regroup shuffle, no join back). For scorers that are column expressions;
    models that need Python use ``sliding_windows`` + ``mapInPandas``."""
    keep = list(df.columns)
    staged, steps = _staged_steps(df, numerical_columns, target_column, heartrate_input_column, window_size, keep)
    scored = staged.withColumn(out, F.transform(steps, lambda s: scorer(s["features"])))
    return scored.drop("_y", "_ph", *[f"_p{i}" for i in range(len(numerical_columns))])


def attach_static(df: DataFrame, records: DataFrame, columns: Sequence[str], order: Sequence[str], id_col: str = "id") -> DataFrame:
    """Add the static ``columns`` of each id's last record by ``order`` (of records
    that tie the greatest by the columns' values); NULL where an id has no record. A
    max with map-side combine finds the last record; the result joins as a
    broadcast only where its measured size allows it."""
    require_columns(records, [id_col, *columns, *order], "attach_static")
    key = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *columns)
    last = records.groupBy(id_col).agg(F.max(key).alias("_last")).select(id_col, *[F.col(f"_last.{c}").alias(c) for c in columns])
    return null_safe_join(df.drop(*columns), materialize(last).side(), [id_col], how="left")


# Windows that are put together at a time in a Python worker.
CHUNK = 65_536


def window_blocks(batch: pa.RecordBatch, numerical_columns: Sequence[str], heartrate_input_column: str | None,
                  window_size: int) -> Iterator[tuple[slice, np.ndarray]]:
    """The windows of all sequences of an Arrow batch, ``[n, window, F]`` 32-bit
    floats as in ``sliding_windows``, in blocks of ``CHUNK``, and the points of
    the batch they belong to. Sequences are padded in one array and windows are
    strided views of it: nothing is exploded. Every column must have the length
    of the first; NULL sequences count as empty, NULL points as NaN."""
    w = window_size
    names = [*numerical_columns, *([heartrate_input_column] if heartrate_input_column else [])]
    sizes = list_sizes(batch.column(names[0]))
    pad = np.cumsum(np.full(len(sizes), w))  # w zeros stand before each sequence
    place = np.arange(int(sizes.sum())) + np.repeat(pad, sizes)
    views = []
    for i, name in enumerate(names):
        column = batch.column(name)
        if not np.array_equal(list_sizes(column), sizes):
            raise ValueError(f"sequences of {name} differ in length from those of {names[0]}")
        padded = np.zeros(int(sizes.sum()) + w * len(sizes), np.float32)
        padded[place] = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        lag = 1 if heartrate_input_column and i == len(names) - 1 else 0
        views.append((np.lib.stride_tricks.sliding_window_view(padded, w) if len(padded) >= w else np.zeros((0, w), np.float32), lag))
    for a in range(0, len(place), CHUNK):
        at = place[a : a + CHUNK] - w + 1
        yield slice(a, a + len(at)), np.stack([view[at - lag] for view, lag in views], axis=2)


def static_values(batch: pa.RecordBatch, static_columns: Sequence[str]) -> np.ndarray:
    """Numbers of each row that hold for all its windows, ``[rows, S]`` doubles;
    NULL is NaN."""
    out = np.empty((batch.num_rows, len(static_columns)))
    for i, name in enumerate(static_columns):
        out[:, i] = batch.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return out


def list_sizes(column: pa.Array) -> np.ndarray:
    """Elements of each list of an Arrow column; a NULL list has none."""
    return column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
