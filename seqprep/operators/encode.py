"""Ordinal encoding of static columns by order of first appearance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.plans.rank import ranked_keys
from seqprep.plans.state import State, as_state
from seqprep.sources.schema import require_columns


def fit_encoder(
    df: DataFrame,
    columns: list[str],
    order: tuple[str, ...] = ("_first", "userId", "id"),
    ts: str = "timestamp",
) -> DataFrame:
    """State ``(column, value, idx)``: idx = order of first appearance of the
    value in ``df`` sorted by (first timestamp, userId, id). NULL is a value
    like any other (as ``unique()`` keeps it).

    One scan: every row emits its (column, value) pairs; each value's first
    appearance is a min over a partial-aggregated groupBy; the values are then
    ranked by a range-partitioned sort (``ranked_keys``), never in one task."""
    require_columns(df, columns, "fit_encoder")
    base = df.withColumn("_first", F.get(F.col(ts), 0)) if "_first" in order else df
    key = F.struct(*[F.col(o) for o in order])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    cats = (
        base.select(key.alias("_k"), F.explode(pairs).alias("_p"))
        .groupBy(F.col("_p.column").alias("column"), F.col("_p.value").alias("value"))
        .agg(F.min("_k").alias("_k"))
    )
    ranked = ranked_keys(cats.select("column", "value", "_k"), ["column"], ["_k", "value"])
    return ranked.select("column", "value", F.col("_rank").cast("long").alias("idx"))


def apply_encoder(df: DataFrame, state, columns: list[str], suffix: str = "_idx") -> DataFrame:
    """Add ``<col>_idx``; a value not seen at fit time gets NULL.

    Each column's dictionary is counted by itself: a large one (user ids) is
    joined by shuffle without turning the small ones into shuffle joins."""
    st = as_state(state)
    sizes = {r["column"]: r["n"] for r in st.df.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = df
    for c in columns:
        m = st.df.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("idx").alias(c + suffix))
        side = State(m, sizes.get(c, 0), st.row_bytes).side()
        out = out.join(side, F.col(c).cast("string").eqNullSafe(F.col("_v")), "left").drop("_v")
    return out


def nunique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-NULL values per column (one row)."""
    return df.agg(*[F.count_distinct(F.col(c)).cast("long").alias(f"n_{c}") for c in columns])
