"""Category consolidation, minimum-count filter and the per-user temporal split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.plans.rank import rank_bands
from seqprep.plans.state import State, materialize
from seqprep.sources.schema import require_columns

# Raw sport name -> consolidated sport (all others are dropped).
SPORT_CONSOLIDATION = {
    "bike": "biking",
    "run": "running",
    "walk": "walking",
    "orienteering": "walking",
    "hiking": "walking",
    "fitness walking": "walking",
}

# Split fractions (validation starts at 0.7·n, test at 0.8·n).
VAL_START = 0.7
TEST_START = 0.8


def consolidate(df: DataFrame, col: str = "sport", mapping: dict | None = None) -> DataFrame:
    """Map raw categories exactly; rows whose category is not in the map are dropped."""
    mp = mapping or SPORT_CONSOLIDATION
    m = F.create_map(*[F.lit(x) for kv in mp.items() for x in kv])
    return df.withColumn(col, F.when(F.col(col).isNull(), F.lit(None)).otherwise(m[F.col(col)])).where(
        F.col(col).isNotNull()
    )


def keys_with(df: DataFrame, key: str, threshold: int) -> State:
    """The keys that have at least ``threshold`` rows, as measured state: a
    partial-aggregated groupBy, which reads the key only."""
    require_columns(df, [key], "min_count")
    return materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= threshold).select(key))


def min_count(df: DataFrame, key: str = "userId", threshold: int = 10) -> DataFrame:
    """Keep rows whose key has at least ``threshold`` rows.

    Counting is a partial-aggregated groupBy; the qualifying keys are joined
    back as a semi join (broadcast only when the key table is measured small;
    otherwise a shuffle join that AQE splits when a key is skewed)."""
    return df.join(keys_with(df, key, threshold).side(), on=key, how="left_semi")


def first_ts(ts: str = "timestamp") -> Column:
    return F.get(F.col(ts), 0)


def split_cuts(n: Column) -> list[Column]:
    """Ranks at which validation and test begin among ``n`` rows: ``row = r+1``,
    ``v = int(n·0.7)``, ``t = int(n·0.8)`` in double arithmetic; train
    ``row < v``, val ``v ≤ row < t``, test ``row ≥ t``."""
    return [F.floor(n * F.lit(VAL_START)) - 1, F.floor(n * F.lit(TEST_START)) - 1]


def temporal_split(
    df: DataFrame,
    user_col: str = "userId",
    ts: str = "timestamp",
    id_col: str = "id",
    out: str = "split",
) -> DataFrame:
    """Per-user temporal split ordered by (first timestamp, id).

    Exact, and without a window over a whole user: only the two keys per user
    at which a split begins are found (``seqprep.plans.rank``), and each row is
    compared with them. A NULL user is a user; a NULL or empty timestamp comes
    first; rows with the same first timestamp and id share a split."""
    require_columns(df, [user_col, ts, id_col], "temporal_split")
    res = rank_bands(df.withColumn("_first", first_ts(ts)), [user_col], ["_first", id_col], split_cuts, out="_band")
    names = F.array(F.lit("train"), F.lit("val"), F.lit("test"))
    return res.withColumn(out, F.get(names, F.col("_band"))).drop("_first", "_band")
