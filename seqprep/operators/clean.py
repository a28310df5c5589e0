"""Generic fit/transform sequence cleaner.

Per float sequence, in order: coerce (NULL/NaN/±inf → missing, unparsable →
empty) → linear interpolation → all-missing sequences take the column median
(0.0 when there is none) → clip to fitted quantile bounds → rolling median
(window 3) on the smoothing columns. Integer sequences are coerced, then the
elapsed time is repaired. Rows whose lengths do not validate are dropped.

``fit`` produces a small bounds table ``(group…, column, lo, hi, median)``
over the finite points, exact and distributed (``plans.quantiles``);
``transform`` joins it (broadcast when measured small) and stays a chain of
array expressions -- each stage in its own projection so no stage is
recomputed by the next one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from seqprep.functions import sqlx as S
from seqprep.functions.arrays import interpolate, rolling_median
from seqprep.functions.missing import is_finite
from seqprep.operators.derive import repair_time_elapsed
from seqprep.operators.validate import coerce_float, coerce_int, valid_lengths
from seqprep.plans.quantiles import exact_quantiles
from seqprep.plans.rank import null_safe_join
from seqprep.plans.state import State, as_state
from seqprep.sources.schema import FLOAT_SEQUENCES, INT_SEQUENCES, require_columns

# Default smoothing columns and cleaner settings.
SMOOTH_COLS_DEFAULT = ["heart_rate", "derived_speed", "altitude"]


@dataclass(frozen=True)
class CleaningConfig:
    seq_float_cols: list[str] = field(default_factory=lambda: list(FLOAT_SEQUENCES))
    seq_int_cols: list[str] = field(default_factory=lambda: list(INT_SEQUENCES))
    drop_invalid_length_rows: bool = True
    min_seq_len: int = 5
    impute: bool = True
    clip: bool = True
    clip_q_low: float = 0.005
    clip_q_high: float = 0.995
    smooth: bool = True
    smooth_window: int = 3
    smooth_cols: list[str] | None = None

    def smoothing(self) -> list[str]:
        if self.smooth_cols is not None:
            return list(self.smooth_cols)
        return [c for c in SMOOTH_COLS_DEFAULT if c in self.seq_float_cols]


def _required(cfg: CleaningConfig) -> list[str]:
    return ["id", *cfg.seq_int_cols, *cfg.seq_float_cols]


def fit_bounds(df: DataFrame, config: CleaningConfig | None = None, group_by: list[str] | None = None) -> DataFrame:
    """Bounds per (group, column): quantiles ``clip_q_low``/``clip_q_high`` and
    the median of all finite points; a column without finite points gets
    ``(-inf, inf)`` and median NaN. A NULL group key is a group."""
    cfg = config or CleaningConfig()
    require_columns(df, _required(cfg), "fit_bounds")
    g = list(group_by or [])
    tagged = [
        F.transform(
            F.coalesce(coerce_float(c, df.schema[c].dataType), F.array().cast("array<double>")),
            _tag(c),
        )
        for c in cfg.seq_float_cols
    ]
    pts = df.select(*g, F.explode(F.concat(*tagged)).alias("p")).select(
        *g, F.col("p.k").alias("column"), F.col("p.x").alias("x")
    ).where(is_finite(F.col("x")))
    q = exact_quantiles(pts, [*g, "column"], "x", [cfg.clip_q_low, cfg.clip_q_high, 0.5])
    names = F.explode(F.array(*[F.lit(c) for c in cfg.seq_float_cols])).alias("column")
    keys = df.select(*g).distinct().select(*g, names) if g else df.sparkSession.range(1).select(names)
    res = null_safe_join(keys, q, [*g, "column"], how="left")
    return res.select(
        *g,
        "column",
        F.coalesce(F.col("q0"), F.lit(float("-inf"))).alias("lo"),
        F.coalesce(F.col("q1"), F.lit(float("inf"))).alias("hi"),
        F.coalesce(F.col("q2"), F.lit(float("nan"))).alias("median"),
    )


def _tag(c: str):
    return lambda x: F.struct(F.lit(c).alias("k"), x.alias("x"))


def clip_value(x, lo, hi):
    """``np.clip`` that keeps NaN (``least``/``greatest`` would hide it)."""
    return F.when(F.isnan(x), x).when(x < lo, lo).when(x > hi, hi).otherwise(x)


def clean(
    df: DataFrame,
    bounds,
    config: CleaningConfig | None = None,
    group_by: list[str] | None = None,
    valid_flag: str | None = None,
) -> DataFrame:
    """Apply a fitted cleaner (see module doc)."""
    cfg = config or CleaningConfig()
    require_columns(df, _required(cfg), "clean")
    if bounds is None:
        raise RuntimeError("clean() needs the bounds that fit_bounds() returns")
    g = list(group_by or [])
    st: State = as_state(bounds)

    valid = valid_lengths(df, cfg.seq_float_cols + cfg.seq_int_cols, "timestamp", cfg.min_seq_len)
    out = df.withColumn("_valid", valid)
    if cfg.drop_invalid_length_rows:
        out = out.where(F.col("_valid"))

    # bounds as one row per group with lo/hi/median columns per sequence column
    wide = st.df.groupBy(*g).agg(
        *[
            F.first(F.when(F.col("column") == c, F.struct("lo", "hi", "median")), ignorenulls=True).alias(f"_b_{c}")
            for c in cfg.seq_float_cols
        ]
    ) if g else st.df.agg(
        *[
            F.first(F.when(F.col("column") == c, F.struct("lo", "hi", "median")), ignorenulls=True).alias(f"_b_{c}")
            for c in cfg.seq_float_cols
        ]
    )
    if g:
        out = null_safe_join(out, st.side_for(wide), g, how="left")
    else:  # one bounds row for the whole table: one scalar subquery, no join
        allb = wide.select(F.struct(*[f"_b_{c}" for c in cfg.seq_float_cols]).alias("b")).scalar()
        out = out.withColumns({f"_b_{c}": allb[f"_b_{c}"] for c in cfg.seq_float_cols})

    # one projection per stage (each stage reads the previous one's columns)
    smooth = set(cfg.smoothing()) if cfg.smooth else set()
    floats = cfg.seq_float_cols
    out = out.withColumns({c: coerce_float(c, df.schema[c].dataType) for c in floats})
    if cfg.impute:
        out = out.withColumns({c: interpolate(c) for c in floats})
    out = out.withColumns({c: F.expr(S.fill_and_clip(c, f"_b_{c}", cfg.clip)) for c in floats})
    if smooth:
        out = out.withColumns({c: rolling_median(c, cfg.smooth_window) for c in floats if c in smooth})
    out = out.withColumns({c: coerce_int(c, df.schema[c].dataType) for c in cfg.seq_int_cols})
    if "time_elapsed" in out.columns and "timestamp" in out.columns:
        out = repair_time_elapsed(out)
    out = out.drop(*[f"_b_{c}" for c in cfg.seq_float_cols])
    if valid_flag:
        return out.withColumnRenamed("_valid", valid_flag)
    return out.drop("_valid")


def clip(df: DataFrame, bounds, columns: list[str], group_by: list[str] | None = None) -> DataFrame:
    """Clip canonical sequences (missing → NaN, NaN kept) to fitted bounds."""
    g = list(group_by or [])
    st: State = as_state(bounds)
    aggs = [F.first(F.when(F.col("column") == c, F.struct("lo", "hi")), ignorenulls=True).alias(f"_b_{c}")
            for c in columns]
    if g:
        out = null_safe_join(df, st.side_for(st.df.groupBy(*g).agg(*aggs)), g, how="left")
    else:
        wide = st.df.agg(*aggs)
        allb = wide.select(F.struct(*[f"_b_{c}" for c in columns]).alias("b")).scalar()
        out = df.withColumns({f"_b_{c}": allb[f"_b_{c}"] for c in columns})
    out = out.withColumns({c: F.expr(_clip_sql(c, f"_b_{c}")) for c in columns})
    return out.drop(*[f"_b_{c}" for c in columns])


def _clip_sql(c: str, bounds: str) -> str:
    x = S.var("x")
    return f"transform({S.canonical(c)}, {x} -> {S.clip_value(x, bounds + '.lo', bounds + '.hi')})"


def fit_transform(df: DataFrame, config: CleaningConfig | None = None, fit_on: DataFrame | None = None,
                  group_by: list[str] | None = None) -> DataFrame:
    """Fit on ``fit_on`` (default: the table itself), then clean ``df``."""
    bounds = fit_bounds(fit_on if fit_on is not None else df, config, group_by)
    return clean(df, bounds, config, group_by)


def clean_report(df: DataFrame, config: CleaningConfig | None = None) -> DataFrame:
    """Rows kept and dropped by the length validation: ``(valid, n)``."""
    cfg = config or CleaningConfig()
    v = valid_lengths(df, cfg.seq_float_cols + cfg.seq_int_cols, "timestamp", cfg.min_seq_len)
    return df.groupBy(v.alias("valid")).agg(F.count(F.lit(1)).cast("long").alias("n"))


def clean_observed(df: DataFrame, bounds, config: CleaningConfig | None = None, group_by: list[str] | None = None,
                   name: str = "cleaned") -> tuple[DataFrame, Observation]:
    """``clean`` with its report as metrics of the same pass: after the first
    action on the result, e.g. its write, ``observation.get`` holds the rows
    ``kept`` and ``dropped`` by the length validation. No scan is added."""
    cfg = config or CleaningConfig()
    observation = Observation(name)
    v = F.coalesce(valid_lengths(df, cfg.seq_float_cols + cfg.seq_int_cols, "timestamp", cfg.min_seq_len), F.lit(False))
    counted = df.observe(observation, F.count_if(v).alias("kept"), F.count_if(~v).alias("dropped"))
    return clean(counted, bounds, config, group_by), observation
