"""Stratified error injection and its audit.

Per dataset (a sport) the rows are put in a seeded shuffle order; the first
half gets constant noise, the rest random noise. Inside each half: 30 % /
30 % / 40 % get segment fraction 0.2 / 0.4 / 0.6; inside 0.2 and 0.4, 80 %
one segment and 20 % two; inside 0.6, 60 % / 20 % / 20 % one, two, three
segments. Every cut is ``int()`` of a double product, by position.

The assignment is a pure function of (rank, n) per dataset, found with
``rank_bands`` (13 cut keys per dataset that rows are compared with; no window
over a whole dataset, no shuffle of the wide rows); all 14 (method, fraction, k) groups are then corrupted in one pass:
each row computes its own plan, so lengths may differ, and the method selects the constant or random expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.operators.corrupt import (
    _check_args,
    _coin,
    _pop_std,
    constant_array,
    mask_sql,
    noise_array,
    plan_sql,
    random_array,
)
from seqprep.operators.sample import with_shuffle_band

# Injection proportions.
P_CONSTANT = 0.5
CONFIG_FRACTIONS = [0.2, 0.4, 0.6]
SCALES = [2, 4, 8]
COMBOS = [(0.2, 1), (0.2, 2), (0.4, 1), (0.4, 2), (0.6, 1), (0.6, 2), (0.6, 3)]


def injection_cuts(n: Column) -> list[Column]:
    """Ranks at which the 14 (method, fraction, segments) groups after the
    first begin, in the order of ``COMBOS``, constant noise first."""
    mid = F.floor(n * F.lit(P_CONSTANT))
    cuts = []
    for base, m in ((F.lit(0).cast("long"), mid), (mid, n - mid)):
        s1, s2 = F.floor(m * F.lit(0.3)), F.floor(m * F.lit(0.3 + 0.3))
        third = m - s2
        cuts += [base] if cuts else []
        cuts += [base + F.floor(s1 * F.lit(0.8)), base + s1, base + s1 + F.floor((s2 - s1) * F.lit(0.8)), base + s2,
                 base + s2 + F.floor(third * F.lit(0.6)), base + s2 + F.floor(third * F.lit(0.8))]
    return cuts


def assign_injection(df: DataFrame, seed: int = 42, dataset_cols: Sequence[str] = ("sport",), id_col: str = "id",
                     out: str = "assignment") -> DataFrame:
    """``out``: the row's (method, fraction, k) by its rank in the seeded
    shuffle of its dataset (a NULL dataset is one). Rows that repeat an id get
    the same assignment."""
    groups = F.array(*[
        F.struct(F.lit(m).alias("method"), F.lit(f).alias("fraction"), F.lit(k).alias("k"))
        for m in ("constant", "random") for f, k in COMBOS
    ])
    banded = with_shuffle_band(df, seed, injection_cuts, key=id_col, group_cols=list(dataset_cols), out="_band")
    return banded.withColumn(out, F.get(groups, F.col("_band"))).drop("_band")


def inject(
    df: DataFrame,
    std_scales: Sequence[float] = tuple(SCALES),
    columns: Sequence[str] = ("longitude", "latitude"),
    seed: int = 42,
    dataset_cols: Sequence[str] = ("sport",),
    id_col: str = "id",
    prefix: str = "erroneous_",
) -> DataFrame:
    """Copy ``columns`` to ``erroneous_<col>`` and corrupt the copies for each
    scale; the result has one row per (input row, scale) with ``std_scale``
    and the assignment columns, computed once and shared by all scales. A
    sequence too short for its plan keeps its values."""
    for s in std_scales:
        _check_args(df, columns, s)
    a = assign_injection(df, seed, dataset_cols, id_col)
    a = a.select("*", F.col("assignment.method").alias("method"), F.col("assignment.fraction").alias("fraction"),
                 F.col("assignment.k").alias("num_segments")).drop("assignment")
    a = a.withColumn("_L", F.size(F.col(columns[0])).cast("int"))
    a = a.withColumn("_plan", F.expr(plan_sql("_L", "fraction", "num_segments", seed)))
    a = a.withColumn("_mask", F.expr(mask_sql("_plan", "_L"))).withColumn("_S", F.col("_plan.S"))
    # noise is drawn once per row and column, and only where it is used; the
    # scales are generated in the same pass (one scan of the input)
    a = a.withColumns({
        f"_R_{c}": F.when(F.col("method") == "random", noise_array(id_col, prefix + c, seed, "_mask")) for c in columns
    })
    a = a.withColumn("std_scale", F.explode(F.array(*[F.lit(float(s)) for s in std_scales])))
    outs = {}
    for c in columns:
        x = f"CAST({c} AS ARRAY<DOUBLE>)"
        coin = _coin(seed, id_col, prefix + c)
        const = constant_array(x, "_mask", "_L", "_S", "std_scale", coin)
        rand = random_array(x, f"_R_{c}", "std_scale", coin)
        same = F.coalesce(F.size(F.col(c)) == F.col("_L"), F.lit(False))
        differs = F.raise_error(F.lit(f"'{c}' and '{columns[0]}' differ in length")).cast("array<double>")
        outs[prefix + c] = F.when(F.col("_plan").isNull(), F.expr(x)).when(~same, differs).when(F.col("method") == "constant", const).otherwise(rand)
    a = a.withColumns(outs)
    return a.drop("_L", "_S", "_plan", "_mask", *[f"_R_{c}" for c in columns])


def audit(df: DataFrame, columns: Sequence[str] = ("longitude",), prefix: str = "erroneous_",
          group_cols: Sequence[str] = ("sport", "std_scale"), tol: float = 1e-4) -> DataFrame:
    """Check every row (not only the first): the erroneous column exists, its
    length matches, and ``|std(err)/std(orig) − scale| < tol`` (ratio 0 when
    the original std is 0). One row per group."""
    for c in columns:
        if prefix + c not in df.columns:
            raise ValueError(f"missing column {prefix + c}")
    out = df
    aggs = []
    for c in columns:
        o, e = F.col(c).cast("array<double>"), F.col(prefix + c).cast("array<double>")
        out = out.withColumn(f"_so_{c}", _pop_std(o)).withColumn(f"_se_{c}", _pop_std(e))
        ratio = F.when(F.col(f"_so_{c}") > 0, F.col(f"_se_{c}") / F.col(f"_so_{c}")).otherwise(F.lit(0.0))
        out = out.withColumn(f"_ratio_{c}", ratio)
        ok = (F.size(o) == F.size(e)) & (F.abs(F.col(f"_ratio_{c}") - F.col("std_scale")) < tol)
        aggs += [
            F.count_if(ok).cast("long").alias(f"n_ok_{c}"),
            F.min(f"_ratio_{c}").alias(f"min_ratio_{c}"),
            F.max(f"_ratio_{c}").alias(f"max_ratio_{c}"),
        ]
    return out.groupBy(*group_cols).agg(F.count(F.lit(1)).cast("long").alias("n"), *aggs)


__all__ = ["assign_injection", "inject", "audit", "injection_cuts"]
