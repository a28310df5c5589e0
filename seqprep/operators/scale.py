"""Per-user standardization: fit per-user mean / population std, apply by lookup.

Fit explodes the points inside the map stage and aggregates with Spark's
mergeable mean / central-moment buffers, so every task pre-aggregates before
the shuffle: a user holding a third of all points costs one small partial
per task, not one huge group. The state is one row per user.

State that grows with new data is kept as moments (count, mean, summed squared
deviations): ``fit_user_moments`` of a new batch, ``merge_user_moments`` with
the stored ones, ``user_stats`` of the result -- what a fit on everything gives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.functions.arrays import let
from seqprep.plans.rank import null_safe_join
from seqprep.plans.state import State, as_state, materialize
from seqprep.sources.io import write_scratch_table
from seqprep.sources.schema import require_columns

STD_EPS = 1e-6


def _tagger(c: str):
    return lambda x: F.struct(F.lit(c).alias("k"), x.cast("double").alias("x"))


def _standardizer(m, s):
    return lambda x: (x.cast("double") - m) / s


def fit_user_stats(df: DataFrame, columns: list[str], user_col: str = "userId") -> DataFrame:
    """One row per user: ``<col>_mean`` and ``<col>_std`` (= stddev_pop + 1e-6)
    over all points of all the user's sequences. NaN points poison the user's
    statistic for that column, as in NumPy.

    One scan, one explode of ``(column, value)`` pairs (ragged lengths are
    fine), one shuffle on the user with map-side partial aggregation."""
    require_columns(df, [user_col, *columns], "fit_user_stats")
    tagged = [
        F.transform(
            F.coalesce(F.col(c), F.array().cast(f"array<{df.schema[c].dataType.elementType.simpleString()}>")),
            _tagger(c),
        )
        for c in columns
    ]
    pts = df.select(F.col(user_col), F.explode(F.concat(*tagged)).alias("p"))
    # one pair of aggregates per (user, column), then a row per user
    each = pts.groupBy(user_col, F.col("p.k").alias("k")).agg(
        F.avg("p.x").alias("m"), (F.stddev_pop("p.x") + STD_EPS).alias("s"))
    aggs = []
    for c in columns:
        here = F.col("k") == c
        aggs += [F.max(F.when(here, F.col("m"))).alias(f"{c}_mean"), F.max(F.when(here, F.col("s"))).alias(f"{c}_std")]
    return each.groupBy(user_col).agg(*aggs)


def _row_moments(c: str) -> Column:
    """``n, mean, m2`` (summed squared deviations) of a row's points of ``c``;
    NULL points do not count, without points the mean is NULL."""
    points = F.filter(F.transform(F.col(c), lambda x: x.cast("double")), lambda x: x.isNotNull())

    def around(x, mean):
        m2 = F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
        return F.struct(F.size(x).cast("long").alias("n"), mean.alias("mean"), m2.alias("m2"))

    def moments(x):
        total = F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
        return let(F.when(F.size(x) > 0, total / F.size(x)), lambda mean: around(x, mean))

    return let(F.coalesce(points, F.array().cast("array<double>")), moments)


def fit_user_moments(df: DataFrame, columns: list[str], user_col: str = "userId") -> DataFrame:
    """One row per user: ``<col>_n``, ``<col>_mean``, ``<col>_m2`` over all points
    of the user's sequences. Points stay in their row: each row is reduced to its
    own moments first, and these are merged per user."""
    require_columns(df, [user_col, *columns], "fit_user_moments")
    rows = df.select(user_col, *[_row_moments(c).alias(c) for c in columns])
    flat = [F.col(f"{c}.{k}").alias(f"{c}_{k}") for c in columns for k in ("n", "mean", "m2")]
    return merge_user_moments(write_scratch_table(rows.select(user_col, *flat)), columns=columns, user_col=user_col)


def merge_user_moments(*parts: DataFrame, columns: list[str], user_col: str = "userId") -> DataFrame:
    """The moments of all parts together, one row per user. The common mean is
    found first, then every part adds its deviations and those of its mean from
    the common one: no difference of large sums. A NULL user is a user; a part
    without points of a column adds nothing to it."""
    rows = reduce(DataFrame.unionByName, parts)
    counts = [F.sum(f"{c}_n").alias(f"_{c}_n") for c in columns]
    means = [(F.sum(F.col(f"{c}_n") * F.col(f"{c}_mean")) / F.nullif(F.sum(f"{c}_n"), F.lit(0))).alias(f"_{c}_mean") for c in columns]
    common = materialize(rows.groupBy(user_col).agg(*counts, *means))
    joined = null_safe_join(rows, common.side(), [user_col])
    out = []
    for c in columns:
        off = F.col(f"{c}_mean") - F.col(f"_{c}_mean")
        out += [
            F.first(f"_{c}_n").alias(f"{c}_n"), F.first(f"_{c}_mean").alias(f"{c}_mean"),
            F.sum(F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_m2") + F.col(f"{c}_n") * off * off).otherwise(0.0)).alias(f"{c}_m2"),
        ]
    return joined.groupBy(user_col).agg(*out)


def user_stats(moments: DataFrame, columns: list[str], user_col: str = "userId") -> DataFrame:
    """Moments as the state of ``fit_user_stats``: ``<col>_mean``, ``<col>_std``."""
    out = []
    for c in columns:
        std = F.when(F.col(f"{c}_n") > 0, F.sqrt(F.col(f"{c}_m2") / F.col(f"{c}_n")) + STD_EPS)
        out += [F.col(f"{c}_mean"), std.alias(f"{c}_std")]
    return moments.select(user_col, *out)


def apply_user_stats(
    df: DataFrame,
    stats,
    columns: list[str],
    user_col: str = "userId",
    policy: str = "strict",
    suffix: str = "_standardized",
) -> DataFrame:
    """Add ``<col>_standardized = (x - mean) / std`` per point.

    ``policy="strict"``: a user missing from the state fails the job.
    ``policy="neutral"``: an unseen user gets mean 0 / std 1; a std that is
    not finite or at most 1e-12 becomes 1 and a mean that is not finite 0.
    The state joins as a broadcast only when its measured size allows it.
    """
    if policy not in ("strict", "neutral"):
        raise ValueError("policy must be 'strict' or 'neutral'")
    require_columns(df, [user_col, *columns], "apply_user_stats")
    st: State = as_state(stats)
    sd = st.df.select(user_col, *[F.col(f"{c}_{k}").alias(f"__{c}_{k}") for c in columns for k in ("mean", "std")])
    sd = sd.withColumn("__seen", F.lit(True))
    joined = null_safe_join(df, st.side_for(sd), [user_col], how="left")
    out = joined
    for c in columns:
        m, s = F.col(f"__{c}_mean"), F.col(f"__{c}_std")
        if policy == "neutral":
            finite_s = s.isNotNull() & ~F.isnan(s) & (F.abs(s) != float("inf")) & (s > 1e-12)
            s = F.when(finite_s, s).otherwise(F.lit(1.0))
            finite_m = m.isNotNull() & ~F.isnan(m) & (F.abs(m) != float("inf"))
            m = F.when(finite_m, m).otherwise(F.lit(0.0))
            out = out.withColumn(c + suffix, F.transform(F.col(c), _standardizer(m, s)))
        else:
            unseen = F.raise_error(
                F.concat(F.lit("user not in fitted state: "), F.col(user_col).cast("string"))
            ).cast("array<double>")
            std_col = F.transform(F.col(c), _standardizer(m, s))
            out = out.withColumn(c + suffix, F.when(F.col("__seen").isNull(), unseen).otherwise(std_col))
    return out.drop("__seen", *[f"__{c}_{k}" for c in columns for k in ("mean", "std")])
