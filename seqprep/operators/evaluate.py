"""Scoring windows, regrouping predictions, and error metrics per variant."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqprep.functions.arrays import let
from seqprep.operators import windows
from seqprep.sources.schema import require_columns


def lagged_mean_scorer(features: Column) -> Column:
    """Default scorer: mean of the last feature (the lagged target input)
    over the window, as a double."""
    last = F.transform(features, lambda step: F.element_at(step, -1).cast("double"))
    return F.aggregate(last, F.lit(0.0), lambda a, x: a + x) / F.size(last)


def score_windows(windows: DataFrame, scorer: Callable[[Column], Column] = lagged_mean_scorer,
                  out: str = "prediction") -> DataFrame:
    """Apply a column scorer to every window row (runs where the row is)."""
    return windows.withColumn(out, scorer(F.col("features")))


def score_windows_pandas(windows: DataFrame, predict: Callable, out: str = "prediction") -> DataFrame:
    """Apply a Python batch predictor (``pandas.DataFrame -> Series``) with
    ``mapInPandas``: Arrow batches per partition, for models that are not
    column expressions."""
    schema = T.StructType([*windows.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: predict(pdf).astype("float64")})

    return windows.mapInPandas(run, schema)


def regroup(pred: DataFrame, id_col: str = "id", t_col: str = "t", value: str = "prediction",
            out: str = "predicted_heart_rate") -> DataFrame:
    """Back to one array per sequence, ordered by time step (shuffle on id;
    a group is one sequence, bounded by its length)."""
    g = pred.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(F.col(t_col), F.col(value)))).alias("_s"))
    return g.select(id_col, F.transform("_s", lambda s: s[value]).alias(out))


def metrics(df: DataFrame, true_col: str = "heart_rate", pred_col: str = "predicted_heart_rate",
            skip_first: bool = True, group_cols: list[str] | None = None) -> DataFrame:
    """MAE, RMSE and point count (NaN, NaN, 0 when there is no point)."""
    g = list(group_cols or [])
    yt, yp = F.col(true_col).cast("array<double>"), F.col(pred_col).cast("array<double>")
    n = F.least(F.size(yt), F.size(yp))
    start = 2 if skip_first else 1
    # rows with n <= 1 contribute an empty slice; no row filter, so Catalyst has
    # no predicate to push below (and re-evaluate) the prediction expression
    ln = F.when(n > 1, n - start + 1).otherwise(F.lit(0))
    z = F.arrays_zip(F.slice(yt, start, ln).alias("t"), F.slice(yp, start, ln).alias("p"))
    pts = df.select(*g, F.explode(z).alias("_z"))
    d = F.col("_z.t") - F.col("_z.p")
    agg = pts.groupBy(*g).agg(
        F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"), F.count(F.lit(1)).cast("long").alias("n_points")
    )
    if g:
        return agg
    empty = df.sparkSession.range(1).select(F.lit(float("nan")).alias("mae"), F.lit(float("nan")).alias("rmse"),
                                            F.lit(0).cast("long").alias("n_points"))
    return agg.unionByName(empty).groupBy().agg(
        F.max(F.when(F.col("n_points") > 0, F.col("mae"))).alias("mae"),
        F.max(F.when(F.col("n_points") > 0, F.col("rmse"))).alias("rmse"),
        F.max("n_points").alias("n_points"),
    ).select(F.coalesce("mae", F.lit(float("nan"))).alias("mae"), F.coalesce("rmse", F.lit(float("nan"))).alias("rmse"),
             "n_points")


def variant_metrics(variants: dict[str, DataFrame], true_col: str = "heart_rate",
                    pred_col: str = "predicted_heart_rate", skip_first: bool = True) -> DataFrame:
    """Stack the variants with a name column and compute the metrics per
    variant in one aggregation, sorted by name."""
    parts = [v.select(F.lit(k).alias("variant"), F.col(true_col), F.col(pred_col)) for k, v in variants.items()]
    allv = parts[0]
    for p in parts[1:]:
        allv = allv.unionByName(p)
    return metrics(allv, true_col, pred_col, skip_first, ["variant"]).orderBy("variant")


def lagged_mean(col: str, window_size: int = 10) -> Column:
    """Per time step the mean of the ``window_size`` values before it (zeros
    before the start, values as 32-bit floats, as in the window rows)."""
    w = window_size
    padded = F.concat(F.array_repeat(F.lit(0.0), w), F.transform(F.col(col), lambda v: v.cast("float").cast("double")))
    return let(padded, lambda p: F.transform(
        F.sequence(F.lit(1), F.size(p) - w), lambda t: F.aggregate(F.slice(p, t, w), F.lit(0.0), lambda a, x: a + x) / w,
    ))


def fit_lagged_scorer(df: DataFrame, input_column: str, target_column: str, window_size: int = 10) -> DataFrame:
    """One row ``slope, intercept``: least squares of the target on the lagged
    mean of the input over all points of ``df`` (one partial aggregation)."""
    x = F.when(F.size(input_column) > 0, lagged_mean(input_column, window_size))
    points = df.select(F.explode(F.arrays_zip(x.alias("x"), F.col(target_column).alias("y"))).alias("p"))
    return points.agg(F.regr_slope("p.y", "p.x").alias("slope"), F.regr_intercept("p.y", "p.x").alias("intercept"))


def predict_lagged(df: DataFrame, scorer: DataFrame, input_column: str, window_size: int = 10,
                   out: str = "predicted_heart_rate") -> DataFrame:
    """Score every time step in its row with a fitted lagged scorer."""
    fitted = scorer.select(F.struct("slope", "intercept").alias("m")).scalar()
    scored = df.withColumn("_m", fitted).withColumn("_x", F.when(F.size(input_column) > 0, lagged_mean(input_column, window_size)))
    line = F.transform("_x", lambda x: F.col("_m.intercept") + F.col("_m.slope") * x)
    return scored.withColumn(out, F.coalesce(line, F.array().cast("array<double>"))).drop("_m", "_x")


def score_sequences(df: DataFrame, predict: Callable, numerical_columns: Sequence[str], heartrate_input_column: str | None = None,
                    window_size: int = 10, out: str = "predicted_heart_rate", static_columns: Sequence[str] = ()) -> DataFrame:
    """Add ``out``: the predictions of a Python model for every time step of each
    row's sequences. ``predict`` takes ``[n, window, F]`` 32-bit floats (as
    ``sliding_windows`` has them) and gives ``n`` numbers; with ``static_columns``
    it also takes the row's values of these, ``[n, S]``. Whole sequences go to
    the worker and come back, so nothing is exploded, shuffled or regrouped."""
    names = [*numerical_columns, *([heartrate_input_column] if heartrate_input_column else [])]
    require_columns(df, [*names, *static_columns], "score_sequences")
    schema = T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, T.ArrayType(T.DoubleType()))])
    sent = df.select(*[f.name for f in schema.fields if f.name in df.columns and f.name != out])

    def run(batches):
        for batch in batches:
            sizes = windows.list_sizes(batch.column(names[0]))
            row_of, static = np.repeat(np.arange(len(sizes)), sizes), windows.static_values(batch, static_columns)
            scores = np.zeros(int(sizes.sum()))
            for here, features in windows.window_blocks(batch, numerical_columns, heartrate_input_column, window_size):
                given = (features, static[row_of[here]]) if static_columns else (features,)
                scores[here] = np.asarray(predict(*given), np.float64)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, out])

    return sent.mapInArrow(run, schema)


def window_gram(df: DataFrame, numerical_columns: Sequence[str], target_column: str, heartrate_input_column: str | None = None,
                window_size: int = 10, static_columns: Sequence[str] = ()) -> DataFrame:
    """``i, j, total``: the sums over all windows of the products of their
    columns -- the flattened features, the row's static values, a 1 and the
    target (last). A worker
    reduces a batch of whole sequences to one matrix, and the matrices are
    summed by a partial aggregation: what is shuffled depends on the number of
    features only. Points whose target is missing are left out."""
    names = [*numerical_columns, *([heartrate_input_column] if heartrate_input_column else [])]
    require_columns(df, [*names, target_column, *static_columns], "window_gram")
    side = len(names) * window_size + len(static_columns) + 2

    def run(batches):
        for batch in batches:
            y = batch.column(target_column).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float32)
            sizes = windows.list_sizes(batch.column(names[0]))
            row_of, static = np.repeat(np.arange(len(sizes)), sizes), windows.static_values(batch, static_columns)
            total = np.zeros((side, side))
            for here, features in windows.window_blocks(batch, numerical_columns, heartrate_input_column, window_size):
                flat = features.reshape(len(features), -1)
                rows = np.column_stack((flat, static[row_of[here]], np.ones(len(flat)), y[here])).astype(np.float64)
                rows = rows[~np.isnan(rows[:, -1])]
                total += rows.T @ rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(side), side)), pa.array(np.tile(np.arange(side), side)), pa.array(total.ravel())],
                names=["i", "j", "part"])

    kept = dict.fromkeys([*names, target_column, *static_columns])
    return df.select(*kept).mapInArrow(run, "i long, j long, part double").groupBy("i", "j").agg(F.sum("part").alias("total"))


def fit_regressor(df: DataFrame, numerical_columns: Sequence[str], target_column: str, heartrate_input_column: str | None = None,
                  window_size: int = 10, reg_param: float = 0.001, static_columns: Sequence[str] = ()) -> DataFrame:
    """Linear regression on whole windows: ``feature, coefficient``, the feature
    numbered step by step as in the flattened window, then the static columns, the
    intercept last. It
    minimizes the mean squared error plus ``reg_param`` times the squared
    coefficients (not the intercept) by its normal equations. The summed matrix
    has as many rows as there are features, whatever the data; it is solved on
    the driver. Without windows there are no rows."""
    cells = window_gram(df, numerical_columns, target_column, heartrate_input_column, window_size, static_columns).collect()
    schema = "feature long, coefficient double"
    side = max((c["i"] for c in cells), default=1) + 1
    gram = np.zeros((side, side))
    for c in cells:
        gram[c["i"], c["j"]] = c["total"]
    n = gram[-2, -2]
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    penalty = np.diag([reg_param] * (side - 2) + [0.0])
    solved = np.linalg.solve(gram[:-1, :-1] / n + penalty, gram[:-1, -1] / n)
    return df.sparkSession.createDataFrame([(i, float(v)) for i, v in enumerate(solved)], schema)


def predict_regressor(df: DataFrame, coefficients: DataFrame, numerical_columns: Sequence[str], heartrate_input_column: str | None = None,
                      window_size: int = 10, static_columns: Sequence[str] = (), out: str = "predicted_heart_rate") -> DataFrame:
    """Score every time step with the coefficients of ``fit_regressor`` (as many
    as features, sent with the tasks). Without coefficients the scores are NaN."""
    fitted = {r["feature"]: r["coefficient"] for r in coefficients.collect()}
    static = len(static_columns)
    size = (len(numerical_columns) + bool(heartrate_input_column)) * window_size
    weights = np.array([fitted.get(i, np.nan) for i in range(size + static + 1)])

    def line(features, *values):
        score = features.reshape(len(features), -1).astype(np.float64) @ weights[:size] + weights[-1]
        return score + values[0] @ weights[size:-1] if static else score

    return score_sequences(df, line, numerical_columns, heartrate_input_column, window_size, out, static_columns)
