"""Composed flows: prepare a dataset, build variants, score and compare them.

Each step is an operator from ``seqprep.operators``; fitted state (scaler,
encoder, cleaner bounds) is fitted once on the training rows and applied to
every variant by lookup joins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.functions.missing import is_finite
from seqprep.operators import clean, corrupt, derive, encode, evaluate, scale, split, validate
from seqprep.plans.state import State, materialize
from seqprep.sources.io import write_scratch_table
from seqprep.sources.schema import STANDARDIZED_COLUMNS, require_columns

ENCODED = ["userId", "sport", "gender"]
NUMERICAL = [f"{c}_standardized" for c in ["time_elapsed", "altitude", "derived_speed", "derived_distance"]]
HEARTRATE_INPUT, HEARTRATE_OUTPUT = "heart_rate_standardized", "heart_rate"
CODES = [f"{c}_idx" for c in ENCODED]
UNSEEN = -1  # code of a value that the train rows do not hold


@dataclass
class Fitted:
    scaler: State
    encoder: State
    scorer: State  # slope and intercept on the lagged heart rate, or the coefficients of the whole input


def prepare_base(df: DataFrame, min_len: int = 5) -> DataFrame:
    """Elapsed time, length validation, derived distance and speed."""
    df = derive.with_time_elapsed(df)
    df = validate.filter_valid_lengths(df, ["heart_rate", "latitude", "longitude", "altitude"], min_len=min_len)
    return derive.derive_features(df)


def fit_state(base: DataFrame) -> Fitted:
    """Temporal split per user; scaler, encoder and scorer fitted on the train rows."""
    train = split.temporal_split(base).where(F.col("split") == "train")
    sc = materialize(scale.fit_user_stats(train, STANDARDIZED_COLUMNS))
    en = materialize(encode.fit_encoder(train, ENCODED))
    known = scale.apply_user_stats(train, sc, [HEARTRATE_OUTPUT], policy="neutral")
    return Fitted(sc, en, materialize(evaluate.fit_lagged_scorer(known, HEARTRATE_INPUT, HEARTRATE_OUTPUT)))


def preprocess(df: DataFrame, fitted: Fitted, rederive: bool = True) -> DataFrame:
    """Re-derive distance/speed (as the reference does, which overwrites any
    change made to speed), standardize with the neutral policy, encode, and
    check the model contract."""
    if rederive:
        df = derive.derive_features(df)
    df = scale.apply_user_stats(df, fitted.scaler, STANDARDIZED_COLUMNS, policy="neutral")
    df = encode.apply_encoder(df, fitted.encoder, ENCODED)
    require_columns(df, [*NUMERICAL, HEARTRATE_INPUT, HEARTRATE_OUTPUT, "id", *[f"{c}_idx" for c in ENCODED]], "model contract")
    return df


def predict(df: DataFrame, fitted: Fitted, window_size: int = 10) -> DataFrame:
    """Score each time step from the lagged standardized heart rate, in its row:
    no window rows, no regroup shuffle, no join back. Python models go through
    ``windows.sliding_windows`` + ``evaluate.score_windows_pandas`` instead."""
    return evaluate.predict_lagged(df, fitted.scorer.df, HEARTRATE_INPUT, window_size)


def model_input(df: DataFrame) -> DataFrame:
    """The columns a model takes, without gaps: a standardized point that is
    missing or infinite is 0, its user's mean, and an unseen category ``UNSEEN``."""
    def known(c):
        return F.transform(c, lambda x: F.when(is_finite(x), x).otherwise(0.0)).alias(c)

    codes = [F.coalesce(F.col(c), F.lit(UNSEEN).cast("long")).alias(c) for c in CODES]
    return df.select("id", HEARTRATE_OUTPUT, *[known(c) for c in [*NUMERICAL, HEARTRATE_INPUT]], *codes)


def fit_full_state(base: DataFrame, window_size: int = 10, reg_param: float = 0.001) -> Fitted:
    """As ``fit_state``, with a linear model on the whole input: windows of the
    four standardized sequences and the lagged heart rate, and the codes of user,
    sport and gender."""
    train = split.temporal_split(base).where(F.col("split") == "train")
    sc = materialize(scale.fit_user_stats(train, STANDARDIZED_COLUMNS))
    en = materialize(encode.fit_encoder(train, ENCODED))
    known = model_input(preprocess(train, Fitted(sc, en, None), rederive=False))
    model = evaluate.fit_regressor(known, NUMERICAL, HEARTRATE_OUTPUT, HEARTRATE_INPUT, window_size, reg_param, CODES)
    return Fitted(sc, en, materialize(model))


def predict_full(df: DataFrame, fitted: Fitted, window_size: int = 10) -> DataFrame:
    """Score each time step from the whole input; whole sequences go through the
    Python worker, no window rows and no shuffle."""
    return evaluate.predict_regressor(model_input(df), fitted.scorer.df, NUMERICAL, HEARTRATE_INPUT, window_size, CODES)


def build_variants(base: DataFrame, std_scale: float = 2.0, seed: int = 42) -> dict[str, DataFrame]:
    """baseline, corrupted (random noise on heart rate, speed, altitude), cleaned.
    The corrupted table feeds three passes (bounds fit, cleaning, scoring), so
    it is written once as a table instead of being recomputed."""
    corrupted = write_scratch_table(corrupt.corrupt(base, method="random", std_scale=std_scale, seed=seed))
    cleaned = clean.fit_transform(corrupted)
    return {"baseline": base, "corrupted": corrupted, "cleaned": cleaned}


def compare_variants(raw: DataFrame, std_scale: float = 2.0, seed: int = 42, fit: Callable[[DataFrame], Fitted] = fit_state,
                     score: Callable[[DataFrame, Fitted], DataFrame] = predict) -> DataFrame:
    """MAE / RMSE / points per variant, sorted by variant name. ``fit_full_state``
    and ``predict_full`` score with the whole model input."""
    base = write_scratch_table(prepare_base(raw))  # read by every later pass
    fitted = fit(base)
    scored = {k: score(preprocess(v, fitted), fitted) for k, v in build_variants(base, std_scale, seed).items()}
    return evaluate.variant_metrics(scored)
