"""Length validation and coercion of sequence columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqprep.functions.arrays import seq_len
from seqprep.functions import sqlx as S


def valid_lengths(df: DataFrame, seq_cols: list[str], ts: str = "timestamp", min_len: int = 5) -> Column:
    """True when ``timestamp`` has at least ``min_len`` points and every
    sequence column has exactly as many (NULL counts as length 0)."""
    n = seq_len(F.col(ts))
    ok = n >= min_len
    for c in seq_cols:
        ok = ok & (seq_len(F.col(c)) == n)
    return ok


def filter_valid_lengths(df: DataFrame, seq_cols: list[str], ts: str = "timestamp", min_len: int = 5,
                         drop: bool = True, flag: str | None = None) -> DataFrame:
    v = valid_lengths(df, seq_cols, ts, min_len)
    if flag:
        df = df.withColumn(flag, v)
    return df.where(v) if drop else df


def _element(dtype: T.DataType) -> str:
    return dtype.elementType.simpleString() if isinstance(dtype, T.ArrayType) else "double"


def coerce_float(seq: str, dtype: T.DataType) -> Column:
    """Float sequence: NULL elements become NaN, numeric strings are parsed,
    one unparsable element empties the whole sequence, ±inf becomes NaN.
    A NULL sequence becomes empty. ``seq`` names the column."""
    return F.expr(S.coerce_float(seq, _element(dtype)))


def coerce_int(seq: str, dtype: T.DataType) -> Column:
    """Integer sequence: floats truncate toward zero; any NULL, NaN or ±inf
    empties the whole sequence (NumPy raises on them and the reference
    falls back to an empty list). A NULL sequence becomes empty."""
    return F.expr(S.coerce_int(seq, _element(dtype)))
