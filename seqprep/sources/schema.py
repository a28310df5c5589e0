"""Declared schemas of sequence tables and the checks that go with them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

L = T.LongType()
D = T.DoubleType()
S = T.StringType()

# The workout schema (one row per workout, parallel sequences).
WORKOUT = T.StructType(
    [
        T.StructField("id", L),
        T.StructField("userId", L),
        T.StructField("sport", S),
        T.StructField("gender", S),
        T.StructField("timestamp", T.ArrayType(L)),
        T.StructField("heart_rate", T.ArrayType(D)),
        T.StructField("longitude", T.ArrayType(D)),
        T.StructField("latitude", T.ArrayType(D)),
        T.StructField("derived_speed", T.ArrayType(D)),
        T.StructField("derived_distance", T.ArrayType(D)),
        T.StructField("time_elapsed", T.ArrayType(L)),
        T.StructField("altitude", T.ArrayType(D)),
    ]
)

STANDARDIZED_COLUMNS = ["time_elapsed", "heart_rate", "altitude", "derived_speed", "derived_distance"]
ENCODED_COLUMNS = ["userId", "sport", "gender"]

PREPROCESSED = T.StructType(
    list(WORKOUT.fields)
    + [T.StructField(f"{c}_standardized", T.ArrayType(D)) for c in STANDARDIZED_COLUMNS]
    + [T.StructField(f"{c}_idx", L) for c in ENCODED_COLUMNS]
)

INJECTED = T.StructType(
    list(WORKOUT.fields)
    + [T.StructField("erroneous_longitude", T.ArrayType(D)), T.StructField("erroneous_latitude", T.ArrayType(D))]
)

# The sequence columns, in their order.
FLOAT_SEQUENCES = ["derived_speed", "heart_rate", "longitude", "latitude", "derived_distance", "altitude"]
INT_SEQUENCES = ["timestamp", "time_elapsed"]


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    """Raise ``ValueError`` naming every missing column (plan-time check, no job)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns in {what}: {missing}")


def require_array_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Each column must exist and hold arrays (checked from the schema)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    for c in columns:
        if c not in fields:
            raise ValueError(f"Column '{c}' not found")
        if not isinstance(fields[c], T.ArrayType):
            raise ValueError(f"Column '{c}' must contain arrays, found {fields[c].simpleString()}")


def conform(df: DataFrame, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """Cast and select to a declared schema; a missing column is an error, none
    is made up. ``keep`` names extra columns to carry (e.g. partition columns)."""
    require_columns(df, [*schema.fieldNames(), *(keep or [])], "the declared schema")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *(keep or []))
