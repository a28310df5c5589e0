"""Sequence tables derived from the driver's test tables.

No test table holds workouts, so these builders turn the ``events`` and
``embeddings`` tables into "one row per sequence" tables with the workout
columns. Everything is a Spark job over the whole input: a shuffle on the
sequence key gathers the points of each sequence, ordered by (t, event_id).

The same tables are rebuilt in SQL by ``seqprep.oracle_sql`` so that every
query has an independent value oracle. Rules are listed in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Event type codes used in the sequence id.
EVENT_CODES = {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}
# Raw sport name given to a sequence by its first event type.
SPORT_OF_EVENT = {"signup": "bike", "purchase": "run", "click": "walk", "view": "hiking", "error": "kayaking"}
# Gender by user_id % 3.
GENDER_OF_MOD = {0: "male", 1: "female", 2: "unknown"}
# Consolidated sport of an embedding row by label % 3.
VEC_SPORT_OF_MOD = {0: "biking", 1: "running", 2: "walking"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(col: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return out


def epoch_seconds(ts_col: str, dtype: T.DataType) -> Column:
    """Whole epoch seconds of a timestamp column, independent of the session
    time zone for ``timestamp_ntz`` (the type Spark gives Parquet
    ``timestamp[us]``)."""
    ts = F.col(ts_col)
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(ts)
    return (
        F.unix_date(ts.cast("date")).cast("long") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    ).cast("long")


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with the point columns t, lat, lon, hr, alt."""
    ev = read_table(spark, sf_dir, "events")
    ts_type = ev.schema["ts"].dataType
    e = F.col("event_id")
    return ev.select(
        e.alias("e"),
        F.col("user_id"),
        F.col("event_type"),
        F.dayofmonth("ts").cast("long").alias("d"),
        epoch_seconds("ts", ts_type).alias("t"),
        (F.lit(40.0) + (e * 7919 % 10000) / F.lit(100000.0)).alias("lat"),
        (F.lit(10.0) + (e * 104729 % 10000) / F.lit(100000.0)).alias("lon"),
        (F.lit(60.0) + (e * 31 % 120)).cast("double").alias("hr"),
        F.col("value").cast("double").alias("alt"),
    )


_POINT_FIELDS = ["t", "e", "event_type", "lat", "lon", "hr", "alt"]


def _gather(points: DataFrame, keys: list[str]) -> DataFrame:
    """Points of each sequence, ordered by (t, e), as one array of structs."""
    return points.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*_POINT_FIELDS))).alias("p")
    )


def _sequence_columns() -> list[Column]:
    p = F.col("p")
    return [
        F.transform(p, lambda s: s["t"]).alias("timestamp"),
        F.transform(p, lambda s: s["e"]).alias("eid"),
        F.transform(p, lambda s: s["hr"]).alias("heart_rate"),
        F.transform(p, lambda s: s["lon"]).alias("longitude"),
        F.transform(p, lambda s: s["lat"]).alias("latitude"),
        F.transform(p, lambda s: s["alt"]).alias("altitude"),
    ]


def _static_columns() -> list[Column]:
    return [
        F.col("user_id").alias("userId"),
        _case(F.col("p")[0]["event_type"], SPORT_OF_EVENT).alias("sport"),
        _case(F.col("user_id") % 3, GENDER_OF_MOD).alias("gender"),
    ]


def seq_type(spark: SparkSession, sf_dir: str, points: DataFrame | None = None) -> DataFrame:
    """One sequence per (user, event type); id = user_id*10 + type code."""
    pts = points if points is not None else event_points(spark, sf_dir)
    g = _gather(pts, ["user_id", "event_type"])
    code = _case(F.col("event_type"), EVENT_CODES).cast("long")
    return g.select((F.col("user_id") * 10 + code).alias("id"), *_static_columns(), *_sequence_columns())


def seq_day(spark: SparkSession, sf_dir: str, points: DataFrame | None = None) -> DataFrame:
    """One sequence per (user, day of month); id = user_id*100 + day."""
    pts = points if points is not None else event_points(spark, sf_dir)
    g = _gather(pts, ["user_id", "d"])
    return g.select((F.col("user_id") * 100 + F.col("d")).alias("id"), *_static_columns(), *_sequence_columns())


def seq_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fixed-length sequence per embedding row; the signal is ``y``."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("userId"),
        _case(F.col("label") % 3, VEC_SPORT_OF_MOD).alias("sport"),
        F.transform("embedding", lambda x: x.cast("double")).alias("y"),
    )


# --------------------------------------------------------------------------
# variants (deterministic, mirrored in SQL)
# --------------------------------------------------------------------------

def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq_type`` with heart rate NULL when e%11=0, NaN when e%13=0,
    +inf when e%17=0 (first match wins)."""
    pts = event_points(spark, sf_dir)
    e = F.col("e")
    hr = (
        F.when(e % 11 == 0, F.lit(None).cast("double"))
        .when(e % 13 == 0, F.lit(float("nan")))
        .when(e % 17 == 0, F.lit(float("inf")))
        .otherwise(F.col("hr"))
    )
    return seq_type(spark, sf_dir, pts.withColumn("hr", hr))


def dirty_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq_type`` with altitude one point short when id%7=0."""
    df = seq_type(spark, sf_dir)
    alt = F.col("altitude")
    return df.withColumn(
        "altitude", F.when(F.col("id") % 7 == 0, F.slice(alt, 1, F.size(alt) - 1)).otherwise(alt)
    )


def tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq_type`` with t cut to the day (point order unchanged)."""
    df = seq_type(spark, sf_dir)
    return df.withColumn("timestamp", F.transform("timestamp", lambda t: t - t % 86400))


def raw_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw altitude records: the timestamps of each ``seq_type`` row plus a
    repeat of the first one, whose altitude is ``alt[0] + 1000`` (so the
    last-wins rule is visible)."""
    df = seq_type(spark, sf_dir)
    ts, alt = F.col("timestamp"), F.col("altitude")
    return df.select(
        "id",
        F.concat(ts, F.array(ts[0])).alias("timestamp"),
        F.concat(alt, F.array(alt[0] + 1000.0)).alias("altitude"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq_type`` with a prediction ``hr + e%7 - 3``."""
    df = seq_type(spark, sf_dir)
    pred = F.transform(
        F.arrays_zip(F.col("heart_rate").alias("h"), F.col("eid").alias("e")),
        lambda z: z["h"] + (z["e"] % 7).cast("double") - 3.0,
    )
    return df.withColumn("predicted_heart_rate", pred)


def rounded(spark: SparkSession, sf_dir: str, shift_only: bool = False) -> DataFrame:
    """``seq_type`` with lat/lon shifted by sqrt(e+2)/1e6, then rounded to 3
    decimals when e%10=0 (``shift_only`` skips the rounding)."""
    pts = event_points(spark, sf_dir)
    e = F.col("e")
    shift = F.sqrt((e + 2).cast("double")) / 1e6
    lat = F.col("lat") + shift
    lon = F.col("lon") + shift
    if not shift_only:
        lat = F.when(e % 10 == 0, F.round(lat, 3)).otherwise(lat)
        lon = F.when(e % 10 == 0, F.round(lon, 3)).otherwise(lon)
    return seq_type(spark, sf_dir, pts.withColumn("lat", lat).withColumn("lon", lon))


def spiky(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq_vec`` with +3.0 on the points where (id·7 + pos) % 29 < 2, which
    makes runs of two adjacent spikes."""
    df = seq_vec(spark, sf_dir)
    ident = F.col("id")
    return df.withColumn(
        "y", F.transform("y", lambda v, i: F.when((ident * 7 + i) % 29 < 2, v + 3.0).otherwise(v))
    )
