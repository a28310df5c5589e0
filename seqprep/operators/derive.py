"""Per-sequence derivations: elapsed time, step distance and speed, and
attaching a signal by (id, timestamp)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.functions.arrays import EMPTY_DOUBLE, let, positions, seq_len
from seqprep.functions.geo import haversine_km
from seqprep.functions.missing import NAN, NEG_INF, POS_INF
from seqprep.sources.schema import require_columns


def time_elapsed(ts: Column) -> Column:
    """Seconds since the first point: ``ts[i] - ts[0]`` (closed form of a
    zero-filled diff followed by a running sum)."""
    return let(ts, lambda t: F.when(seq_len(t) == 0, t).otherwise(F.transform(t, lambda x: x - t[0])))


def with_time_elapsed(df: DataFrame, ts: str = "timestamp", out: str = "time_elapsed") -> DataFrame:
    return df.withColumn(out, time_elapsed(F.col(ts)))


def repair_time_elapsed(df: DataFrame, ts: str = "timestamp", te: str = "time_elapsed") -> DataFrame:
    """Recompute elapsed time only where it is empty or not as long as the
    timestamps; an empty timestamp gives an empty result."""
    t, e = F.col(ts), F.col(te)
    needs = (seq_len(e) == 0) | (seq_len(e) != seq_len(t))
    fixed = F.when(seq_len(t) == 0, F.array().cast("array<long>")).otherwise(time_elapsed(t))
    return df.withColumn(te, F.when(needs, fixed).otherwise(e))


def step_distance(lat: Column, lon: Column) -> Column:
    """Distance in km from the previous point; 0.0 at the first point.
    An empty sequence gives an empty result."""

    def steps(a, o):
        return F.when(seq_len(a) == 0, EMPTY_DOUBLE()).otherwise(
            F.transform(positions(a), lambda i: F.when(i == 0, F.lit(0.0)).otherwise(haversine_km(a[i - 1], o[i - 1], a[i], o[i])))
        )

    return let(lat, lambda a: let(lon, lambda o: steps(a, o)))


def step_speed(dist: Column, ts: Column) -> Column:
    """Speed in km/h = distance / Δt · 3600 with Δt held as a float32.

    The first Δt is 1e-6 (so the first speed is 0). A zero Δt gives +inf for a
    positive distance and NaN for a zero or NaN distance (the ANSI division
    would throw, so the case is written out)."""
    first_dt = F.lit(1e-6).cast("float").cast("double")

    def one(t):
        def speed(d, i):
            dt = F.when(i == 0, first_dt).otherwise((t[i] - t[i - 1]).cast("float").cast("double"))
            at_zero = F.when(F.isnan(d) | (d == 0), NAN()).when(d > 0, POS_INF()).otherwise(NEG_INF())
            return F.when(dt == 0, at_zero).otherwise(d / dt * 3600)

        return speed

    return let(ts, lambda t: F.transform(dist, one(t)))


def derive_features(
    df: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    ts: str = "timestamp",
    distance: str = "derived_distance",
    speed: str = "derived_speed",
) -> DataFrame:
    """Add (or overwrite) step distance and speed. Distance is staged in its
    own projection so speed reads it instead of recomputing it."""
    require_columns(df, [lat, lon, ts], "derive_features")
    with_d = df.withColumn(distance, step_distance(F.col(lat), F.col(lon)))
    return with_d.withColumn(speed, step_speed(F.col(distance), F.col(ts)))


# --------------------------------------------------------------------------
# attach a signal by (id, timestamp)
# --------------------------------------------------------------------------

def signal_points(raw: DataFrame, id_col: str = "id", ts: str = "timestamp", value: str = "altitude",
                  order: str | None = None) -> DataFrame:
    """Turn raw records ``(id, timestamp[], value[])`` into one list ``s`` of
    ``(t, v)`` per id, sorted by distinct times.

    Lists are zipped to the shorter length. Of records that repeat an id, the
    last by ``order`` (default: the reader's ``_rec``, if present) replaces the
    earlier ones; without an order a repeated id fails the job. A timestamp
    repeated inside a record keeps its last value. One record per id is
    shuffled, picked by a partial aggregation; the rest stays in the row."""
    order = order or ("_rec" if "_rec" in raw.columns else None)
    t, v = F.col(ts), F.col(value)
    zipped = F.slice(F.arrays_zip(t.alias("t"), v.alias("v")), 1, F.least(F.size(t), F.size(v)))
    records = raw.select(F.col(id_col).alias("id"), (F.col(order) if order else F.lit(0)).alias("_o"), zipped.alias("z"))
    per_id = records.groupBy("id").agg(F.max_by("z", "_o").alias("z"), F.count(F.lit(1)).alias("_n"))
    z = F.col("z") if order else F.when(F.col("_n") == 1, F.col("z")).otherwise(
        F.raise_error(F.concat(F.lit("several raw records for id "), F.col("id").cast("string"), F.lit(" and no order column")))
        .cast(records.schema["z"].dataType))
    # points by (time, position); of equal times the last stays
    points = F.array_sort(F.filter(F.transform(z, lambda p, i: F.struct(p["t"].alias("t"), i.alias("i"), p["v"].alias("v"))),
                                   lambda e: e["t"].isNotNull()))
    last = let(points, lambda es: F.filter(
        es, lambda e, i: F.when(i == F.size(es) - 1, F.lit(True)).otherwise(es[i + 1]["t"] != e["t"])))
    return per_id.select("id", F.transform(last, lambda e: F.struct(e["t"].alias("t"), e["v"].alias("v"))).alias("s"))


def attach_signal(
    df: DataFrame,
    raw: DataFrame,
    out: str = "altitude",
    id_col: str = "id",
    ts: str = "timestamp",
    raw_value: str = "altitude",
    on_missing: str = "error",
    order: str | None = None,
) -> DataFrame:
    """Attach a raw signal to each point of ``df`` by (id, timestamp[i]).

    ``on_missing="error"`` fails the job when an id or a timestamp has no
    raw value (the reference raises); ``"null"`` leaves a NULL point.
    Both inputs are shuffled on id once. In the row the two time lists are
    merged by one sort: the raw points before the k-th wanted one at place i
    are i - k, so the last of them is looked up by number.
    """
    if on_missing not in ("error", "null"):
        raise ValueError("on_missing must be 'error' or 'null'")
    signal = signal_points(raw, id_col=id_col, ts=ts, value=raw_value, order=order)
    joined = df.join(signal.withColumnRenamed("id", id_col), on=id_col, how="left")
    time_type = signal.schema["s"].dataType.elementType["t"].dataType
    key = F.col(id_col).cast("string")

    def value(found, t):
        if on_missing == "null":
            return F.when(found.isNotNull(), found["v"].cast("double"))
        missing = F.raise_error(F.concat(F.lit("no raw signal for id "), key, F.lit(" at timestamp "), t.cast("string")))
        return F.when(found.isNotNull(), found["v"].cast("double")).otherwise(missing.cast("double"))

    def merged(raw_points, times):
        wanted = F.transform(times, lambda t, i: F.struct(t.cast(time_type).alias("t"), F.lit(1).alias("side"), i.alias("at")))
        known = F.transform(raw_points, lambda p, i: F.struct(p["t"].alias("t"), F.lit(0).alias("side"), i.alias("at")))
        placed = F.transform(F.array_sort(F.concat(known, wanted)), lambda e, i: F.struct(e["t"].alias("t"), e["side"].alias("side"), e["at"].alias("at"), i.alias("i")))

        def point(e, k):
            last = F.get(raw_points, e["i"] - k - 1)
            return F.struct(e["at"].alias("at"), e["t"].alias("t"), F.when(last["t"] == e["t"], last).alias("found"))

        # back in the order of the row's own points
        hits = F.array_sort(F.transform(F.filter(placed, lambda e: e["side"] == 1), point))
        return F.transform(hits, lambda h: value(h["found"], h["t"]))

    none = F.array().cast(signal.schema["s"].dataType)
    attached = let(F.coalesce("s", none), lambda s: let(F.col(ts), lambda t: F.when(t.isNotNull(), merged(s, t))))
    return joined.withColumn(out, attached).drop("s")


def semi_by_id(raw: DataFrame, target: DataFrame, id_col: str = "id") -> DataFrame:
    """Keep raw rows whose id exists in the target set (left semi join)."""
    return raw.join(target.select(id_col), on=id_col, how="left_semi")


def source_projection(raw: DataFrame) -> DataFrame:
    """Select and rename the source record fields (``tar_heart_rate`` → ``heart_rate``)."""
    rename = {"tar_heart_rate": "heart_rate"}
    keep = ["id", "userId", "sport", "gender", "timestamp", "tar_heart_rate", "heart_rate", "longitude", "latitude"]
    cols = [F.col(c).alias(rename.get(c, c)) for c in keep if c in raw.columns]
    return raw.select(*cols)
