"""Sources and sinks, each written and read back, and operators on awkward
inputs: NULL keys, repeated ids and times, times before 1970, ragged lengths."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqprep import oracle_sql as O
from seqprep.catalog import long_form, r6, register
from seqprep.operators import clean, derive, encode, inject, split, windows
from seqprep.queries.q_clean import COLS, EVD, _bounds_sql, _clean_col_sql, _dirty_full, _values_sql
from seqprep.queries.q_corrupt import _inject_sql, normal, plan_sql, u32
from seqprep.queries.q_tables import (
    _BUILD_SQL, _E1_SQL, _J4_SQL, _P3_SQL, _RAW_SQL, _W1_SQL, ENC_COLS, _encoded, _p3, _prepared, _raw_stats_sql, _standardized_sql,
)
from seqprep.sources import fixtures as fx
from seqprep.sources import io
from seqprep.sources.schema import PREPROCESSED, STANDARDIZED_COLUMNS, WORKOUT
from seqprep.streaming import stream


# ---------------------------------------------------------------- S1, S5: under the declared schema, and back

@register(
    "s5_write_schema",
    O.with_(O.EV, O.pt_type(), O.derived())
    + """SELECT id, any_value(userId) AS userId, any_value(sport) AS sport, any_value(gender) AS gender, count(*)::BIGINT AS n_points,
       round(sum(hr), 6) AS heart_rate, round(sum(dist), 6) AS derived_distance, sum(te)::BIGINT AS time_elapsed,
       round(sum(alt), 6) AS altitude FROM dp GROUP BY id""",
)
def s5_write_schema(spark, sf):
    path = io.scratch_path(spark, "workouts")
    io.write_sequences(_prepared(spark, sf), path)
    back = io.read_sequences(spark, path, WORKOUT)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return back.select(
        "id", "userId", "sport", "gender", F.size("timestamp").cast("long").alias("n_points"),
        r6(total(F.col("heart_rate"))).alias("heart_rate"), r6(total(F.col("derived_distance"))).alias("derived_distance"),
        F.aggregate("time_elapsed", F.lit(0).cast("long"), lambda a, x: a + x).alias("time_elapsed"),
        r6(total(F.col("altitude"))).alias("altitude"),
    )


# ---------------------------------------------------------------- S2: many files, one fit per file

@register(
    "s2_fit_per_file",
    O.with_(O.EV, EVD, O.pt_type("evd"), O.derived(), _values_sql("dp", "sport"), _bounds_sql("sport"))
    + 'SELECT sport AS file, "column", round(lo, 6) AS lo, round(hi, 6) AS hi, round(med, 6) AS median FROM bnd',
)
def s2_fit_per_file(spark, sf):
    path = io.scratch_path(spark, "sports")
    df = _dirty_full(spark, sf)
    io.write_partitioned(df, path, ["sport"])
    many = io.read_sequences(spark, path, df.drop("sport").schema, recursive=True, pattern="*.parquet")
    # the file of a sport is its folder: a large sport may have several parts
    many = io.with_source_file(many).withColumn("file", F.regexp_extract("source_file", "sport=([^/]*)/", 1))
    b = clean.fit_bounds(many, group_by=["file"])
    return b.select("file", "column", r6("lo").alias("lo"), r6("hi").alias("hi"), r6("median").alias("median"))


def _s2_clean_sql() -> str:
    ctes = [O.EV, EVD, O.pt_type("evd"), O.derived(), _values_sql("dp", "sport"), _bounds_sql("sport")]
    for c, v in COLS.items():
        ctes += _clean_col_sql(c, v, "dp", "bnd", "AND b.sport = s.sport")
    sel = ", ".join(f"round(o_{c}.z, 6) AS {c}" for c in COLS)
    joins = " ".join(f"JOIN o_{c} USING (id, pos)" for c in COLS)
    return O.with_(*ctes) + f"SELECT dp.sport AS file, dp.id, dp.pos, {sel}, dp.te AS time_elapsed FROM dp {joins} WHERE dp.n >= 5"


@register("s2_clean_arriving_files", _s2_clean_sql())
def s2_clean_arriving_files(spark, sf):
    """The files of some sports come first and are cleaned, each by its own
    bounds; the others come later, and the next run cleans only those."""
    df = _dirty_full(spark, sf)
    path, sink, marks = (io.scratch_path(spark, kind) for kind in ("sports", "cleaned", "marks"))
    early = F.coalesce(F.col("sport").isin("bike", "run"), F.lit(False))
    for part in (early, ~early):
        df.where(part).write.mode("append").partitionBy("sport").parquet(path)
        stream.clean_arriving_files(
            spark, f"{path}/*", df.drop("sport").schema, sink, marks, dataset="sport=([^/]*)/", out="file").awaitTermination()
    back = spark.read.parquet(sink)
    return long_form(back, ["file", "id"], {**{c: c for c in COLS}, "time_elapsed": "time_elapsed"})


# ---------------------------------------------------------------- S3: single-quoted records

@register(
    "s3_signal_json",
    O.with_(O.EV, O.pt_type(), O.seq_of(), _RAW_SQL)
    + "SELECT id, (k - 1)::BIGINT AS pos, t AS timestamp, round(v, 6) AS altitude FROM rawpt",
)
def s3_signal_json(spark, sf):
    path = io.scratch_path(spark, "signal")
    raw = fx.raw_signal(spark, sf)
    raw.select(F.translate(F.to_json(F.struct("id", "timestamp", "altitude")), '"', "'")).write.text(path)
    return long_form(io.read_signal_json(spark, path), ["id"], {"timestamp": "timestamp", "altitude": "altitude"})


# ---------------------------------------------------------------- S6: one output per sport and scale

@register(
    "s6_partitioned_outputs",
    O.with_(O.VEC, O.VEC_PT)
    + """SELECT sport, s.std_scale::DOUBLE AS std_scale, count(DISTINCT id)::BIGINT AS n_rows, count(*)::BIGINT AS n_points,
       round(sum(y), 6) AS y FROM vpt, (VALUES (2.0), (4.0), (8.0)) s(std_scale) GROUP BY sport, s.std_scale""",
)
def s6_partitioned_outputs(spark, sf):
    path = io.scratch_path(spark, "injected")
    injected = inject.inject(io.write_scratch_table(fx.seq_vec(spark, sf)), columns=["y"], seed=42)
    io.write_partitioned(injected.select("id", "sport", "std_scale", "y", "erroneous_y"), path, ["sport", "std_scale"])
    back = spark.read.parquet(path).where(F.size("y") == F.size("erroneous_y"))
    total = F.sum(F.aggregate("y", F.lit(0.0), lambda a, x: a + x))
    return back.groupBy("sport", F.col("std_scale").cast("double").alias("std_scale")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("y")).cast("long").alias("n_points"), r6(total).alias("y"))


@register(
    "s6_partitioned_values",
    _inject_sql() + "SELECT sport, std_scale::DOUBLE AS std_scale, id, pos, round(x, 6) AS y, round(e, 6) AS erroneous_y FROM inj",
)
def s6_partitioned_values(spark, sf):
    """Every point of the outputs, clean and corrupted."""
    path = io.scratch_path(spark, "injected")
    injected = inject.inject(io.write_scratch_table(fx.seq_vec(spark, sf)), columns=["y"], seed=42)
    io.write_partitioned(injected.select("id", "sport", "std_scale", "y", "erroneous_y"), path, ["sport", "std_scale"])
    back = spark.read.parquet(path).withColumn("std_scale", F.col("std_scale").cast("double"))
    return long_form(back, ["sport", "std_scale", "id"], {"y": "y", "erroneous_y": "erroneous_y"})


# ---------------------------------------------------------------- S7: fitted state, stored and loaded

@register("s7_state_round_trip", O.with_(O.EV, O.pt_day(), _P3_SQL, _W1_SQL, _E1_SQL, _J4_SQL) + "SELECT * FROM j4")
def s7_state_round_trip(spark, sf):
    labeled, state = _encoded(spark, sf)
    path = io.scratch_path(spark, "encoder")
    io.write_state(state, path)
    loaded = io.read_state(spark, path, stage="fit")
    return encode.apply_encoder(labeled, loaded, ENC_COLS).select("id", "userId_idx", "sport_idx", "gender_idx")


# ---------------------------------------------------------------- X5: SQL straight over a stored table

@register(
    "x5_sql_over_parquet",
    O.with_(O.EV, O.pt_type())
    + "SELECT id, any_value(userId) AS userId, count(*)::BIGINT AS n_points FROM pt GROUP BY id ORDER BY id LIMIT 5",
)
def x5_sql_over_parquet(spark, sf):
    path = io.scratch_path(spark, "sequences")
    fx.seq_type(spark, sf).write.parquet(path)
    return io.sql_head(spark, path, 5, order_by="id").select("id", "userId", F.size("timestamp").cast("long").alias("n_points"))


# ---------------------------------------------------------------- J5: static columns on every window

@register(
    "j5_static_windows",
    O.with_(O.EV, O.pt_type())
    + "SELECT id, pos AS t, userId, sport, gender, round(hr::FLOAT::DOUBLE, 6) AS target FROM pt",
)
def j5_static_windows(spark, sf):
    w = windows.sliding_windows(fx.seq_type(spark, sf), ["altitude"], "heart_rate", window_size=10, static_columns=ENC_COLS)
    return w.where(F.size("features") == 10).select("id", "t", *ENC_COLS, r6(F.col("target").cast("double")).alias("target"))


@register(
    "j5_static_last_record",
    O.with_(O.EV, O.pt_day(), f"""lst AS (SELECT user_id * 100 + d AS id, arg_max({O.SPORT_CASE.format(x='event_type')}, (t, e)) AS sport,
       arg_max(e, (t, e)) AS record FROM ev GROUP BY 1)""")
    + """SELECT p.id, p.pos AS t, lst.sport, lst.record, round(p.hr::FLOAT::DOUBLE, 6) AS target,
       round(sum(CASE WHEN p.pos - 9 + k.k >= 0 THEN (k.k + 1) * q.alt::FLOAT::DOUBLE ELSE 0.0 END), 4) AS altitudes
FROM pt p CROSS JOIN (SELECT unnest(range(10)) AS k) k JOIN lst ON lst.id = p.id
LEFT JOIN pt q ON q.id = p.id AND q.pos = p.pos - 9 + k.k GROUP BY p.id, p.pos, p.hr, lst.sport, lst.record""",
)
def j5_static_last_record(spark, sf):
    """One record per event; the last of a day gives the static columns of all
    windows of the day."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    sport = F.expr(O.SPORT_CASE.format(x="event_type"))
    records = events.select(
        (F.col("user_id") * 100 + F.dayofmonth("ts")).cast("long").alias("id"), sport.alias("sport"), F.col("event_id").alias("record"),
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("second"))
    days = windows.attach_static(fx.seq_day(spark, sf), records, ["sport", "record"], ["second", "record"])
    w = windows.sliding_windows(days, ["altitude"], "heart_rate", window_size=10, static_columns=["sport", "record"])
    weighted = F.aggregate(F.transform("features", lambda f, k: (k + 1) * f[0].cast("double")), F.lit(0.0), lambda a, x: a + x)
    return w.select("id", "t", "sport", "record", r6(F.col("target").cast("double")).alias("target"), F.round(weighted, 4).alias("altitudes"))


# ---------------------------------------------------------------- awkward inputs

_ODD_SQL = """odd AS (
  SELECT id // 3 AS id, CASE WHEN userId % 7 = 0 THEN NULL ELSE userId END AS userId,
         CASE WHEN id % 5 = 0 THEN NULL ELSE first_ts - 1704067200 - 1000000 END AS first_ts FROM p3)"""


@register(
    "w1_temporal_split_odd",
    O.with_(O.EV, O.pt_day(), _P3_SQL, _ODD_SQL)
    + """SELECT userId, split, count(*)::BIGINT AS n, count(first_ts)::BIGINT AS timed, sum(id)::BIGINT AS ids, sum(first_ts)::BIGINT AS times
FROM (SELECT *, CASE WHEN rk < floor(cnt*0.7::DOUBLE) THEN 'train' WHEN rk < floor(cnt*0.8::DOUBLE) THEN 'val' ELSE 'test' END AS split
      FROM (SELECT *, rank() OVER (PARTITION BY userId ORDER BY first_ts NULLS FIRST, id) AS rk,
                   count(*) OVER (PARTITION BY userId) AS cnt FROM odd))
GROUP BY userId, split""",
)
def w1_temporal_split_odd(spark, sf):
    """NULL users, repeated ids, missing and negative times: every row counts."""
    base = _p3(spark, sf).withColumn("first", F.get("timestamp", 0))
    odd = base.select(
        F.floor(F.col("id") / 3).cast("long").alias("id"), F.when(F.col("userId") % 7 != 0, F.col("userId")).alias("userId"),
        F.when(F.col("id") % 5 != 0, F.array(F.col("first") - 1704067200 - 1000000)).alias("timestamp"),
    )
    out = split.temporal_split(io.write_scratch_table(odd)).withColumn("first", F.get("timestamp", 0))
    return out.groupBy("userId", "split").agg(
        F.count(F.lit(1)).alias("n"), F.count("first").alias("timed"), F.sum("id").alias("ids"), F.sum("first").alias("times"))


@register(
    "j1_attach_repeated_ids",
    O.with_(O.EV, O.pt_type())
    + "SELECT id, pos, round(CASE WHEN pos < 2 THEN alt + 1 END, 6) AS altitude FROM pt",
)
def j1_attach_repeated_ids(spark, sf):
    """Two raw records per id: the later one, two points long, replaces the first."""
    df = fx.seq_type(spark, sf)
    ts, alt = F.col("timestamp"), F.col("altitude")
    last = df.select("id", F.slice(ts, 1, 2).alias("timestamp"), F.transform(F.slice(alt, 1, 2), lambda x: x + 1.0).alias("altitude"), F.lit(2).alias("rec"))
    raw = df.select("id", "timestamp", "altitude", F.lit(1).alias("rec")).unionByName(last)
    # times that repeat inside a sequence would tell nothing about records: make them distinct
    apart = lambda d: d.withColumn("timestamp", F.transform("timestamp", lambda t, i: t * 100_000 + i))
    out = derive.attach_signal(apart(df.drop("altitude")), apart(raw), on_missing="null", order="rec")
    return long_form(out, ["id"], {"altitude": "altitude"})


@register(
    "c1_fit_bounds_null_group",
    O.with_(O.EV, EVD, O.pt_type("evd"), O.derived(),
            "dq AS (SELECT * REPLACE (CASE WHEN sport = 'bike' THEN NULL ELSE sport END AS sport) FROM dp)",
            _values_sql("dq", "sport"), _bounds_sql("sport"))
    + 'SELECT sport, "column", round(lo, 6) AS lo, round(hi, 6) AS hi, round(med, 6) AS median FROM bnd',
)
def c1_fit_bounds_null_group(spark, sf):
    df = _dirty_full(spark, sf).withColumn("sport", F.when(F.col("sport") != "bike", F.col("sport")))
    b = clean.fit_bounds(df, group_by=["sport"])
    return b.select("sport", "column", r6("lo").alias("lo"), r6("hi").alias("hi"), r6("median").alias("median"))


# Fixed values of the injection, written out: proportions, combinations, scales.
_RAGGED_ASSIGN = f"""asg0 AS (
  SELECT id, sport, (row_number() OVER (PARTITION BY sport ORDER BY {u32(42, 'id')}, id) - 1)::BIGINT AS r,
         count(*) OVER (PARTITION BY sport) AS n FROM (SELECT DISTINCT id, sport FROM pt)),
asg1 AS (SELECT *, floor(n * 0.5::DOUBLE) AS mid FROM asg0),
asg2 AS (SELECT *, CASE WHEN r < mid THEN mid ELSE n - mid END AS m, CASE WHEN r < mid THEN r ELSE r - mid END AS q FROM asg1),
asg3 AS (SELECT *, floor(m * 0.3::DOUBLE) AS s1, floor(m * 0.6::DOUBLE) AS s2 FROM asg2),
asg AS (SELECT id, sport, CASE WHEN r < mid THEN 'constant' ELSE 'random' END AS method,
               (CASE WHEN q < s1 THEN 0.2 WHEN q < s2 THEN 0.4 ELSE 0.6 END)::DOUBLE AS fraction,
               (CASE WHEN q < s1 THEN (CASE WHEN q < floor(s1 * 0.8::DOUBLE) THEN 1 ELSE 2 END)
                     WHEN q < s2 THEN (CASE WHEN q - s1 < floor((s2 - s1) * 0.8::DOUBLE) THEN 1 ELSE 2 END)
                     WHEN q - s2 < floor((m - s2) * 0.6::DOUBLE) THEN 1 WHEN q - s2 < floor((m - s2) * 0.8::DOUBLE) THEN 2 ELSE 3 END)::INT AS k
        FROM asg3)"""
_RAGGED_COMBOS = [(0.2, 1), (0.2, 2), (0.4, 1), (0.4, 2), (0.6, 1), (0.6, 2), (0.6, 3)]


def _ragged_sql(column: str, value: str) -> str:
    name = f"'erroneous_{column}'"
    return f"""p_{column} AS (
  SELECT pt.id, pt.sport, pt.pos, pt.n AS L, asg.method, pm.S, pm.inplan, pt.{value} AS x,
         CASE WHEN pm.inplan THEN {normal(42, 'pt.id', name, 'pt.pos')} ELSE 0.0 END AS r
  FROM pt JOIN asg USING (id) LEFT JOIN pmask pm ON pm.L = pt.n AND pm.pos = pt.pos AND pm.f = asg.fraction AND pm.k = asg.k),
q_{column} AS (
  SELECT id, any_value(L) AS L, any_value(S) AS S, any_value(method) AS method, avg(x) AS mu, stddev_pop(x) AS sigma,
         CASE WHEN stddev_pop(x) = 0 THEN (CASE WHEN avg(abs(x)) > 0 THEN avg(abs(x)) ELSE 1.0 END) ELSE stddev_pop(x) END AS base,
         var_pop(r) AS varr, covar_pop(x, r) AS cov,
         any_value({u32(42, 'id', name, "'coin'")} < 2147483648) AS plus FROM p_{column} GROUP BY id),
g_{column} AS (SELECT p.id, sum(CASE WHEN inplan THEN x - q.mu ELSE 0 END) AS seg FROM p_{column} p JOIN q_{column} q USING (id) GROUP BY p.id),
m_{column} AS (
  SELECT q.id, q.method, q.S, CASE WHEN q.S IS NULL THEN 0.0 WHEN q.method = 'constant' THEN
      CASE WHEN sigma = 0 THEN base * sqrt(3.0 * L::DOUBLE * L / (S::DOUBLE * (L - S)))
           ELSE (-(2.0 / L * seg) + (CASE WHEN plus THEN 1 ELSE -1 END)
                 * sqrt((2.0 / L * seg) * (2.0 / L * seg) - 4 * (S::DOUBLE * (L - S) / (L::DOUBLE * L)) * (-3.0 * sigma * sigma)))
                / (2 * (S::DOUBLE * (L - S) / (L::DOUBLE * L))) END
    WHEN varr = 0 THEN 0.0
    ELSE (-2 * cov + (CASE WHEN plus THEN 1 ELSE -1 END) * sqrt(4 * cov * cov - 4 * varr * (-3.0 * base * base))) / (2 * varr) END AS c
  FROM q_{column} q JOIN g_{column} USING (id)),
e_{column} AS (
  SELECT p.id, p.pos, p.sport, CASE WHEN m.S IS NULL THEN p.x WHEN m.method = 'constant' THEN (CASE WHEN p.inplan THEN p.x + m.c ELSE p.x END)
         ELSE p.x + m.c * p.r END AS v FROM p_{column} p JOIN m_{column} m USING (id))"""


@register(
    "k5_inject_ragged",
    O.with_(O.EV, O.pt_type(), _RAGGED_ASSIGN, "lens AS (SELECT DISTINCT n::INT AS L FROM pt)", plan_sql("lens", _RAGGED_COMBOS, 42),
            _ragged_sql("longitude", "lon"), _ragged_sql("latitude", "lat"))
    + """SELECT a.id, a.pos, round(a.v, 6) AS erroneous_longitude, round(b.v, 6) AS erroneous_latitude
FROM e_longitude a JOIN e_latitude b ON a.id = b.id AND a.pos = b.pos""",
)
def k5_inject_ragged(spark, sf):
    """Both coordinates of sequences of every length, scale 2."""
    out = inject.inject(io.write_scratch_table(fx.seq_type(spark, sf)), std_scales=(2,), seed=42)
    return long_form(out, ["id"], {"erroneous_longitude": "erroneous_longitude", "erroneous_latitude": "erroneous_latitude"})


# ---------------------------------------------------------------- dataset export under both schemas

_EXPORT_SQL = [
    "p3a AS (SELECT * FROM p3 WHERE userId IN (SELECT userId FROM p3 GROUP BY userId HAVING count(*) >= 10))",
    _W1_SQL.replace("FROM p3))", "FROM p3a))"), _E1_SQL, _J4_SQL,
]


@register(
    "dataset_export",
    O.with_(O.EV, O.pt_day(), _P3_SQL, *_EXPORT_SQL)
    + """SELECT s.schema, w1.split, count(DISTINCT w1.id)::BIGINT AS n_rows, count(*)::BIGINT AS n_points, sum(pt.t)::BIGINT AS times,
       sum(CASE WHEN s.schema = 'preprocessed' THEN j4.userId_idx END)::BIGINT AS user_codes
FROM w1 JOIN j4 USING (id) JOIN pt ON pt.id = w1.id, (VALUES ('base'), ('preprocessed')) s(schema)
GROUP BY s.schema, w1.split""",
)
def dataset_export(spark, sf):
    """Train, validation and test tables under the base and the preprocessed
    schema, written and read back."""
    from seqprep.plans import dataset

    days = io.write_scratch_table(fx.seq_day(spark, sf))
    raw = days.select("id", "timestamp", "altitude")
    path = io.scratch_path(spark, "export")
    dataset.export(dataset.build(days.drop("altitude"), raw), path)
    parts = []
    for name, schema in (("base", WORKOUT), ("preprocessed", PREPROCESSED)):
        for part in ("train", "val", "test"):
            df = io.read_sequences(spark, f"{path}/{name}/{part}", schema)
            codes = F.col("userId_idx") if name == "preprocessed" else F.lit(None).cast("long")
            parts.append(df.select(F.lit(name).alias("schema"), F.lit(part).alias("split"), "id", "timestamp", codes.alias("code")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    n = F.size("timestamp")
    return rows.groupBy("schema", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(n).cast("long").alias("n_points"),
        F.sum(F.aggregate("timestamp", F.lit(0).cast("long"), lambda a, t: a + t)).alias("times"),
        F.sum(F.col("code") * n).alias("user_codes"))


@register(
    "dataset_export_values",
    O.with_(
        O.EV, O.pt_day(), _P3_SQL, *_BUILD_SQL[:6],
        "ptv AS (SELECT pt.* REPLACE (l.v AS alt) FROM pt JOIN w1 ON w1.id = pt.id JOIN lastv l ON l.id = pt.id AND l.t = pt.t)",
        O.derived("ptv"), "st AS (" + _raw_stats_sql("(SELECT * FROM dp WHERE id IN (SELECT id FROM w1 WHERE split = 'train'))") + ")",
        "z AS (" + _standardized_sql("st", "dp", neutral=False) + ")",
    )
    + """SELECT w1.split, z.*, round(dp.alt, 6) AS altitude, j4.userId_idx, j4.sport_idx, j4.gender_idx
FROM z JOIN dp USING (id, pos) JOIN w1 USING (id) JOIN j4 USING (id)""",
)
def dataset_export_values(spark, sf):
    """Every point of the three tables under the preprocessed schema, as written."""
    from seqprep.plans import dataset

    days = io.write_scratch_table(fx.seq_day(spark, sf))
    ts, alt = F.col("timestamp"), F.col("altitude")
    raw = days.select("id", F.concat(ts, F.array(ts[0])).alias("timestamp"), F.concat(alt, F.array(alt[0] + 1000.0)).alias("altitude"))
    path = io.scratch_path(spark, "export")
    dataset.export(dataset.build(days.drop("altitude"), raw), path)
    parts = [io.read_sequences(spark, f"{path}/preprocessed/{part}", PREPROCESSED).withColumn("split", F.lit(part)) for part in ("train", "val", "test")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    values = {f"{c}_standardized": f"{c}_standardized" for c in STANDARDIZED_COLUMNS} | {"altitude": "altitude"}
    return long_form(rows, ["split", "id", *[f"{c}_idx" for c in ENC_COLS]], values)
