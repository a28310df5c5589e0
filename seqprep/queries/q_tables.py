"""Queries over whole tables: read/derive/split/scale/encode operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqprep import oracle_sql as O
from seqprep.catalog import long_form, r6, register
from seqprep.operators import derive, encode, scale, split
from seqprep.sources import fixtures as fx
from seqprep.sources import io
from seqprep.sources.buckets import read_bucketed
from seqprep.sources.io import read_sequences, scratch_path, write_scratch_table, write_sequences
from seqprep.sources.schema import STANDARDIZED_COLUMNS

ENC_COLS = ["userId", "sport", "gender"]


def _prepared(spark, sf):
    """seq_type with elapsed time and derived distance/speed."""
    return derive.derive_features(derive.with_time_elapsed(fx.seq_type(spark, sf)))


# ---------------------------------------------------------------- S1, S4, P1

@register(
    "s1_read_sequences",
    O.with_(O.EV, O.pt_type())
    + """SELECT id, any_value(userId) AS userId, any_value(sport) AS sport, any_value(gender) AS gender,
       count(*)::BIGINT AS n_points, min(t) AS first_ts, max(t) AS last_ts
FROM pt GROUP BY id""",
)
def s1_read_sequences(spark, sf):
    path = scratch_path(spark, "workouts")
    write_sequences(_prepared(spark, sf), path)
    df = read_sequences(spark, path)
    return df.select(
        "id", "userId", "sport", "gender",
        F.size("timestamp").cast("long").alias("n_points"),
        F.col("timestamp")[0].alias("first_ts"),
        F.element_at("timestamp", -1).alias("last_ts"),
    )


@register("s4_source_projection", O.with_(O.EV, O.pt_type()) + "SELECT id, pos, round(hr, 6) AS heart_rate FROM pt")
def s4_source_projection(spark, sf):
    raw = fx.seq_type(spark, sf).withColumnRenamed("heart_rate", "tar_heart_rate")
    return long_form(derive.source_projection(raw), ["id"], {"heart_rate": "heart_rate"})


@register(
    "p1_projection",
    O.with_(O.EV, O.pt_type(), O.derived())
    + """SELECT id, pos, te AS time_elapsed, round(hr,6) AS heart_rate, round(speed,6) AS derived_speed,
       round(dist,6) AS derived_distance, round(alt,6) AS altitude FROM dp""",
)
def p1_projection(spark, sf):
    df = _prepared(spark, sf).select(
        "id", "time_elapsed", "heart_rate", "derived_speed", "derived_distance", "altitude"
    )
    return long_form(
        df, ["id"],
        {c: c for c in ["time_elapsed", "heart_rate", "derived_speed", "derived_distance", "altitude"]},
    )


# ---------------------------------------------------------------- P7, D1–D3

@register("p7_time_elapsed", O.with_(O.EV, O.pt_type(), O.derived()) + "SELECT id, pos, te AS time_elapsed FROM dp")
def p7_time_elapsed(spark, sf):
    return long_form(derive.with_time_elapsed(fx.seq_type(spark, sf)), ["id"], {"time_elapsed": "time_elapsed"})


@register(
    "d1_step_distance",
    O.with_(O.EV, O.pt_type(), O.derived()) + "SELECT id, pos, round(dist, 6) AS derived_distance FROM dp",
)
def d1_step_distance(spark, sf):
    df = fx.seq_type(spark, sf)
    df = df.withColumn("derived_distance", derive.step_distance(F.col("latitude"), F.col("longitude")))
    return long_form(df, ["id"], {"derived_distance": "derived_distance"})


@register(
    "d2_step_speed",
    O.with_(O.EV, O.pt_type(), "ptt AS (SELECT * REPLACE (t - t % 86400 AS t) FROM pt)", O.derived("ptt"))
    + "SELECT id, pos, round(speed, 6) AS derived_speed FROM dp",
)
def d2_step_speed(spark, sf):
    df = derive.derive_features(fx.tied(spark, sf))
    return long_form(df, ["id"], {"derived_speed": "derived_speed"})


@register(
    "d3_derive_features",
    O.with_(O.EV, O.pt_type(), O.derived())
    + "SELECT id, pos, round(dist, 6) AS derived_distance, round(speed, 6) AS derived_speed FROM dp",
)
def d3_derive_features(spark, sf):
    df = derive.derive_features(fx.seq_type(spark, sf))
    return long_form(df, ["id"], {"derived_distance": "derived_distance", "derived_speed": "derived_speed"})


# ---------------------------------------------------------------- A1, J3

_STAT_SRC = {"time_elapsed": "te", "heart_rate": "hr", "altitude": "alt", "derived_speed": "speed",
             "derived_distance": "dist"}


def _stats_sql(src: str = "dp") -> str:
    cols = ", ".join(
        f"round(avg({v}), 6) AS {c}_mean, round(stddev_pop({v}) + 1e-6, 6) AS {c}_std" for c, v in _STAT_SRC.items()
    )
    return f"SELECT userId, {cols} FROM {src} GROUP BY userId"


@register("a1_user_stats", O.with_(O.EV, O.pt_type(), O.derived()) + _stats_sql())
def a1_user_stats(spark, sf):
    st = scale.fit_user_stats(_prepared(spark, sf), STANDARDIZED_COLUMNS)
    return st.select("userId", *[r6(c).alias(c) for c in st.columns if c != "userId"])


@register("a1_user_stats_merged", O.with_(O.EV, O.pt_type(), O.derived()) + _stats_sql())
def a1_user_stats_merged(spark, sf):
    """The moments of the sequences that begin in the first half of the time
    span, stored, then merged with those of the later ones and stored again."""
    df = write_scratch_table(_prepared(spark, sf)).withColumn("begins", F.get("timestamp", 0))
    half = df.agg((F.min("begins") + F.max("begins")) / 2).scalar()
    path = io.scratch_path(spark, "moments")
    cols = STANDARDIZED_COLUMNS
    io.write_state(scale.fit_user_moments(df.where(F.col("begins") <= half), cols), path)
    later = scale.fit_user_moments(df.where(F.col("begins") > half), cols)
    io.write_state(scale.merge_user_moments(io.read_state(spark, path), later, columns=cols), path)
    st = scale.user_stats(io.read_state(spark, path), cols)
    return st.select("userId", *[r6(c).alias(c) for c in st.columns if c != "userId"])


def _standardized_sql(stats_src: str, points_src: str, neutral: bool) -> str:
    sel = []
    for c, v in _STAT_SRC.items():
        m, s = f"s.{c}_mean", f"s.{c}_std"
        if neutral:
            m = f"CASE WHEN {m} IS NULL OR isnan({m}) OR isinf({m}) THEN 0.0 ELSE {m} END"
            s = f"CASE WHEN {s} IS NULL OR isnan({s}) OR isinf({s}) OR {s} <= 1e-12 THEN 1.0 ELSE {s} END"
        sel.append(f"round((p.{v} - ({m})) / ({s}), 6) AS {c}_standardized")
    return f"SELECT p.id, p.pos, {', '.join(sel)} FROM {points_src} p LEFT JOIN {stats_src} s USING (userId)"


def _raw_stats_sql(src: str) -> str:
    cols = ", ".join(
        f"avg({v}) AS {c}_mean, stddev_pop({v}) + 1e-6 AS {c}_std" for c, v in _STAT_SRC.items()
    )
    return f"SELECT userId, {cols} FROM {src} GROUP BY userId"


@register(
    "j3_scale_strict",
    O.with_(O.EV, O.pt_type(), O.derived(), f"st AS ({_raw_stats_sql('dp')})")
    + _standardized_sql("st", "dp", neutral=False),
)
def j3_scale_strict(spark, sf):
    df = _prepared(spark, sf)
    st = scale.fit_user_stats(df, STANDARDIZED_COLUMNS)
    out = scale.apply_user_stats(df, st, STANDARDIZED_COLUMNS, policy="strict")
    return long_form(out, ["id"], {f"{c}_standardized": f"{c}_standardized" for c in STANDARDIZED_COLUMNS})


_SPLIT_SQL = """sp AS (
  SELECT id, userId,
    CASE WHEN rn < floor(cnt*0.7::DOUBLE) THEN 'train' WHEN rn < floor(cnt*0.8::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT id, userId, row_number() OVER (PARTITION BY userId ORDER BY first_ts, id) AS rn,
               count(*) OVER (PARTITION BY userId) AS cnt
        FROM (SELECT id, any_value(userId) AS userId, min(t) AS first_ts FROM {pt} GROUP BY id)))"""


@register(
    "j3_scale_neutral",
    O.with_(O.EV, O.pt_type(), O.derived(), _SPLIT_SQL.format(pt="pt"),
            f"st AS ({_raw_stats_sql('(SELECT * FROM dp WHERE id IN (SELECT id FROM sp WHERE split = ' + chr(39) + 'train' + chr(39) + '))')})")
    + _standardized_sql("st", "dp", neutral=True),
)
def j3_scale_neutral(spark, sf):
    df = write_scratch_table(_prepared(spark, sf))
    labeled = split.temporal_split(df)
    train = labeled.where(F.col("split") == "train")
    st = scale.fit_user_stats(train, STANDARDIZED_COLUMNS)
    out = scale.apply_user_stats(labeled, st, STANDARDIZED_COLUMNS, policy="neutral")
    return long_form(out, ["id"], {f"{c}_standardized": f"{c}_standardized" for c in STANDARDIZED_COLUMNS})


# ---------------------------------------------------------------- J1, J2

_RAW_SQL = """raw AS (
  SELECT id, list_concat(timestamp, [timestamp[1]]) AS ts, list_concat(altitude, [altitude[1] + 1000]) AS al FROM seq),
rawpt AS (
  SELECT id, unnest(ts[1:least(len(ts), len(al))]) AS t,
         unnest(al[1:least(len(ts), len(al))]) AS v,
         generate_subscripts(ts[1:least(len(ts), len(al))], 1) AS k FROM raw),
lastv AS (SELECT id, t, arg_max(v, k) AS v FROM rawpt GROUP BY id, t)"""


@register(
    "j1_attach_signal",
    O.with_(O.EV, O.pt_type(), O.seq_of(), _RAW_SQL)
    + "SELECT p.id, p.pos, round(l.v, 6) AS altitude FROM pt p JOIN lastv l ON p.id = l.id AND p.t = l.t",
)
def j1_attach_signal(spark, sf):
    target = fx.seq_type(spark, sf).drop("altitude")
    raw = fx.raw_signal(spark, sf)
    out = derive.attach_signal(target, raw, out="altitude", on_missing="error")
    return long_form(out, ["id"], {"altitude": "altitude"})


@register(
    "j2_semi_id",
    O.with_(O.EV, O.pt_type(), O.seq_of(), _RAW_SQL)
    + "SELECT id, len(ts)::BIGINT AS n_points FROM raw WHERE id IN (SELECT id FROM pt WHERE sport <> 'kayaking')",
)
def j2_semi_id(spark, sf):
    raw = fx.raw_signal(spark, sf)
    target = split.consolidate(fx.seq_type(spark, sf))
    kept = derive.semi_by_id(raw, target)
    return kept.select("id", F.size("timestamp").cast("long").alias("n_points"))


# ---------------------------------------------------------------- P3, A3, W1

_P3_SQL = """sday AS (
  SELECT id, any_value(userId) AS userId, any_value(gender) AS gender, min(t) AS first_ts,
         CASE any_value(sport) WHEN 'bike' THEN 'biking' WHEN 'run' THEN 'running' WHEN 'walk' THEN 'walking'
              WHEN 'orienteering' THEN 'walking' WHEN 'hiking' THEN 'walking' WHEN 'fitness walking' THEN 'walking' END AS sport
  FROM pt GROUP BY id),
p3 AS (SELECT * FROM sday WHERE sport IS NOT NULL)"""


def _p3(spark, sf):
    return split.consolidate(fx.seq_day(spark, sf))


@register("p3_consolidate_category", O.with_(O.EV, O.pt_day(), _P3_SQL) + "SELECT id, userId, sport FROM p3")
def p3_consolidate_category(spark, sf):
    return _p3(spark, sf).select("id", "userId", "sport")


@register(
    "a3_min_count",
    O.with_(O.EV, O.pt_day(), _P3_SQL)
    + "SELECT id, userId FROM p3 WHERE userId IN (SELECT userId FROM p3 GROUP BY userId HAVING count(*) >= 20)",
)
def a3_min_count(spark, sf):
    return split.min_count(_p3(spark, sf), "userId", 20).select("id", "userId")


_W1_SQL = """w1 AS (
  SELECT id, userId, sport, gender, first_ts,
    CASE WHEN rn < floor(cnt*0.7::DOUBLE) THEN 'train' WHEN rn < floor(cnt*0.8::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY first_ts, id) AS rn,
               count(*) OVER (PARTITION BY userId) AS cnt FROM p3))"""


@register("w1_temporal_split", O.with_(O.EV, O.pt_day(), _P3_SQL, _W1_SQL) + "SELECT id, userId, split FROM w1")
def w1_temporal_split(spark, sf):
    return split.temporal_split(write_scratch_table(_p3(spark, sf))).select("id", "userId", "split")


# ---------------------------------------------------------------- E1, J4, A4, O2

_E1_SQL = """tr AS (SELECT * FROM w1 WHERE split = 'train'),
cats AS (
  SELECT 'userId' AS "column", userId::VARCHAR AS value, min((first_ts, userId, id)) AS k FROM tr GROUP BY 2
  UNION ALL SELECT 'sport', sport, min((first_ts, userId, id)) FROM tr GROUP BY 2
  UNION ALL SELECT 'gender', gender, min((first_ts, userId, id)) FROM tr GROUP BY 2),
enc AS (SELECT "column", value, (row_number() OVER (PARTITION BY "column" ORDER BY k) - 1)::BIGINT AS idx FROM cats)"""


def _encoded(spark, sf):
    # several passes (split bands, encoder fit, apply): read the input as a table
    labeled = split.temporal_split(write_scratch_table(_p3(spark, sf)))
    train = labeled.where(F.col("split") == "train")
    state = encode.fit_encoder(train, ENC_COLS)
    return labeled, state


@register("e1_fit_encoder", O.with_(O.EV, O.pt_day(), _P3_SQL, _W1_SQL, _E1_SQL) + 'SELECT "column", value, idx FROM enc')
def e1_fit_encoder(spark, sf):
    return _encoded(spark, sf)[1]


_J4_SQL = """j4 AS (
  SELECT w1.id, u.idx AS userId_idx, s.idx AS sport_idx, g.idx AS gender_idx
  FROM w1
  LEFT JOIN (SELECT value, idx FROM enc WHERE "column" = 'userId') u ON w1.userId::VARCHAR = u.value
  LEFT JOIN (SELECT value, idx FROM enc WHERE "column" = 'sport') s ON w1.sport IS NOT DISTINCT FROM s.value
  LEFT JOIN (SELECT value, idx FROM enc WHERE "column" = 'gender') g ON w1.gender IS NOT DISTINCT FROM g.value)"""


@register("j4_encode", O.with_(O.EV, O.pt_day(), _P3_SQL, _W1_SQL, _E1_SQL, _J4_SQL) + "SELECT * FROM j4")
def j4_encode(spark, sf):
    labeled, state = _encoded(spark, sf)
    return encode.apply_encoder(labeled, state, ENC_COLS).select("id", "userId_idx", "sport_idx", "gender_idx")


@register(
    "a4_nunique",
    O.with_(O.EV, O.pt_day(), _P3_SQL, _W1_SQL, _E1_SQL, _J4_SQL)
    + """SELECT count(DISTINCT userId_idx)::BIGINT AS n_userId_idx, count(DISTINCT sport_idx)::BIGINT AS n_sport_idx,
       count(DISTINCT gender_idx)::BIGINT AS n_gender_idx FROM j4""",
)
def a4_nunique(spark, sf):
    labeled, state = _encoded(spark, sf)
    enc = encode.apply_encoder(labeled, state, ENC_COLS)
    return encode.nunique(enc, ["userId_idx", "sport_idx", "gender_idx"])


@register(
    "o2_head",
    O.with_(O.EV, O.pt_type())
    + "SELECT id, any_value(userId) AS userId, count(*)::BIGINT AS n_points FROM pt GROUP BY id ORDER BY id LIMIT 10",
)
def o2_head(spark, sf):
    from seqprep.operators.sample import head

    df = head(fx.seq_type(spark, sf), 10, order_by="id")
    return df.select("id", "userId", F.size("timestamp").cast("long").alias("n_points"))


# ---------------------------------------------------------------- dataset build

_BUILD_SQL = [
    "p3a AS (SELECT * FROM p3 WHERE userId IN (SELECT userId FROM p3 GROUP BY userId HAVING count(*) >= 10))",
    _W1_SQL.replace("FROM p3))", "FROM p3a))"),
    _E1_SQL,
    _J4_SQL,
    O.seq_of(),
    _RAW_SQL,
    """hrs AS (SELECT userId, avg(hr) AS m, stddev_pop(hr) + 1e-6 AS s FROM pt
             WHERE id IN (SELECT id FROM w1 WHERE split = 'train') GROUP BY userId)""",
    """agg AS (SELECT pt.id, sum(l.v) AS altitude_sum, sum((pt.hr - hrs.m) / hrs.s) AS hr_z_sum
             FROM pt JOIN lastv l ON l.id = pt.id AND l.t = pt.t JOIN hrs USING (userId) GROUP BY pt.id)""",
]


_DATASET_SQL = O.with_(O.EV, O.pt_day(), _P3_SQL, *_BUILD_SQL) + """SELECT w1.id, w1.split, j4.userId_idx, j4.sport_idx, j4.gender_idx,
       round(agg.altitude_sum, 6) AS altitude_sum, round(agg.hr_z_sum, 6) AS hr_z_sum
FROM w1 JOIN j4 USING (id) JOIN agg USING (id)"""


def _dataset_inputs(spark, sf):
    """Records without altitude, and raw records in which the first time is repeated."""
    days = write_scratch_table(fx.seq_day(spark, sf))
    ts, alt = F.col("timestamp"), F.col("altitude")
    raw = days.select("id", F.concat(ts, F.array(ts[0])).alias("timestamp"),
                      F.concat(alt, F.array(alt[0] + 1000.0)).alias("altitude"))
    return days.drop("altitude"), raw


def _dataset_rows(built):
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return built.select(
        "id", "split", "userId_idx", "sport_idx", "gender_idx",
        r6(total(F.col("altitude"))).alias("altitude_sum"),
        r6(total(F.col("heart_rate_standardized"))).alias("hr_z_sum"),
    )


@register("dataset_build", _DATASET_SQL)
def dataset_build(spark, sf):
    from seqprep.plans import dataset

    return _dataset_rows(dataset.build(*_dataset_inputs(spark, sf)).data)


@register("dataset_build_bucketed", _DATASET_SQL)
def dataset_build_bucketed(spark, sf):
    """The same build on inputs stored in buckets of id, opened again from their paths."""
    from seqprep.plans import dataset

    path = scratch_path(spark, "inputs")
    dataset.store_inputs(*_dataset_inputs(spark, sf), path)
    return _dataset_rows(dataset.build(read_bucketed(spark, f"{path}/records"), read_bucketed(spark, f"{path}/signal")).data)
