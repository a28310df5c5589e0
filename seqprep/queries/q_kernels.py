"""Queries for the per-sequence kernels: validation, coercion, fills,
rolling statistics, runs and per-sequence statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqprep import oracle_sql as O
from seqprep.catalog import long_form, r6, register, round6
from seqprep.functions import arrays as A
from seqprep.functions.missing import canonical
from seqprep.operators import clean, derive, profile, validate
from seqprep.sources import fixtures as fx
from seqprep.sources.io import write_scratch_table

EVD = """evd AS (SELECT * REPLACE (CASE WHEN e % 11 = 0 THEN NULL WHEN e % 13 = 0 THEN 'nan'::DOUBLE
                                   WHEN e % 17 = 0 THEN 'inf'::DOUBLE ELSE hr END AS hr) FROM ev)"""


def _gapfill_sql(value: str, src: str = "pt", name: str = "gf") -> str:
    """Per point: y (NULL when missing), previous/next valid position and value."""
    return f"""{name}0 AS (
  SELECT id, pos, CASE WHEN {value} IS NULL OR isnan({value}) OR isinf({value}) THEN NULL ELSE {value} END AS y
  FROM {src}),
{name} AS (
  SELECT id, pos, y,
    last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER wp AS pa,
    last_value(y IGNORE NULLS) OVER wp AS ya,
    first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER wf AS pb,
    first_value(y IGNORE NULLS) OVER wf AS yb,
    count(y) OVER (PARTITION BY id) AS nv
  FROM {name}0
  WINDOW wp AS (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wf AS (PARTITION BY id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def interp_expr(g: str = "") -> str:
    p = f"{g}." if g else ""
    return (
        f"CASE WHEN {p}nv = 0 THEN 'nan'::DOUBLE WHEN {p}y IS NOT NULL THEN {p}y WHEN {p}pa IS NULL THEN {p}yb "
        f"WHEN {p}pb IS NULL THEN {p}ya ELSE {p}ya + ({p}pos - {p}pa) * (({p}yb - {p}ya) / ({p}pb - {p}pa)) END"
    )


def neighbor_expr(g: str = "") -> str:
    p = f"{g}." if g else ""
    return (
        f"CASE WHEN {p}nv = 0 THEN 'nan'::DOUBLE WHEN {p}y IS NOT NULL THEN {p}y WHEN {p}pa IS NULL THEN {p}yb "
        f"WHEN {p}pb IS NULL THEN {p}ya ELSE ({p}ya + {p}yb) / 2 END"
    )


def window_sql(src: str, value: str, width: int, agg: str, out: str) -> str:
    """Aggregate over the edge-padded window ``[i - width//2, i - width//2 + width)``."""
    pad = width // 2
    return f"""SELECT p.id, p.pos, {agg.format(v='q.' + value)} AS {out}
FROM {src} p CROSS JOIN (SELECT unnest(range({width})) AS k) kk
JOIN {src} q ON q.id = p.id AND q.pos = greatest(0, least(p.n - 1, p.pos - {pad} + kk.k))
GROUP BY p.id, p.pos"""


# ---------------------------------------------------------------- P4, A9, P5, P6, P8

_DIRTY_LEN = """dl AS (
  SELECT id, timestamp, heart_rate, longitude, latitude, altitude AS altitude0,
         CASE WHEN id % 7 = 0 THEN altitude[1:len(altitude)-1] ELSE altitude END AS altitude
  FROM seq)"""


def _dirty_len_full(spark, sf):
    df = derive.derive_features(derive.with_time_elapsed(fx.dirty_len(spark, sf)))
    return df


@register(
    "p4_valid_lengths",
    O.with_(O.EV, O.pt_type(), O.seq_of(), _DIRTY_LEN)
    + """SELECT id, (len(timestamp) >= 5 AND len(altitude) = len(timestamp) AND len(heart_rate) = len(timestamp)
              AND len(latitude) = len(timestamp) AND len(longitude) = len(timestamp)) AS valid FROM dl""",
)
def p4_valid_lengths(spark, sf):
    df = _dirty_len_full(spark, sf)
    cfg = clean.CleaningConfig()
    v = validate.valid_lengths(df, cfg.seq_float_cols + cfg.seq_int_cols, "timestamp", cfg.min_seq_len)
    return df.select("id", v.alias("valid"))


@register(
    "a9_clean_report",
    O.with_(O.EV, O.pt_type(), O.seq_of(), _DIRTY_LEN)
    + """SELECT valid, count(*)::BIGINT AS n FROM (
  SELECT (len(timestamp) >= 5 AND len(altitude) = len(timestamp)) AS valid FROM dl) GROUP BY valid""",
)
def a9_clean_report(spark, sf):
    return clean.clean_report(_dirty_len_full(spark, sf))


@register(
    "a9_clean_observed",
    O.with_(O.EV, O.pt_type(), O.seq_of(), _DIRTY_LEN)
    + """SELECT valid, count(*)::BIGINT AS n, sum(CASE WHEN valid THEN len(timestamp) END)::BIGINT AS points FROM (
  SELECT *, (len(timestamp) >= 5 AND len(altitude) = len(timestamp)) AS valid FROM dl) GROUP BY valid""",
)
def a9_clean_observed(spark, sf):
    """The counts that came with the write of the cleaned table, beside what was written."""
    df = write_scratch_table(_dirty_len_full(spark, sf))
    out, report = clean.clean_observed(df, clean.fit_bounds(df))
    written = write_scratch_table(out)
    n = report.get
    counts = spark.createDataFrame([(True, n["kept"]), (False, n["dropped"])], "valid boolean, n long").where("n > 0")
    points = written.agg(F.sum(F.size("heart_rate")).cast("long")).scalar()
    return counts.select("valid", "n", F.when(F.col("valid"), points).alias("points"))


@register(
    "p5_coerce_float",
    O.with_(O.EV, EVD, O.pt_type("evd"))
    + "SELECT id, pos, CASE WHEN hr IS NULL OR isnan(hr) OR isinf(hr) THEN 'nan'::DOUBLE ELSE round(hr, 6) END AS heart_rate FROM pt",
)
def p5_coerce_float(spark, sf):
    df = fx.dirty(spark, sf)
    df = df.withColumn("heart_rate", validate.coerce_float("heart_rate", df.schema["heart_rate"].dataType))
    return long_form(df, ["id"], {"heart_rate": "heart_rate"})


@register(
    "p6_coerce_int",
    O.with_(O.EV, EVD, O.pt_type("evd"))
    + """SELECT id,
  CASE WHEN bool_or(hr IS NULL OR isnan(hr) OR isinf(hr)) THEN 0 ELSE count(*) END::BIGINT AS n_points,
  CASE WHEN bool_or(hr IS NULL OR isnan(hr) OR isinf(hr)) THEN 0 ELSE sum(CASE WHEN isnan(hr) OR isinf(hr) THEN 0 ELSE trunc(hr)::BIGINT END) END::BIGINT AS total
FROM pt GROUP BY id""",
)
def p6_coerce_int(spark, sf):
    df = fx.dirty(spark, sf)
    ints = validate.coerce_int("heart_rate", df.schema["heart_rate"].dataType)
    df = df.withColumn("hr_int", ints)
    return df.select(
        "id",
        F.size("hr_int").cast("long").alias("n_points"),
        F.aggregate("hr_int", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
    )


@register("p8_repair_elapsed", O.with_(O.EV, O.pt_type(), O.derived()) + "SELECT id, pos, te AS time_elapsed FROM dp")
def p8_repair_elapsed(spark, sf):
    df = derive.with_time_elapsed(fx.seq_type(spark, sf))
    te = F.col("time_elapsed")
    broken = (
        F.when(F.col("id") % 5 == 0, F.array().cast("array<long>"))
        .when(F.col("id") % 5 == 1, F.slice(te, 1, F.size(te) - 1))
        .otherwise(te)
    )
    df = derive.repair_time_elapsed(df.withColumn("time_elapsed", broken))
    return long_form(df, ["id"], {"time_elapsed": "time_elapsed"})


# ---------------------------------------------------------------- W8, W6

@register(
    "w8_interpolate",
    O.with_(O.EV, EVD, O.pt_type("evd"), _gapfill_sql("hr"))
    + f"SELECT id, pos, round({interp_expr()}, 6) AS heart_rate FROM gf",
)
def w8_interpolate(spark, sf):
    df = fx.dirty(spark, sf).withColumn("heart_rate", canonical(F.col("heart_rate")))
    df = df.withColumn("heart_rate", A.interpolate("heart_rate"))
    return long_form(df, ["id"], {"heart_rate": "heart_rate"})


@register(
    "w6_neighbor_mean_fill",
    O.with_(O.EV, EVD, O.pt_type("evd"), _gapfill_sql("hr"))
    + f"SELECT id, pos, round({neighbor_expr()}, 6) AS heart_rate FROM gf",
)
def w6_neighbor_mean_fill(spark, sf):
    df = fx.dirty(spark, sf).withColumn("heart_rate", canonical(F.col("heart_rate")))
    df = df.withColumn("heart_rate", A.neighbor_mean_fill("heart_rate"))
    return long_form(df, ["id"], {"heart_rate": "heart_rate"})


# ---------------------------------------------------------------- W4, W5, W7

@register(
    "w4_rolling_median",
    O.with_(O.EV, O.pt_type(),
            f"m3 AS ({window_sql('pt', 'alt', 3, 'median({v})', 'med3')})",
            f"m4 AS ({window_sql('pt', 'alt', 4, 'median({v})', 'med4')})")
    + "SELECT id, pos, round(m3.med3, 6) AS med3, round(m4.med4, 6) AS med4 FROM m3 JOIN m4 USING (id, pos)",
)
def w4_rolling_median(spark, sf):
    df = fx.seq_type(spark, sf)
    df = df.withColumn("med3", A.rolling_median("altitude", 3)).withColumn(
        "med4", A.rolling_median("altitude", 4)
    )
    return long_form(df, ["id"], {"med3": "med3", "med4": "med4"})


@register(
    "w5_moving_average",
    O.with_(O.EV, O.pt_type(), f"ma AS ({window_sql('pt', 'alt', 5, 'sum({v} * 0.2::DOUBLE)', 'ma5')})")
    + "SELECT id, pos, round(ma5, 6) AS ma5 FROM ma",
)
def w5_moving_average(spark, sf):
    df = fx.seq_type(spark, sf).withColumn("ma5", A.moving_average("altitude", 5))
    return long_form(df, ["id"], {"ma5": "ma5"})


@register(
    "w3_running_sum",
    O.with_(O.EV, O.pt_type())
    + """SELECT id, pos, round(sum(CASE WHEN pos % 5 = 3 THEN 0.0 ELSE alt END) OVER w, 6) AS sums,
       (sum(CASE WHEN pos % 5 = 3 THEN 0 ELSE t END) OVER w)::BIGINT AS times
FROM pt WINDOW w AS (PARTITION BY id ORDER BY pos)""",
)
def w3_running_sum(spark, sf):
    """Running sums of a float and an integer sequence with missing points."""
    df = fx.seq_type(spark, sf)
    for out, c, kind in (("sums", "altitude", "double"), ("times", "timestamp", "bigint")):
        df = df.withColumn(out, A.running_sum(f"transform({c}, (x, i) -> CASE WHEN i % 5 = 3 THEN NULL ELSE x END)", kind))
    z = df.select("id", F.posexplode(F.arrays_zip("sums", "times")).alias("pos", "v"))
    return z.select("id", F.col("pos").cast("long").alias("pos"), round6(F.col("v.sums")).alias("sums"), F.col("v.times").alias("times"))


@register(
    "w7_mask_runs",
    O.with_(O.EV, O.pt_type())
    + """SELECT id, min(pos)::BIGINT AS run_start, (max(pos) + 1)::BIGINT AS run_end
FROM (SELECT id, pos, pos - row_number() OVER (PARTITION BY id ORDER BY pos) AS grp FROM pt WHERE alt > 20)
GROUP BY id, grp""",
)
def w7_mask_runs(spark, sf):
    df = fx.seq_type(spark, sf)
    runs = df.select("id", F.explode(A.mask_runs("transform(altitude, a -> a > 20.0D)")).alias("r"))
    return runs.select("id", F.col("r.start").cast("long").alias("run_start"), F.col("r.end").cast("long").alias("run_end"))


# ---------------------------------------------------------------- A5

@register(
    "a5_sequence_stats",
    O.with_(O.EV, O.pt_type(),
            "md AS (SELECT id, median(alt) AS med FROM pt GROUP BY id)",
            "mad AS (SELECT pt.id, median(abs(alt - md.med)) AS mad FROM pt JOIN md USING (id) GROUP BY pt.id)")
    + """SELECT id, round(avg(alt), 6) AS alt_mean, round(var_pop(alt), 6) AS alt_var, round(stddev_pop(alt), 6) AS alt_std,
       round(any_value(md.med), 6) AS alt_median, round(any_value(mad.mad), 6) AS alt_mad,
       round(covar_pop(alt, hr), 6) AS alt_cov_heart_rate
FROM pt JOIN md USING (id) JOIN mad USING (id) GROUP BY id""",
)
def a5_sequence_stats(spark, sf):
    df = profile.sequence_stats(fx.seq_type(spark, sf), "altitude", other="heart_rate", prefix="alt")
    cols = ["alt_mean", "alt_var", "alt_std", "alt_median", "alt_mad", "alt_cov_heart_rate"]
    return df.select("id", *[r6(c).alias(c) for c in cols])
