"""Queries for the cleaners: fitted bounds, generic cleaning, clipping,
robust denoising, precision loss/repair and the point error report."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqprep import oracle_sql as O
from seqprep.catalog import long_form, r6, register
from seqprep.operators import clean, denoise, derive, precision, split
from seqprep.queries.q_corrupt import u32
from seqprep.queries.q_kernels import EVD, _gapfill_sql, interp_expr, neighbor_expr, window_sql
from seqprep.sources import fixtures as fx
from seqprep.sources.io import write_scratch_table

# value expression of each cleaned column in the derived-points CTE ``dp``
COLS = {"heart_rate": "hr", "derived_speed": "speed", "longitude": "lon", "latitude": "lat",
        "derived_distance": "dist", "altitude": "alt"}
SMOOTH = ["heart_rate", "derived_speed", "altitude"]


def _dirty_full(spark, sf):
    """Fit and transform both read this table: read it as a written table."""
    return write_scratch_table(derive.derive_features(derive.with_time_elapsed(fx.dirty(spark, sf))))


def _values_sql(src: str = "dp", group: str = "") -> str:
    g = f"{group}, " if group else ""
    parts = [f"SELECT {g}'{c}' AS \"column\", {v} AS x FROM {src}" for c, v in COLS.items()]
    return "vals AS (SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x))"


def _bounds_sql(group: str = "", name: str = "bnd") -> str:
    g = f"{group}, " if group else ""
    return f"""{name} AS (SELECT {g}"column", quantile_cont(x, 0.005) AS lo, quantile_cont(x, 0.995) AS hi,
                   quantile_cont(x, 0.5) AS med FROM vals GROUP BY ALL)"""


def _clean_col_sql(c: str, v: str, src: str, bnd: str, join_on: str) -> list[str]:
    """CTEs cleaning one column: interpolate → all-missing fill → clip → (smooth)."""
    g = f"g_{c}"
    ctes = [_gapfill_sql(v, src, g)]
    fill = f"(CASE WHEN b.med IS NULL OR isnan(b.med) THEN 0.0 ELSE b.med END)"
    interp = interp_expr("gg")
    filled = f"(CASE WHEN gg.nv = 0 THEN {fill} ELSE {interp} END)"
    lo = "coalesce(b.lo, '-inf'::DOUBLE)"
    hi = "coalesce(b.hi, 'inf'::DOUBLE)"
    clipped = f"(CASE WHEN isnan({filled}) THEN {filled} WHEN {filled} < {lo} THEN {lo} WHEN {filled} > {hi} THEN {hi} ELSE {filled} END)"
    ctes.append(
        f"""f_{c} AS (SELECT gg.id, gg.pos, s.n, {clipped} AS z FROM {g} gg JOIN {src} s ON s.id = gg.id AND s.pos = gg.pos
        LEFT JOIN {bnd} b ON b."column" = '{c}' {join_on})"""
    )
    if c in SMOOTH:
        ctes.append(f"o_{c} AS ({window_sql(f'f_{c}', 'z', 3, 'median({v})', 'z')})")
    else:
        ctes.append(f"o_{c} AS (SELECT id, pos, z FROM f_{c})")
    return ctes


# ---------------------------------------------------------------- A2, C2

@register(
    "a2_fit_bounds",
    O.with_(O.EV, EVD, O.pt_type("evd"), O.derived(), _values_sql(), _bounds_sql())
    + 'SELECT "column", round(lo, 6) AS lo, round(hi, 6) AS hi, round(med, 6) AS median FROM bnd',
)
def a2_fit_bounds(spark, sf):
    b = clean.fit_bounds(_dirty_full(spark, sf))
    return b.select("column", r6("lo").alias("lo"), r6("hi").alias("hi"), r6("median").alias("median"))


def _clip_sql(v: str, c: str) -> str:
    x = f"(CASE WHEN {v} IS NULL OR isnan({v}) OR isinf({v}) THEN 'nan'::DOUBLE ELSE {v} END)"
    lo = f"(SELECT lo FROM bnd WHERE \"column\" = '{c}')"
    hi = f"(SELECT hi FROM bnd WHERE \"column\" = '{c}')"
    return f"round(CASE WHEN isnan({x}) THEN {x} WHEN {x} < {lo} THEN {lo} WHEN {x} > {hi} THEN {hi} ELSE {x} END, 6) AS {c}"


@register(
    "c2_clip",
    O.with_(O.EV, EVD, O.pt_type("evd"), O.derived(), _values_sql(), _bounds_sql())
    + f"SELECT id, pos, {_clip_sql('hr', 'heart_rate')}, {_clip_sql('alt', 'altitude')} FROM dp",
)
def c2_clip(spark, sf):
    df = _dirty_full(spark, sf)
    out = clean.clip(df, clean.fit_bounds(df), ["heart_rate", "altitude"])
    return long_form(out, ["id"], {"heart_rate": "heart_rate", "altitude": "altitude"})


# ---------------------------------------------------------------- C1

def _c1_sql(fit_src_filter: str = "", out_cols: list[str] | None = None, extra: list[str] | None = None) -> str:
    cols = out_cols or list(COLS)
    ctes = [O.EV, EVD, O.pt_type("evd"), O.derived(), *(extra or [])]
    fit_src = f"(SELECT * FROM dp {fit_src_filter})" if fit_src_filter else "dp"
    ctes += [_values_sql(fit_src), _bounds_sql()]
    for c in cols:
        ctes += _clean_col_sql(c, COLS[c], "dp", "bnd", "")
    sel = ", ".join(f"round(o_{c}.z, 6) AS {c}" for c in cols)
    joins = " ".join(f"JOIN o_{c} USING (id, pos)" for c in cols)
    return O.with_(*ctes) + f"SELECT dp.id, dp.pos, {sel}, dp.te AS time_elapsed FROM dp {joins} WHERE dp.n >= 5"


@register("c1_clean", _c1_sql())
def c1_clean(spark, sf):
    df = clean.fit_transform(_dirty_full(spark, sf))
    return long_form(df, ["id"], {**{c: c for c in COLS}, "time_elapsed": "time_elapsed"})


@register("c1_clean_stream", _c1_sql())
def c1_clean_stream(spark, sf):
    """The fitted cleaner applied to a file stream of the same table (stream–
    static join with the bounds state), written by an exactly-once file sink
    under the checkpoint folder; the result must equal the batch ``c1_clean``."""
    import os
    import uuid

    from seqprep.session import ensure_checkpoint_dir
    from seqprep.streaming import stream

    table = _dirty_full(spark, sf)  # a written Parquet table: its folder is the stream source
    bounds = clean.fit_bounds(table)
    root = os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex}")
    src = os.path.dirname(table.inputFiles()[0])
    q = stream.run_stream(stream.read_stream(spark, src, table.schema, max_files_per_trigger=4),
                          lambda df: clean.clean(df, bounds), os.path.join(root, "out"), os.path.join(root, "ckpt"))
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(root, "out"))
    return long_form(out, ["id"], {**{c: c for c in COLS}, "time_elapsed": "time_elapsed"})


_SPLIT_TYPE = """spl AS (
  SELECT id, CASE WHEN rn < floor(cnt*0.7::DOUBLE) THEN 'train' WHEN rn < floor(cnt*0.8::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT id, row_number() OVER (PARTITION BY userId ORDER BY first_ts, id) AS rn, count(*) OVER (PARTITION BY userId) AS cnt
        FROM (SELECT id, any_value(userId) AS userId, min(t) AS first_ts FROM dp GROUP BY id)))"""


@register(
    "c1_clean_fit_on_train",
    _c1_sql("WHERE id IN (SELECT id FROM spl WHERE split = 'train')", ["heart_rate", "altitude"], [_SPLIT_TYPE]),
)
def c1_clean_fit_on_train(spark, sf):
    df = _dirty_full(spark, sf)
    train = split.temporal_split(df).where(F.col("split") == "train").drop("split")
    out = clean.fit_transform(df, fit_on=train)
    return long_form(out, ["id"], {"heart_rate": "heart_rate", "altitude": "altitude", "time_elapsed": "time_elapsed"})


@register(
    "c1_fit_bounds_grouped",
    O.with_(O.EV, EVD, O.pt_type("evd"), O.derived(), _values_sql("dp", "sport"), _bounds_sql("sport"))
    + 'SELECT sport, "column", round(lo, 6) AS lo, round(hi, 6) AS hi, round(med, 6) AS median FROM bnd',
)
def c1_fit_bounds_grouped(spark, sf):
    b = clean.fit_bounds(_dirty_full(spark, sf), group_by=["sport"])
    return b.select("sport", "column", r6("lo").alias("lo"), r6("hi").alias("hi"), r6("median").alias("median"))


# ---------------------------------------------------------------- C3

_SPIKY = """sp AS (SELECT id, pos, n, CASE WHEN (id * 7 + pos) % 29 < 2 THEN y + 3.0 ELSE y END AS x FROM vpt),
md AS (SELECT id, median(x) AS med FROM sp GROUP BY id),
mad AS (SELECT sp.id, median(abs(x - md.med)) AS mad FROM sp JOIN md USING (id) GROUP BY sp.id),
fl AS (SELECT sp.*, abs(0.6745 * (x - md.med) / (CASE WHEN mad.mad > 0 THEN mad.mad ELSE 1.0 END)) > 3.5 AS f
       FROM sp JOIN md USING (id) JOIN mad USING (id)),
runs AS (SELECT id, min(pos) AS s, max(pos) + 1 AS e FROM (
           SELECT id, pos, pos - row_number() OVER (PARTITION BY id ORDER BY pos) AS grp FROM fl WHERE f)
         GROUP BY id, grp HAVING max(pos) + 1 - min(pos) >= 2),
ends AS (SELECT runs.*, (SELECT max(n) FROM sp WHERE sp.id = runs.id) AS n,
                CASE WHEN s > 0 THEN (SELECT x FROM sp WHERE sp.id = runs.id AND sp.pos = runs.s - 1)
                     ELSE (SELECT x FROM sp WHERE sp.id = runs.id AND sp.pos = runs.e) END AS lft,
                CASE WHEN e < (SELECT max(n) FROM sp WHERE sp.id = runs.id) THEN (SELECT x FROM sp WHERE sp.id = runs.id AND sp.pos = runs.e)
                     ELSE (SELECT x FROM sp WHERE sp.id = runs.id AND sp.pos = runs.s - 1) END AS rgt
         FROM runs),
ramp AS (SELECT sp.id, sp.pos, sp.n,
                CASE WHEN ends.s IS NULL THEN sp.x
                     WHEN sp.pos - ends.s = ends.e - ends.s - 1 THEN ends.rgt
                     ELSE (sp.pos - ends.s) * ((ends.rgt - ends.lft) / (ends.e - ends.s - 1)) + ends.lft END AS z
         FROM sp LEFT JOIN ends ON ends.id = sp.id AND sp.pos >= ends.s AND sp.pos < ends.e)"""


@register(
    "c3_robust_denoise",
    O.with_(O.VEC, O.VEC_PT, _SPIKY, f"ma AS ({window_sql('ramp', 'z', 5, 'sum({v} * 0.2::DOUBLE)', 'y')})")
    + "SELECT id, pos, round(y, 6) AS y FROM ma",
)
def c3_robust_denoise(spark, sf):
    df = denoise.robust_denoise(fx.spiky(spark, sf), ["y"])
    return long_form(df, ["id"], {"y": "y"})


# ---------------------------------------------------------------- K4, C4, J6

EVS = """evs AS (SELECT * REPLACE (lat + sqrt(e + 2) / 1e6 AS lat, lon + sqrt(e + 2) / 1e6 AS lon) FROM ev)"""
EVR = """evr AS (SELECT * REPLACE (CASE WHEN e % 10 = 0 THEN round(lat, 3) ELSE lat END AS lat,
                                  CASE WHEN e % 10 = 0 THEN round(lon, 3) ELSE lon END AS lon) FROM evs)"""


def _loss_sql(c: str, v: str, seed: int, pct: int) -> str:
    hit = f"({u32(seed, 'id', repr(c), 'pos', chr(39) + 'hit' + chr(39))} % 100 + 1) <= {pct}"
    d = f"({u32(seed, 'id', repr(c), 'pos', chr(39) + 'dec' + chr(39))} % 5 + 2)"
    rounded = " ".join(f"WHEN {d} = {k} THEN round({v}, {k})" for k in range(2, 6)) + f" ELSE round({v}, 6)"
    # in billionths: a draw of 6 decimals differs from no draw
    return f"round_even((CASE WHEN {hit} THEN (CASE {rounded} END) ELSE {v} END) * 1e9, 0)::BIGINT AS {c}"


@register(
    "k4_precision_loss",
    O.with_(O.EV, EVS, O.pt_type("evs"))
    + f"SELECT id, pos, {_loss_sql('latitude', 'lat', 7, 10)}, {_loss_sql('longitude', 'lon', 7, 10)} FROM pt",
)
def k4_precision_loss(spark, sf):
    df = precision.precision_loss(fx.rounded(spark, sf, shift_only=True), percentage=10, seed=7)
    points = long_form(df, ["id"], {"latitude": "latitude", "longitude": "longitude"}, rounded=False)
    return points.select("id", "pos", *[F.rint(F.col(c) * 1e9).cast("long").alias(c) for c in ("latitude", "longitude")])


def _repair_sql(v: str, c: str) -> list[str]:
    flag = f"coalesce(abs({v} - round_even({v} * 1e13, 0) / 1e13) < 1e-14, false)"
    return [
        f"""b_{c} AS (SELECT id, pos, CASE WHEN ({flag} AND NOT allf) OR {v} IS NULL OR isnan({v}) OR isinf({v})
                                     THEN NULL ELSE {v} END AS bv
        FROM (SELECT *, bool_and({flag}) OVER (PARTITION BY id) AS allf FROM pt))""",
        _gapfill_sql("bv", f"b_{c}", f"r_{c}"),
    ]


@register(
    "c4_precision_repair",
    O.with_(O.EV, EVS, EVR, O.pt_type("evr"), *_repair_sql("lat", "lat"), *_repair_sql("lon", "lon"))
    + f"""SELECT r_lat.id, r_lat.pos, round({neighbor_expr('r_lat')}, 6) AS latitude,
       round({neighbor_expr('r_lon')}, 6) AS longitude FROM r_lat JOIN r_lon USING (id, pos)""",
)
def c4_precision_repair(spark, sf):
    df = precision.precision_repair(fx.rounded(spark, sf))
    return long_form(df, ["id"], {"latitude": "latitude", "longitude": "longitude"})


@register(
    "j6_point_error",
    O.with_(O.EV, EVS, EVR, O.pt_type("evr"), *_repair_sql("lat", "lat"), *_repair_sql("lon", "lon"),
            "orig AS (SELECT * FROM (" + O.pt_type("evs").replace("pt AS (", "", 1) + ")",
            f"""rep AS (SELECT r_lat.id, r_lat.pos, {neighbor_expr('r_lat')} AS lat1, {neighbor_expr('r_lon')} AS lon1
                FROM r_lat JOIN r_lon USING (id, pos))""")
    + f"""SELECT orig.id, orig.pos, round(orig.lat, 6) AS lat_original, round(rep.lat1, 6) AS lat_cleaned,
       round(orig.lon, 6) AS lon_original, round(rep.lon1, 6) AS lon_cleaned,
       round({O.hav_m('orig.lat', 'orig.lon', 'rep.lat1', 'rep.lon1')}, 6) AS error_m
FROM orig JOIN rep USING (id, pos)""",
)
def j6_point_error(spark, sf):
    original = fx.rounded(spark, sf, shift_only=True)
    cleaned = precision.precision_repair(fx.rounded(spark, sf))
    pe = precision.point_error(original, cleaned)
    return pe.select("id", "pos", *[r6(c).alias(c) for c in
                                    ["lat_original", "lat_cleaned", "lon_original", "lon_cleaned", "error_m"]])
