"""Queries for windows, scoring, metrics and the variant comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqprep import oracle_sql as O
from seqprep.catalog import r6, register, round6
from seqprep.operators import evaluate, windows
from seqprep.plans import variants
from seqprep.sources import fixtures as fx


def _window_long(w, with_hr: bool):
    z = w.select("id", "t", "target", F.posexplode("features").alias("k", "f"))
    cols = [round6(F.col("f")[0].cast("double")).alias("altitude"), round6(F.col("f")[1].cast("double")).alias("latitude")]
    if with_hr:
        cols.append(round6(F.col("f")[2].cast("double")).alias("heart_rate_in"))
    return z.select("id", "t", F.col("k").cast("long").alias("k"), *cols,
                    round6(F.col("target").cast("double")).alias("target"))


def _window_sql(with_hr: bool) -> str:
    hr = ", round(CASE WHEN p.pos - 10 + k.k >= 0 THEN q2.hr::FLOAT::DOUBLE ELSE 0.0 END, 6) AS heart_rate_in" if with_hr else ""
    j2 = "LEFT JOIN pt q2 ON q2.id = p.id AND q2.pos = p.pos - 10 + k.k" if with_hr else ""
    return O.with_(O.EV, O.pt_type()) + f"""SELECT p.id, p.pos AS t, k.k::BIGINT AS k,
       round(CASE WHEN p.pos - 9 + k.k >= 0 THEN q.alt::FLOAT::DOUBLE ELSE 0.0 END, 6) AS altitude,
       round(CASE WHEN p.pos - 9 + k.k >= 0 THEN q.lat::FLOAT::DOUBLE ELSE 0.0 END, 6) AS latitude{hr},
       round(p.hr::FLOAT::DOUBLE, 6) AS target
FROM pt p CROSS JOIN (SELECT unnest(range(10)) AS k) k
LEFT JOIN pt q ON q.id = p.id AND q.pos = p.pos - 9 + k.k {j2}"""


@register("w9_windows", _window_sql(False))
def w9_windows(spark, sf):
    w = windows.sliding_windows(fx.seq_type(spark, sf), ["altitude", "latitude"], "heart_rate", window_size=10)
    return _window_long(w, False)


@register("w9_windows_lagged", _window_sql(True))
def w9_windows_lagged(spark, sf):
    w = windows.sliding_windows(fx.seq_type(spark, sf), ["altitude", "latitude"], "heart_rate",
                                heartrate_input_column="heart_rate", window_size=10)
    return _window_long(w, True)


@register(
    "m1_score_windows",
    O.with_(O.EV, O.pt_type())
    + """SELECT p.id, p.pos, round(sum(CASE WHEN p.pos - 10 + k.k >= 0 THEN q.hr::FLOAT::DOUBLE ELSE 0.0 END) / 10, 6)
       AS predicted_heart_rate
FROM pt p CROSS JOIN (SELECT unnest(range(10)) AS k) k
LEFT JOIN pt q ON q.id = p.id AND q.pos = p.pos - 10 + k.k GROUP BY p.id, p.pos""",
)
def m1_score_windows(spark, sf):
    df = fx.seq_type(spark, sf)
    w = windows.sliding_windows(df, ["altitude"], "heart_rate", heartrate_input_column="heart_rate", window_size=10)
    pred = evaluate.regroup(evaluate.score_windows(w))
    z = pred.select("id", F.posexplode("predicted_heart_rate").alias("pos", "v"))
    return z.select("id", F.col("pos").cast("long").alias("pos"), round6(F.col("v")).alias("predicted_heart_rate"))


@register(
    "a6_mae_rmse",
    O.with_(O.EV, O.pt_type())
    + """SELECT round(avg(abs(hr - (hr + (e % 7) - 3))), 6) AS mae,
       round(sqrt(avg((hr - (hr + (e % 7) - 3)) * (hr - (hr + (e % 7) - 3)))), 6) AS rmse,
       count(*)::BIGINT AS n_points
FROM pt WHERE n > 1 AND pos >= 1""",
)
def a6_mae_rmse(spark, sf):
    m = evaluate.metrics(fx.scored(spark, sf))
    return m.select(r6("mae").alias("mae"), r6("rmse").alias("rmse"), "n_points")


def _variants_sql() -> str:
    """baseline / corrupted / cleaned heart rate of the valid seq_type rows,
    standardized by the statistics of the user's train rows (an unseen user:
    mean 0, std 1) and scored by the line fitted on the train rows' lagged
    standardized heart rate."""
    from seqprep.queries.q_corrupt import normal, plan_sql, u32
    from seqprep.queries.q_kernels import window_sql

    seed, col = 42, "'heart_rate'"
    k = """(CASE WHEN varr = 0 THEN 0.0
            WHEN plus THEN (-2 * cov + sqrt(4 * cov * cov - 4 * varr * ((1 - 4.0) * sg2 * sg2))) / (2 * varr)
            ELSE (-2 * cov - sqrt(4 * cov * cov - 4 * varr * ((1 - 4.0) * sg2 * sg2))) / (2 * varr) END)"""
    ctes = [
        O.EV, O.pt_type(),
        "bp AS (SELECT id, pos, n, hr FROM pt WHERE n >= 5)",
        "lens AS (SELECT DISTINCT n::INT AS L FROM bp)",
        plan_sql("lens", [(0.2, 2)], seed),
        f"""cp AS (SELECT bp.id, bp.pos, bp.n, bp.hr AS x,
               CASE WHEN pm.inplan THEN {normal(seed, 'bp.id', col, 'bp.pos')} ELSE 0.0 END AS r
           FROM bp JOIN pmask pm ON pm.L = bp.n AND pm.pos = bp.pos)""",
        f"""cs AS (SELECT id, var_pop(r) AS varr, covar_pop(x, r) AS cov,
               CASE WHEN stddev_pop(x) = 0 THEN (CASE WHEN avg(abs(x)) > 0 THEN avg(abs(x)) ELSE 1.0 END)
                    ELSE stddev_pop(x) END AS sg2,
               any_value({u32(seed, 'id', col, "'coin'")} < 2147483648) AS plus FROM cp GROUP BY id)""",
        f"cor AS (SELECT cp.id, cp.pos, cp.n, cp.x + {k} * cp.r AS hr FROM cp JOIN cs USING (id))",
        """cb AS (SELECT quantile_cont(hr, 0.005) AS lo, quantile_cont(hr, 0.995) AS hi FROM cor
               WHERE NOT isnan(hr) AND NOT isinf(hr))""",
        """cc AS (SELECT id, pos, n, CASE WHEN hr < cb.lo THEN cb.lo WHEN hr > cb.hi THEN cb.hi ELSE hr END AS z
               FROM cor, cb)""",
        f"cln AS ({window_sql('cc', 'z', 3, 'median({v})', 'hr')})",
        """allv AS (SELECT 'baseline' AS variant, id, pos, hr FROM bp
                 UNION ALL SELECT 'corrupted', id, pos, hr FROM cor
                 UNION ALL SELECT 'cleaned', id, pos, hr FROM cln)""",
        """who AS (SELECT id, any_value(userId) AS userId, min(t) AS first_ts FROM pt WHERE n >= 5 GROUP BY id)""",
        """trn AS (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY userId ORDER BY first_ts, id) AS rn,
                                  count(*) OVER (PARTITION BY userId) AS cnt FROM who) WHERE rn < floor(cnt * 0.7::DOUBLE))""",
        """st AS (SELECT userId, avg(hr) AS m, stddev_pop(hr) + 1e-6 AS s FROM bp JOIN who USING (id)
               WHERE id IN (SELECT id FROM trn) GROUP BY userId)""",
        """zs AS (SELECT v.variant, v.id, v.pos, v.hr,
                  ((v.hr - coalesce(st.m, 0.0)) / (CASE WHEN st.s IS NULL OR st.s <= 1e-12 THEN 1.0 ELSE st.s END))::FLOAT::DOUBLE AS z
           FROM allv v JOIN who USING (id) LEFT JOIN st USING (userId))""",
        """lg AS (SELECT p.variant, p.id, p.pos, any_value(p.hr) AS hr,
                  sum(CASE WHEN p.pos - 10 + k.k >= 0 THEN q.z ELSE 0.0 END) / 10 AS x
           FROM zs p CROSS JOIN (SELECT unnest(range(10)) AS k) k
           LEFT JOIN zs q ON q.variant = p.variant AND q.id = p.id AND q.pos = p.pos - 10 + k.k
           GROUP BY p.variant, p.id, p.pos)""",
        """ln AS (SELECT regr_slope(hr, x) AS slope, regr_intercept(hr, x) AS icpt FROM lg
               WHERE variant = 'baseline' AND id IN (SELECT id FROM trn))""",
        """pr AS (SELECT variant, id, pos, hr, ln.icpt + ln.slope * x AS pred FROM lg, ln)""",
    ]
    return O.with_(*ctes) + """SELECT variant, round(avg(abs(hr - pred)), 6) AS mae,
       round(sqrt(avg((hr - pred) * (hr - pred))), 6) AS rmse, count(*)::BIGINT AS n_points
FROM pr WHERE pos >= 1 GROUP BY variant"""


@register("a7_variant_metrics", _variants_sql())
def a7_variant_metrics(spark, sf):
    m = variants.compare_variants(fx.seq_type(spark, sf))
    return m.select("variant", r6("mae").alias("mae"), r6("rmse").alias("rmse"), "n_points")


# The sequences of a step, in the order of the flattened window; the last is lagged.
_FULL = ["te", "alt", "speed", "dist", "hr"]


def _full_input_sql() -> str:
    """The three variants with all five standardized sequences and the codes of
    user, sport and gender; normal equations of the train rows' windows, solved
    step by step; every variant scored by the coefficients."""
    from seqprep.queries.q_corrupt import normal, plan_sql, u32
    from seqprep.queries.q_kernels import window_sql

    ctes = [O.EV, O.pt_type(), "bp AS (SELECT * FROM pt WHERE n >= 5)", "lens AS (SELECT DISTINCT n::INT AS L FROM bp)",
            plan_sql("lens", [(0.2, 2)], 42)]
    for v, name in (("hr", "'heart_rate'"), ("alt", "'altitude'")):
        ctes += [
            f"""p_{v} AS (SELECT bp.id, bp.pos, bp.n, bp.{v} AS x, CASE WHEN m.inplan THEN {normal(42, 'bp.id', name, 'bp.pos')} ELSE 0.0 END AS r
                FROM bp JOIN pmask m ON m.L = bp.n AND m.pos = bp.pos)""",
            f"""s_{v} AS (SELECT id, var_pop(r) AS vr, covar_pop(x, r) AS cv, any_value({u32(42, 'id', name, "'coin'")} < 2147483648) AS plus,
                CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) WHEN avg(abs(x)) > 0 THEN avg(abs(x)) ELSE 1.0 END AS sg FROM p_{v} GROUP BY id)""",
            f"""e_{v} AS (SELECT p.id, p.pos, p.n, p.x + p.r * (CASE WHEN vr = 0 THEN 0.0
                ELSE (-2 * cv + (CASE WHEN plus THEN 1 ELSE -1 END) * sqrt(4 * cv * cv + 12 * vr * sg * sg)) / (2 * vr) END) AS z
                FROM p_{v} p JOIN s_{v} USING (id))""",
            f"q_{v} AS (SELECT quantile_cont(z, 0.005) AS lo, quantile_cont(z, 0.995) AS hi FROM e_{v})",
            f"c_{v} AS (SELECT id, pos, n, greatest(lo, least(hi, z)) AS z FROM e_{v}, q_{v})",
            f"o_{v} AS ({window_sql(f'c_{v}', 'z', 3, 'median({v})', 'z')})",
        ]
    stats = ", ".join(f"avg({v}) AS m{i}, stddev_pop({v}) + 1e-6 AS s{i}" for i, v in enumerate(_FULL))
    safe = lambda x: f"{x} IS NULL OR isnan({x}) OR isinf({x})"
    z = ", ".join(
        f"(({v} - (CASE WHEN {safe(f'm{i}')} THEN 0.0 ELSE m{i} END)) / (CASE WHEN {safe(f's{i}')} OR s{i} <= 1e-12 THEN 1.0 ELSE s{i} END)) AS y{i}"
        for i, v in enumerate(_FULL))
    known = ", ".join(f"CASE WHEN {safe(f'y{i}')} THEN 0.0 ELSE y{i}::FLOAT::DOUBLE END AS z{i}" for i in range(5))
    point = " ".join(f"WHEN f.f = {i} THEN q.z{i}" for i in range(5))
    ctes += [
        """cut AS (SELECT quantile_cont(lat, 0.005) AS a0, quantile_cont(lat, 0.995) AS a1,
                quantile_cont(lon, 0.005) AS o0, quantile_cont(lon, 0.995) AS o1 FROM bp)""",
        """bc AS (SELECT bp.* REPLACE (greatest(a0, least(a1, lat)) AS lat, greatest(o0, least(o1, lon)) AS lon) FROM bp, cut)""",
        O.derived("bp", "dp"), O.derived("bc", "dc"),
        """allv AS (SELECT 'baseline' AS variant, id, pos, te, alt, speed, dist, hr FROM dp
            UNION ALL SELECT 'corrupted', dp.id, dp.pos, te, e_alt.z, speed, dist, e_hr.z FROM dp JOIN e_alt USING (id, pos) JOIN e_hr USING (id, pos)
            UNION ALL SELECT 'cleaned', dc.id, dc.pos, te, o_alt.z, speed, dist, o_hr.z FROM dc JOIN o_alt USING (id, pos) JOIN o_hr USING (id, pos))""",
        """who AS (SELECT id, any_value(userId) AS userId, any_value(sport) AS sport, any_value(gender) AS gender, min(t) AS first_ts FROM bp GROUP BY id)""",
        """trn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY first_ts, id) AS rn,
                                  count(*) OVER (PARTITION BY userId) AS cnt FROM who) WHERE rn < floor(cnt * 0.7::DOUBLE))""",
        """cats AS (SELECT 0 AS c, userId::VARCHAR AS value, min((first_ts, userId, id)) AS k FROM trn GROUP BY 2
            UNION ALL SELECT 1, sport, min((first_ts, userId, id)) FROM trn GROUP BY 2
            UNION ALL SELECT 2, gender, min((first_ts, userId, id)) FROM trn GROUP BY 2)""",
        "enc AS (SELECT c, value, row_number() OVER (PARTITION BY c ORDER BY k) - 1 AS idx FROM cats)",
        """codes AS (SELECT id, v.c, coalesce(idx, -1)::DOUBLE AS code FROM who, LATERAL (VALUES (0, userId::VARCHAR), (1, sport), (2, gender)) v(c, value)
            LEFT JOIN enc ON enc.c = v.c AND enc.value IS NOT DISTINCT FROM v.value)""",
        f"st AS (SELECT userId, {stats} FROM dp WHERE id IN (SELECT id FROM trn) GROUP BY userId)",
        f"ys AS (SELECT variant, id, pos, hr, {z} FROM allv JOIN who USING (id) LEFT JOIN st USING (userId))",
        f"zs AS MATERIALIZED (SELECT variant, id, pos, hr, {known} FROM ys)",
        f"""x AS MATERIALIZED (
            SELECT p.variant, p.id, p.pos, k.k * 5 + f.f AS feature,
                   CASE WHEN p.pos - 9 + k.k - (f.f = 4)::INT < 0 THEN 0.0 {point} END AS v
            FROM zs p CROSS JOIN (SELECT unnest(range(10)) AS k) k CROSS JOIN (SELECT unnest(range(5)) AS f) f
            LEFT JOIN zs q ON q.variant = p.variant AND q.id = p.id AND q.pos = p.pos - 9 + k.k - (f.f = 4)::INT
            UNION ALL SELECT variant, zs.id, pos, 50 + c, code FROM zs JOIN codes USING (id)
            UNION ALL SELECT variant, id, pos, 53, 1.0::DOUBLE FROM zs)""",
        """t AS MATERIALIZED (SELECT id, pos, feature, v FROM x WHERE variant = 'baseline' AND id IN (SELECT id FROM trn)
            UNION ALL SELECT id, pos, 54, hr::FLOAT::DOUBLE FROM bp WHERE id IN (SELECT id FROM trn))""",
        "gram AS (SELECT a.feature AS i, b.feature AS j, sum(a.v * b.v) AS total FROM t a JOIN t b USING (id, pos) WHERE a.feature < 54 GROUP BY i, j)",
        """cells AS (SELECT i, j, total / (SELECT total FROM gram WHERE i = 53 AND j = 53)
            + CASE WHEN i = j AND i < 53 THEN 0.001::DOUBLE ELSE 0.0 END AS v FROM gram)""",
        "lines AS (SELECT i, list(v ORDER BY j) AS line FROM cells GROUP BY i)",
        """solved AS (SELECT 1 AS step, list(line ORDER BY i) AS m FROM lines
            UNION ALL SELECT step + 1, list_transform(m, lambda line, r: CASE WHEN r = step THEN list_transform(line, lambda v: v / m[step][step])
              ELSE list_transform(line, lambda v, c: v - line[step] * m[step][c] / m[step][step]) END) FROM solved WHERE step <= 54)""",
        "coef AS (SELECT r - 1 AS feature, m[r][55] AS w FROM (SELECT m, unnest(generate_series(1, 54)) AS r FROM solved WHERE step = 55))",
        "pr AS (SELECT variant, id, pos, sum(v * w) AS pred FROM x JOIN coef USING (feature) GROUP BY variant, id, pos)",
    ]
    return "WITH RECURSIVE " + O.with_(*ctes)[5:] + """SELECT variant, round(avg(abs(hr - pred)), 4) AS mae,
       round(sqrt(avg((hr - pred) * (hr - pred))), 4) AS rmse, count(*)::BIGINT AS n_points
FROM pr JOIN allv USING (variant, id, pos) WHERE pos >= 1 GROUP BY variant"""


@register("a7_full_input", _full_input_sql())
def a7_full_input(spark, sf):
    """The variants scored by a linear model on its whole input."""
    m = variants.compare_variants(fx.seq_type(spark, sf), fit=variants.fit_full_state, score=variants.predict_full)
    return m.select("variant", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), "n_points")


@register(
    "m1_score_sequences",
    O.with_(O.EV, O.pt_type())
    + """SELECT p.id, p.pos, round(sum(CASE WHEN p.pos - 10 + k.k >= 0 THEN q.hr::FLOAT::DOUBLE ELSE 0.0 END) / 10
         + 0.5 * any_value(p.alt::FLOAT::DOUBLE), 6) AS predicted_heart_rate
FROM pt p CROSS JOIN (SELECT unnest(range(10)) AS k) k
LEFT JOIN pt q ON q.id = p.id AND q.pos = p.pos - 10 + k.k GROUP BY p.id, p.pos""",
)
def m1_score_sequences(spark, sf):
    """A Python model on whole sequences: the lagged mean plus half the altitude
    of the step."""
    def model(x):
        return x[:, :, 1].mean(axis=1, dtype="float64") + 0.5 * x[:, -1, 0].astype("float64")

    df = fx.seq_type(spark, sf).select("id", "altitude", "heart_rate")
    pred = evaluate.score_sequences(df, model, ["altitude"], "heart_rate", window_size=10)
    z = pred.select("id", F.posexplode("predicted_heart_rate").alias("pos", "v"))
    return z.select("id", F.col("pos").cast("long").alias("pos"), round6(F.col("v")).alias("predicted_heart_rate"))


@register(
    "m2_lagged_line",
    O.with_(O.EV, O.pt_type())
    + """SELECT round(regr_slope(hr, x), 6) AS slope, round(regr_intercept(hr, x), 6) AS intercept FROM (
  SELECT p.id, p.pos, any_value(p.hr) AS hr, sum(CASE WHEN p.pos - 10 + k.k >= 0 THEN q.hr::FLOAT::DOUBLE ELSE 0.0 END) / 10 AS x
  FROM pt p CROSS JOIN (SELECT unnest(range(10)) AS k) k
  LEFT JOIN pt q ON q.id = p.id AND q.pos = p.pos - 10 + k.k GROUP BY p.id, p.pos)""",
)
def m2_lagged_line(spark, sf):
    """The fitted line of the lagged scorer on raw heart rate."""
    fitted = evaluate.fit_lagged_scorer(fx.seq_type(spark, sf), "heart_rate", "heart_rate")
    return fitted.select(r6("slope").alias("slope"), r6("intercept").alias("intercept"))


# Windows of pt in long form, one row per entry of the flattened window: step by
# step altitude, latitude and the heart rate one step before; feature 30 is the 1.
_ENTRIES = """x AS (
  SELECT p.id, p.pos, k.k * 3 + f.f AS feature,
         CASE WHEN p.pos - 9 + k.k - (f.f = 2)::INT < 0 THEN 0.0
              WHEN f.f = 0 THEN q.alt::FLOAT::DOUBLE WHEN f.f = 1 THEN q.lat::FLOAT::DOUBLE ELSE q.hr::FLOAT::DOUBLE END AS v
  FROM pt p CROSS JOIN (SELECT unnest(range(10)) AS k) k CROSS JOIN (SELECT unnest(range(3)) AS f) f
  LEFT JOIN pt q ON q.id = p.id AND q.pos = p.pos - 9 + k.k - (f.f = 2)::INT
  UNION ALL SELECT id, pos, 30, 1.0::DOUBLE FROM pt
  UNION ALL SELECT id, pos, 31, hr::FLOAT::DOUBLE FROM pt),
gram AS (SELECT a.feature AS i, b.feature AS j, sum(a.v * b.v) AS total FROM x a JOIN x b USING (id, pos) GROUP BY i, j)"""


@register(
    "m2_window_gram",
    O.with_(O.EV, O.pt_type(), _ENTRIES) + "SELECT i::BIGINT AS i, j::BIGINT AS j, round(total / count(*) OVER (), 2) AS total FROM gram",
)
def m2_window_gram(spark, sf):
    """Sums of products over all windows, by the number of entries."""
    gram = evaluate.window_gram(fx.seq_type(spark, sf), ["altitude", "latitude"], "heart_rate", "heart_rate")
    return gram.select("i", "j", F.round(F.col("total") / 32**2, 2).alias("total"))


@register(
    "m2_fit_regressor",
    "WITH RECURSIVE " + O.with_(O.EV, O.pt_type(), _ENTRIES)[5:]
    + """, cells AS (
  SELECT i, j, total / (SELECT total FROM gram WHERE i = 30 AND j = 30) + CASE WHEN i = j AND i < 30 THEN 0.001::DOUBLE ELSE 0.0 END AS v
  FROM gram WHERE i <= 30),
lines AS (SELECT i, list(v ORDER BY j) AS line FROM cells GROUP BY i),
solved AS (
  SELECT 1 AS step, list(line ORDER BY i) AS m FROM lines
  UNION ALL
  SELECT step + 1, list_transform(m, lambda line, r: CASE WHEN r = step THEN list_transform(line, lambda v: v / m[step][step])
    ELSE list_transform(line, lambda v, c: v - line[step] * m[step][c] / m[step][step]) END)
  FROM solved WHERE step <= 31)
SELECT (r - 1)::BIGINT AS feature, round(m[r][32], 5) AS coefficient
FROM (SELECT m, unnest(generate_series(1, 31)) AS r FROM solved WHERE step = 32)""",
)
def m2_fit_regressor(spark, sf):
    """All coefficients of the linear model on whole windows, at its L2 of 0.001."""
    fitted = evaluate.fit_regressor(fx.seq_type(spark, sf), ["altitude", "latitude"], "heart_rate", "heart_rate", reg_param=0.001)
    return fitted.select("feature", F.round("coefficient", 5).alias("coefficient"))
