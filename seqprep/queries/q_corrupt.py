"""Queries for segment plans, seeded row choice, noise injection and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqprep import oracle_sql as O
from seqprep.catalog import long_form, r6, register
from seqprep.operators import corrupt, inject
from seqprep.operators.sample import choose_rows
from seqprep.sources import fixtures as fx
from seqprep.sources.io import write_scratch_table

K1_COMBOS = [(0.2, 1), (0.2, 2), (0.4, 2), (0.6, 3)]


def u32(*parts) -> str:
    return O.md5_u32(O.key(*parts))


def normal(*parts) -> str:
    k = O.key(*parts)
    a = f"(({O.md5_u32(k, 1)} + 1) / 4294967296.0)"
    b = f"(({O.md5_u32(k, 9)} + 1) / 4294967296.0)"
    return f"(sqrt(ln({a}) * -2.0) * cos((2 * pi()) * {b}))"


def plan_sql(lengths: str, combos: list[tuple[float, int]], seed: int) -> str:
    """CTEs ``pl`` (L, f, fm, k, S) and ``pmask`` (L, f, fm, k, pos, inplan)."""
    vals = ", ".join(f"({f}::DOUBLE, {round(f * 1000000000)}, {k})" for f, k in combos)
    return f"""combos AS (SELECT * FROM (VALUES {vals}) t(f, fm, k)),
pl AS (SELECT * FROM (SELECT L, f, fm, k, greatest(2, floor(L * f))::INT AS S FROM {lengths}, combos) WHERE k <= S AND S < L),
cutr AS (SELECT L, fm, k, j, row_number() OVER (PARTITION BY L, fm, k ORDER BY {u32(seed, 'L', 'fm', 'k', "'cut'", 'j')}, j) AS rk
         FROM pl, LATERAL generate_series(1, S - 1) g(j) WHERE k > 1),
bnd AS (SELECT L, fm, k, j AS b FROM cutr WHERE rk <= k - 1
        UNION ALL SELECT L, fm, k, 0 FROM pl UNION ALL SELECT L, fm, k, S FROM pl),
segb AS (SELECT L, fm, k, row_number() OVER w - 1 AS seg, b AS lo, lead(b) OVER w AS hi FROM bnd
         WINDOW w AS (PARTITION BY L, fm, k ORDER BY b)),
segl AS (SELECT L, fm, k, seg, hi - lo AS len FROM segb WHERE hi IS NOT NULL),
gapc AS (SELECT L, fm, k, {u32(seed, 'L', 'fm', 'k', "'gap'", 'sl')} % (k + 1) AS b, count(*) AS c
         FROM pl, LATERAL generate_series(0, L - S - 1) g(sl) GROUP BY ALL),
segs AS (SELECT s.L, s.fm, s.k, s.seg, s.len,
           (SELECT coalesce(sum(c), 0) FROM gapc g WHERE g.L = s.L AND g.fm = s.fm AND g.k = s.k AND g.b <= s.seg)
         + (SELECT coalesce(sum(len), 0) FROM segl t WHERE t.L = s.L AND t.fm = s.fm AND t.k = s.k AND t.seg < s.seg)
           AS start
         FROM segl s),
pmask AS (SELECT pl.L, pl.f, pl.fm, pl.k, pl.S, p.pos,
            EXISTS (SELECT 1 FROM segs WHERE segs.L = pl.L AND segs.fm = pl.fm AND segs.k = pl.k
                    AND p.pos >= segs.start AND p.pos < segs.start + segs.len) AS inplan
          FROM pl, LATERAL generate_series(0, pl.L - 1) p(pos))"""


# ---------------------------------------------------------------- K1

@register(
    "k1_segment_plan",
    O.with_(O.EV, O.pt_type(), "lens AS (SELECT DISTINCT n::INT AS L FROM pt)",
            plan_sql("lens", K1_COMBOS, 42))
    + """SELECT segs.L::BIGINT AS L, pl.f AS fraction, segs.k::BIGINT AS k, pl.S::BIGINT AS S, segs.seg::BIGINT AS seg,
       segs.start::BIGINT AS start, segs.len::BIGINT AS len
FROM segs JOIN pl USING (L, fm, k)""",
)
def k1_segment_plan(spark, sf):
    lengths = fx.seq_type(spark, sf).select(F.size("timestamp").alias("L"))
    plans = corrupt.plan_for_lengths(lengths, K1_COMBOS, 42)
    z = plans.select("L", "fraction", "k", "S", F.posexplode(F.arrays_zip("starts", "lens")).alias("seg", "p"))
    return z.select(
        F.col("L").cast("long"), "fraction", F.col("k").cast("long"), F.col("S").cast("long"),
        F.col("seg").cast("long"), F.col("p.starts").cast("long").alias("start"), F.col("p.lens").cast("long").alias("len"),
    )


# ---------------------------------------------------------------- O3

def _choice_sql(seed: int, frac: float, src: str = "vec", name: str = "ch") -> str:
    return f"""{name} AS (
  SELECT id, (row_number() OVER (ORDER BY {u32(seed, 'id')}, id) - 1)
             < greatest(1, floor(count(*) OVER () * {frac}::DOUBLE)) AS chosen
  FROM {src})"""


@register("o3_row_choice", O.with_(O.VEC, _choice_sql(7, 0.3)) + "SELECT id FROM ch WHERE chosen")
def o3_row_choice(spark, sf):
    df = choose_rows(fx.seq_vec(spark, sf), 0.3, 7)
    return df.where("chosen").select("id")


# ---------------------------------------------------------------- K2, K3

def _const_sql(src_pts: str, scale: float, seed: int, col: str, cname: str) -> str:
    """Per-row constant shift ``c`` from points ``(id, pos, L, S, inplan, x)``."""
    s2 = float(scale) ** 2
    return f"""SELECT id, any_value(L) AS L, any_value(S) AS S, avg(x) AS mu, stddev_pop(x) AS sigma,
       avg(abs(x)) AS mabs, any_value({u32(seed, 'id', f"'{cname}'", "'coin'")} < 2147483648) AS plus
FROM {src_pts} GROUP BY id"""


def _const_c(scale: float) -> str:
    s2 = float(scale) ** 2
    A = "(S::DOUBLE * (L - S) / (L::DOUBLE * L))"
    B = "((2.0 / L) * seg)"
    C = f"(-({s2} - 1) * sigma * sigma)"
    delta = f"({B} * {B} - 4 * {A} * {C})"
    base = "(CASE WHEN mabs > 0 THEN mabs ELSE 1.0 END)"
    return f"""CASE WHEN sigma = 0 THEN {base} * sqrt(({s2} - 1) * L::DOUBLE * L / (S::DOUBLE * (L - S)))
     WHEN plus THEN (-{B} + sqrt({delta})) / (2 * {A}) ELSE (-{B} - sqrt({delta})) / (2 * {A}) END"""


def _k2_sql(seed: int, frac: float, k: int, scale: float, col: str = "y", cname: str = "y", chosen: str = "TRUE") -> str:
    return (
        O.with_(
            O.VEC, O.VEC_PT, "lens AS (SELECT DISTINCT n::INT AS L FROM vpt)", plan_sql("lens", [(frac, k)], seed),
            f"pts AS (SELECT v.id, v.pos, v.L, v.S, v.inplan, v.x FROM (SELECT vpt.id, vpt.pos, vpt.n AS L, pm.S, pm.inplan, vpt.{col} AS x FROM vpt JOIN pmask pm ON pm.L = vpt.n AND pm.pos = vpt.pos) v)",
            f"rs AS ({_const_sql('pts', scale, seed, col, cname)})",
            "sg AS (SELECT pts.id, sum(CASE WHEN inplan THEN x - rs.mu ELSE 0 END) AS seg FROM pts JOIN rs USING (id) GROUP BY pts.id)",
            f"cc AS (SELECT rs.*, sg.seg, {_const_c(scale)} AS c FROM rs JOIN sg USING (id))",
        )
        + f"SELECT pts.id, pts.pos, round(CASE WHEN inplan AND ({chosen}) THEN x + cc.c ELSE x END, 6) AS {cname} FROM pts JOIN cc USING (id)"
    )


@register("k2_constant_noise", _k2_sql(11, 0.2, 2, 3.0))
def k2_constant_noise(spark, sf):
    df = corrupt.constant_noise(fx.seq_vec(spark, sf), ["y"], segment_fraction=0.2, num_segments=2, std_scale=3.0, seed=11)
    return long_form(df, ["id"], {"y": "y"})


def _random_k(scale: float) -> str:
    s2 = float(scale) ** 2
    C = f"((1 - {s2}) * sg2 * sg2)"
    delta = f"(4 * cov * cov - 4 * varr * {C})"
    return f"""CASE WHEN varr = 0 THEN 0.0 WHEN plus THEN (-2 * cov + sqrt({delta})) / (2 * varr)
     ELSE (-2 * cov - sqrt({delta})) / (2 * varr) END"""


def _k3_sql(seed: int, frac: float, k: int, scale: float, row_frac: float) -> str:
    return (
        O.with_(
            O.VEC, O.VEC_PT, "lens AS (SELECT DISTINCT n::INT AS L FROM vpt)", plan_sql("lens", [(frac, k)], seed),
            _choice_sql(seed, row_frac),
            f"pts AS (SELECT vpt.id, vpt.pos, vpt.y AS x, CASE WHEN pm.inplan THEN {normal(seed, 'vpt.id', chr(39) + 'y' + chr(39), 'vpt.pos')} ELSE 0.0 END AS r FROM vpt JOIN pmask pm ON pm.L = vpt.n AND pm.pos = vpt.pos)",
            f"""rs AS (SELECT id, var_pop(r) AS varr, covar_pop(x, r) AS cov, stddev_pop(x) AS sg0, avg(abs(x)) AS mabs,
                   any_value({u32(seed, 'id', "'y'", "'coin'")} < 2147483648) AS plus FROM pts GROUP BY id)""",
            f"rk AS (SELECT *, {_random_k(scale)} AS kk FROM (SELECT *, CASE WHEN sg0 = 0 THEN (CASE WHEN mabs > 0 THEN mabs ELSE 1.0 END) ELSE sg0 END AS sg2 FROM rs))",
        )
        + "SELECT pts.id, pts.pos, round(CASE WHEN ch.chosen THEN x + rk.kk * r ELSE x END, 6) AS y "
        "FROM pts JOIN rk USING (id) JOIN ch USING (id)"
    )


@register("k3_random_noise", _k3_sql(13, 0.4, 3, 3.0, 0.5))
def k3_random_noise(spark, sf):
    df = corrupt.random_noise(fx.seq_vec(spark, sf), ["y"], row_fraction=0.5, segment_fraction=0.4, num_segments=3,
                              std_scale=3.0, seed=13)
    return long_form(df, ["id"], {"y": "y"})


# ---------------------------------------------------------------- K5, A8

_ASSIGN_SQL = f"""asg0 AS (
  SELECT id, sport, (row_number() OVER (PARTITION BY sport ORDER BY {u32(42, 'id')}, id) - 1)::BIGINT AS r,
         count(*) OVER (PARTITION BY sport) AS n FROM vec),
asg1 AS (SELECT *, floor(n * 0.5::DOUBLE) AS mid FROM asg0),
asg2 AS (SELECT *, r < mid AS const, CASE WHEN r < mid THEN mid ELSE n - mid END AS m,
                CASE WHEN r < mid THEN r ELSE r - mid END AS q FROM asg1),
asg3 AS (SELECT *, floor(m * 0.3::DOUBLE) AS s1, floor(m * 0.6::DOUBLE) AS s2 FROM asg2),
asg4 AS (SELECT *, CASE WHEN q < s1 THEN 0.2 WHEN q < s2 THEN 0.4 ELSE 0.6 END::DOUBLE AS fraction,
                CASE WHEN q < s1 THEN s1 WHEN q < s2 THEN s2 - s1 ELSE m - s2 END AS c,
                CASE WHEN q < s1 THEN q WHEN q < s2 THEN q - s1 ELSE q - s2 END AS u FROM asg3),
asg AS (SELECT id, sport, CASE WHEN const THEN 'constant' ELSE 'random' END AS method, fraction,
               (CASE WHEN fraction < 0.5 THEN (CASE WHEN u < floor(c * 0.8::DOUBLE) THEN 1 ELSE 2 END)
                     WHEN u < floor(c * 0.6::DOUBLE) THEN 1 WHEN u < floor(c * 0.8::DOUBLE) THEN 2 ELSE 3 END)::INT AS k
        FROM asg4)"""


@register(
    "k5_stratified_assignment",
    O.with_(O.VEC, _ASSIGN_SQL) + "SELECT id, sport, method, fraction, k::BIGINT AS num_segments FROM asg",
)
def k5_stratified_assignment(spark, sf):
    a = inject.assign_injection(fx.seq_vec(spark, sf), seed=42)
    return a.select("id", "sport", F.col("assignment.method").alias("method"),
                    F.col("assignment.fraction").alias("fraction"),
                    F.col("assignment.k").cast("long").alias("num_segments"))


def _inject_sql() -> str:
    scales = "(2.0::DOUBLE), (4.0::DOUBLE), (8.0::DOUBLE)"
    cname = "erroneous_y"
    return O.with_(
        O.VEC, O.VEC_PT, _ASSIGN_SQL, "lens AS (SELECT DISTINCT n::INT AS L FROM vpt)",
        plan_sql("lens", [(0.2, 1), (0.2, 2), (0.4, 1), (0.4, 2), (0.6, 1), (0.6, 2), (0.6, 3)], 42),
        f"""pts AS (SELECT vpt.id, vpt.pos, vpt.n AS L, asg.sport, asg.method, pm.S, pm.inplan, vpt.y AS x,
                CASE WHEN pm.inplan THEN {normal(42, 'vpt.id', chr(39) + cname + chr(39), 'vpt.pos')} ELSE 0.0 END AS r
           FROM vpt JOIN asg USING (id) JOIN pmask pm ON pm.L = vpt.n AND pm.pos = vpt.pos AND pm.f = asg.fraction AND pm.k = asg.k)""",
        f"""rs AS (SELECT id, any_value(L) AS L, any_value(S) AS S, any_value(method) AS method, avg(x) AS mu,
                  stddev_pop(x) AS sigma, avg(abs(x)) AS mabs, var_pop(r) AS varr, covar_pop(x, r) AS cov,
                  any_value({u32(42, 'id', chr(39) + cname + chr(39), "'coin'")} < 2147483648) AS plus FROM pts GROUP BY id)""",
        "sg AS (SELECT pts.id, sum(CASE WHEN inplan THEN x - rs.mu ELSE 0 END) AS seg FROM pts JOIN rs USING (id) GROUP BY pts.id)",
        f"scales AS (SELECT * FROM (VALUES {scales}) t(std_scale))",
        "rsg AS (SELECT rs.*, sg.seg, CASE WHEN sigma = 0 THEN (CASE WHEN mabs > 0 THEN mabs ELSE 1.0 END) ELSE sigma END AS sg2 FROM rs JOIN sg USING (id))",
        "cs AS (SELECT rsg.*, std_scale FROM rsg, scales)",
        "mag AS (SELECT id, std_scale, method, " + _const_c_scaled() + " AS c, " + _random_k_scaled() + " AS kk FROM cs)",
        """inj AS (SELECT mag.std_scale, pts.id, pts.sport, pts.pos, pts.x,
                  CASE WHEN mag.method = 'constant' THEN (CASE WHEN pts.inplan THEN pts.x + mag.c ELSE pts.x END)
                       ELSE pts.x + mag.kk * pts.r END AS e
           FROM pts JOIN mag USING (id))""",
    )


def _const_c_scaled() -> str:
    s2 = "(std_scale * std_scale)"
    A = "(S::DOUBLE * (L - S) / (L::DOUBLE * L))"
    B = "((2.0 / L) * seg)"
    C = f"(-({s2} - 1) * sigma * sigma)"
    delta = f"({B} * {B} - 4 * {A} * {C})"
    base = "(CASE WHEN mabs > 0 THEN mabs ELSE 1.0 END)"
    return f"""(CASE WHEN sigma = 0 THEN {base} * sqrt(({s2} - 1) * L::DOUBLE * L / (S::DOUBLE * (L - S)))
     WHEN plus THEN (-{B} + sqrt({delta})) / (2 * {A}) ELSE (-{B} - sqrt({delta})) / (2 * {A}) END)"""


def _random_k_scaled() -> str:
    s2 = "(std_scale * std_scale)"
    C = f"((1 - {s2}) * sg2 * sg2)"
    delta = f"(4 * cov * cov - 4 * varr * {C})"
    return f"""(CASE WHEN varr = 0 THEN 0.0 WHEN plus THEN (-2 * cov + sqrt({delta})) / (2 * varr)
     ELSE (-2 * cov - sqrt({delta})) / (2 * varr) END)"""


def _injected(spark, sf):
    return inject.inject(write_scratch_table(fx.seq_vec(spark, sf)), columns=["y"], seed=42)


@register("k5_inject", _inject_sql() + "SELECT std_scale, id, pos, round(e, 6) AS erroneous_y FROM inj")
def k5_inject(spark, sf):
    return long_form(_injected(spark, sf), ["std_scale", "id"], {"erroneous_y": "erroneous_y"})


@register(
    "a8_corruption_audit",
    _inject_sql()
    + """SELECT sport, std_scale, count(*)::BIGINT AS n, count_if(abs(ratio - std_scale) < 1e-4)::BIGINT AS n_ok_y,
       round(min(ratio), 6) AS min_ratio_y, round(max(ratio), 6) AS max_ratio_y
FROM (SELECT std_scale, id, any_value(sport) AS sport,
             CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(e) / stddev_pop(x) ELSE 0 END AS ratio
      FROM inj GROUP BY std_scale, id) GROUP BY sport, std_scale""",
)
def a8_corruption_audit(spark, sf):
    a = inject.audit(_injected(spark, sf), columns=["y"])
    return a.select("sport", "std_scale", "n", "n_ok_y", r6("min_ratio_y").alias("min_ratio_y"),
                    r6("max_ratio_y").alias("max_ratio_y"))
