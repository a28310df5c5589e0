"""Noise injection with an exact target standard deviation.

A *segment plan* chooses which points of a length-L sequence are corrupted:
``S = max(2, int(L·fraction))`` points in ``k`` segments (k−1 distinct cuts
in 1..S−1, so every segment has at least one point), with the L−S other
points spread over the k+1 gaps by a multinomial with equal weights. The
plan is a function of (L, fraction, k, seed) alone and is computed in the row,
so rows may have any lengths and the same expressions run on streams. A
sequence too short for its plan (it needs ``k <= S < L``) is left as it is.

Constant noise adds one ``c`` to every planned point; random noise adds
``k·R`` with R ~ N(0,1) on the planned points. In both cases the magnitude
solves ``A·c² + B·c + C = 0`` so that the population std of the result is
exactly ``std_scale`` times the original; a hashed fair coin picks the root
per row and column. All draws are hash-based (``seqprep.functions.sqlx``),
so results do not depend on partitioning, order or retries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.functions import sqlx as S
from seqprep.functions.arrays import let, seq_mean
from seqprep.operators.sample import choose_rows
from seqprep.sources.schema import require_array_columns

NO_PLAN = "CAST(NULL AS STRUCT<S: INT, starts: ARRAY<INT>, lens: ARRAY<INT>>)"


def plan_sql(L: str, fraction: str, k: str, seed: int) -> str:
    """SQL for a row's plan ``struct(S, starts, lens)``, NULL where the sequence
    is too short for it. ``L``, ``fraction`` (double) and ``k`` are SQL
    expressions, literals or columns. Draws are keyed by the fraction in
    billionths, so different fractions draw differently."""
    fm = f"CAST(round({fraction} * 1e9D) AS BIGINT)"

    def h(tag: str, v: str) -> str:
        return S.u32(str(seed), L, fm, k, S.s(tag), v)

    def planned(size: str) -> str:
        j, t, i, sl, b, x = (S.var(v) for v in "jtisbx")
        a1, a2, x1, x2 = S.var("a"), S.var("a"), S.var("x"), S.var("x")
        ranked = f"array_sort(transform(sequence(1, {size} - 1), {j} -> named_struct('h', {h('cut', j)}, 'j', {j})))"
        cuts = (f"(CASE WHEN {k} > 1 THEN array_sort(transform(slice({ranked}, 1, {k} - 1), {t} -> {t}.j)) "
                f"ELSE CAST(array() AS ARRAY<INT>) END)")
        lens = S.let(f"concat(array(0), {cuts}, array({size}))", lambda e: f"transform(sequence(0, {k} - 1), {i} -> {e}[{i} + 1] - {e}[{i}])")
        bins = f"transform(sequence(0, {L} - {size} - 1), {sl} -> CAST({h('gap', sl)} % ({k} + 1) AS INT))"
        gaps = S.let(bins, lambda g: f"transform(sequence(0, {k}), {b} -> size(filter({g}, {x} -> {x} = {b})))")

        def with_lens(n: str) -> str:
            def with_gaps(g: str) -> str:
                starts = (f"transform(sequence(0, {k} - 1), {i} -> aggregate(slice({g}, 1, {i} + 1), 0, ({a1}, {x1}) -> {a1} + {x1})"
                          f" + aggregate(slice({n}, 1, {i}), 0, ({a2}, {x2}) -> {a2} + {x2}))")
                return f"named_struct('S', {size}, 'starts', {starts}, 'lens', {n})"

            return S.let(gaps, with_gaps)

        return f"(CASE WHEN {k} <= {size} AND {size} < {L} THEN {S.let(lens, with_lens)} ELSE {NO_PLAN} END)"

    size = f"CAST(greatest(2, CAST(floor({L} * {fraction}) AS INT)) AS INT)"
    return f"(CASE WHEN {L} > 2 AND {k} IS NOT NULL AND {fraction} IS NOT NULL THEN {S.let(size, planned)} ELSE {NO_PLAN} END)"


def mask_sql(plan: str, L: str) -> str:
    """One boolean per point: whether the plan corrupts it; empty without one."""
    i, p, q, g = (S.var(v) for v in "ipqg")
    segs = f"zip_with({plan}.starts, {plan}.lens, ({p}, {q}) -> named_struct('s', {p}, 'n', {q}))"
    mask = S.let(segs, lambda sg: f"transform(sequence(0, {L} - 1), {i} -> exists({sg}, {g} -> {i} >= {g}.s AND {i} < {g}.s + {g}.n))")
    return f"(CASE WHEN {plan} IS NULL THEN CAST(array() AS ARRAY<BOOLEAN>) ELSE {mask} END)"


def plan_for_lengths(lengths: DataFrame, combos: Sequence[tuple[float, int]], seed: int, length_col: str = "L") -> DataFrame:
    """Segment plans ``(L, fraction, k, S, starts, lens)`` of each distinct
    length and combination that has one."""
    if any(k < 1 for _, k in combos):
        raise ValueError("num_segments must be >= 1")
    each = F.explode(F.array(*[F.struct(F.lit(float(f)).alias("fraction"), F.lit(k).alias("k")) for f, k in combos])).alias("c")
    base = lengths.select(F.col(length_col).cast("int").alias("L")).distinct().select("L", each).select("L", "c.fraction", "c.k")
    planned = base.withColumn("plan", F.expr(plan_sql("L", "fraction", "k", seed))).where("plan IS NOT NULL")
    return planned.select("L", "fraction", "k", "plan.S", "plan.starts", "plan.lens")


def _check_args(df: DataFrame, columns: Sequence[str], std_scale: float) -> None:
    if std_scale <= 1:
        raise ValueError(f"std_scale must be > 1, got {std_scale}")
    for c in columns:
        if c not in df.columns:
            raise ValueError(f"Column '{c}' not found in data")
    require_array_columns(df, columns)


def _pop_std(x: Column) -> Column:
    n = F.size(x)
    std = let(seq_mean(x), lambda m: F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)) / n))
    return F.when(n > 0, std).otherwise(F.lit(float("nan")))


# The row kernels below are SQL text (one ``F.expr`` each): ``x`` is the
# double array, ``mask`` the plan mask, ``L``/``S`` lengths, ``scale`` a
# literal or a column, ``plus`` the coin.

def _sum(arr: str, term: Callable[[str], str]) -> str:
    a, v = S.var("a"), S.var("v")
    return f"aggregate({arr}, 0.0D, ({a}, {v}) -> {a} + {term(v)})"


def _mean(x: str) -> str:
    return f"(CASE WHEN size({x}) > 0 THEN {_sum(x, lambda v: v)} / size({x}) ELSE {S.NAN} END)"


def _fallback_sigma(x: str, sigma: str) -> str:
    mean_abs = f"({_sum(x, lambda v: f'abs({v})')} / size({x}))"
    return f"(CASE WHEN {sigma} = 0 THEN (CASE WHEN {mean_abs} > 0 THEN {mean_abs} ELSE 1.0D END) ELSE {sigma} END)"


def _root(A: str, B: str, C: str, plus: str) -> str:
    delta = f"({B} * {B} - 4 * {A} * {C})"
    return (
        f"(CASE WHEN {delta} < 0 THEN raise_error('no real magnitude gives the wanted standard deviation') "
        f"WHEN {plus} THEN (-{B} + sqrt({delta})) / (2 * {A}) ELSE (-{B} - sqrt({delta})) / (2 * {A}) END)"
    )


def constant_array(x: str, mask: str, L: str, S_: str, scale: str, plus: str) -> Column:
    """Constant-noise result for one row (see module doc). ``S == L`` cannot
    reach the target std and fails; sigma 0 uses mean(|x|) or 1 as base."""
    s2 = f"({scale} * {scale})"

    def with_mu(m):
        def with_sigma(sg):
            p = S.var("p")
            seg = (f"aggregate(zip_with({x}, {mask}, ({p}_u, {p}_w) -> named_struct('v', {p}_u, 'm', {p}_w)), 0.0D, "
                   f"({p}_acc, {p}_e) -> {p}_acc + CASE WHEN {p}_e.m THEN {p}_e.v - {m} ELSE 0.0D END)")
            Ld, Sd = f"CAST({L} AS DOUBLE)", f"CAST({S_} AS DOUBLE)"
            A = f"({Sd} * ({Ld} - {Sd}) / ({Ld} * {Ld}))"
            B = f"((2.0D / {Ld}) * {seg})"
            C = f"((-({s2} - 1)) * {sg} * {sg})"
            c_zero = f"({_fallback_sigma(x, sg)} * sqrt(({s2} - 1) * {Ld} * {Ld} / ({Sd} * ({Ld} - {Sd}))))"
            c = (f"(CASE WHEN {A} = 0 THEN raise_error('segment covers the whole sequence (S == L)') "
                 f"WHEN {sg} = 0 THEN {c_zero} ELSE {_root(A, B, C, plus)} END)")
            v, i = S.var("v"), S.var("i")
            return S.let(c, lambda cv: f"transform({x}, ({v}, {i}) -> CASE WHEN {mask}[{i}] THEN {v} + {cv} ELSE {v} END)")

        return S.let(f"sqrt({_sum(x, lambda v: f'({v} - {m}) * ({v} - {m})')} / {L})", with_sigma)

    return F.expr(S.let(_mean(x), with_mu))


def noise_array(row_id: str, column: str, seed: int, mask: str) -> Column:
    """R: standard normal draws on the planned points, 0 elsewhere."""
    m, i = S.var("m"), S.var("i")
    draw = S.normal(str(seed), row_id, S.s(column), i)
    return F.expr(f"transform({mask}, ({m}, {i}) -> CASE WHEN {m} THEN {draw} ELSE 0.0D END)")


def random_array(x: str, R: str, scale: str, plus: str) -> Column:
    """Random-noise result for one row: ``x + k·R`` with ``k`` solving
    ``Var(R)k² + 2Cov(x,R)k + (1−s²)σ² = 0``; ``Var(R) = 0`` leaves x unchanged."""
    s2 = f"({scale} * {scale})"

    def with_means(mm):
        mx, mr = f"{mm}.mx", f"{mm}.mr"
        n = f"size({x})"
        p = S.var("p")
        z = f"zip_with({x}, {R}, ({p}_u, {p}_w) -> named_struct('v', {p}_u, 'r', {p}_w))"
        var_r = f"({_sum(R, lambda r: f'({r} - {mr}) * ({r} - {mr})')} / {n})"
        cov = f"(aggregate({z}, 0.0D, ({p}_acc, {p}_e) -> {p}_acc + ({p}_e.v - {mx}) * ({p}_e.r - {mr})) / {n})"
        sigma = _fallback_sigma(x, f"sqrt({_sum(x, lambda v: f'({v} - {mx}) * ({v} - {mx})')} / {n})")
        A, B, C = var_r, f"({cov} * 2)", f"((1 - {s2}) * {sigma} * {sigma})"
        k = f"(CASE WHEN {A} = 0 THEN 0.0D ELSE {_root(A, B, C, plus)} END)"
        q = S.var("q")
        return f"(CASE WHEN {A} = 0 THEN {x} ELSE {S.let(k, lambda kv: f'transform({z}, {q} -> {q}.v + {kv} * {q}.r)')} END)"

    return F.expr(S.let(f"named_struct('mx', {_mean(x)}, 'mr', {_mean(R)})", with_means))


def _coin(seed: int, row_id: str, column: str) -> str:
    return S.coin(str(seed), row_id, S.s(column), S.s("coin"))


def _corrupt(
    df: DataFrame,
    method: str,
    columns: Sequence[str],
    row_fraction: float,
    segment_fraction: float,
    num_segments: int,
    std_scale: float,
    seed: int,
    id_col: str,
    out_prefix: str,
) -> DataFrame:
    _check_args(df, columns, std_scale)
    if num_segments < 1:
        raise ValueError("num_segments must be >= 1")
    out = df.withColumn("_L", F.size(F.col(columns[0])).cast("int"))
    same = F.lit(True)
    for c in columns[1:]:
        same = same & (F.size(F.col(c)) == F.col("_L"))
    out = out.withColumn("_plan", F.expr(plan_sql("_L", S.dbl(segment_fraction), str(num_segments), seed)))
    out = out.withColumn("_mask", F.expr(mask_sql("_plan", "_L"))).withColumn("_S", F.col("_plan.S"))
    out = choose_rows(out, row_fraction, seed, key=id_col, out="_chosen")
    for c in columns:
        x = f"CAST({c} AS ARRAY<DOUBLE>)"
        if method == "constant":
            res = constant_array(x, "_mask", "_L", "_S", S.dbl(std_scale), _coin(seed, id_col, c))
        else:
            out = out.withColumn("_R", noise_array(id_col, c, seed, "_mask"))
            res = random_array(x, "_R", S.dbl(std_scale), _coin(seed, id_col, c))
        x = F.col(c).cast("array<double>")
        guarded = F.when(~same, F.raise_error(F.lit(f"'{c}' and '{columns[0]}' differ in length")).cast("array<double>"))
        res = guarded.when(F.col("_chosen") & F.col("_plan").isNotNull(), res).otherwise(x)
        out = out.withColumn(out_prefix + c, res).drop("_R")
    return out.drop("_L", "_S", "_plan", "_mask", "_chosen")


def constant_noise(
    df: DataFrame,
    columns: Sequence[str],
    row_fraction: float = 1.0,
    segment_fraction: float = 0.2,
    num_segments: int = 2,
    std_scale: float = 2.0,
    seed: int = 0,
    id_col: str = "id",
    out_prefix: str = "",
) -> DataFrame:
    """Shift planned segments by one constant per row and column so the std
    becomes exactly ``std_scale`` times the original."""
    return _corrupt(df, "constant", columns, row_fraction, segment_fraction, num_segments, std_scale, seed,
                    id_col, out_prefix)


def random_noise(
    df: DataFrame,
    columns: Sequence[str],
    row_fraction: float = 1.0,
    segment_fraction: float = 0.2,
    num_segments: int = 2,
    std_scale: float = 2.0,
    seed: int = 0,
    id_col: str = "id",
    out_prefix: str = "",
) -> DataFrame:
    """Add scaled Gaussian noise on planned segments so the std becomes
    exactly ``std_scale`` times the original."""
    return _corrupt(df, "random", columns, row_fraction, segment_fraction, num_segments, std_scale, seed,
                    id_col, out_prefix)


# Defaults of the ad-hoc corruption job.
ADHOC_COLUMNS = ["heart_rate", "derived_speed", "altitude"]


def corrupt(df: DataFrame, method: str = "random", columns: Sequence[str] | None = None, std_scale: float = 2.0,
            segment_fraction: float = 0.2, num_segments: int = 2, seed: int = 42, **kw) -> DataFrame:
    """Ad-hoc corruption job with the reference defaults (random noise on
    heart rate, speed and altitude, scale 2, 20 % in 2 segments, seed 42)."""
    cols = list(columns or ADHOC_COLUMNS)
    fn = {"random": random_noise, "constant": constant_noise}.get(method)
    if fn is None:
        raise ValueError("method must be 'random' or 'constant'")
    return fn(df, cols, segment_fraction=segment_fraction, num_segments=num_segments, std_scale=std_scale,
              seed=seed, **kw)
