"""Sequence kernels as Spark SQL higher-order-function text.

Each builder takes SQL text for its inputs (a column name, a lambda
variable or any expression) and returns SQL text; ``F.expr`` turns the
result into one Column with a single call. Lambda variables get unique
names so nested kernels never shadow each other. Arithmetic is written in
the same order as the NumPy definitions the kernels restate.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable

_ids = itertools.count()

NAN = "CAST('NaN' AS DOUBLE)"
INF = "CAST('Infinity' AS DOUBLE)"
EMPTY_INT = "CAST(array() AS ARRAY<INT>)"


def var(prefix: str = "v") -> str:
    return f"{prefix}_{next(_ids)}"


def dbl(x: float) -> str:
    """A double literal that parses back to exactly ``x``."""
    return f"{float(x)!r}D"


def let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    v = var("l")
    return f"element_at(transform(array({value}), {v} -> {body(v)}), 1)"


def positions(s: str) -> str:
    """``[0 … size-1]``; empty for empty or NULL (``sequence(0,-1)`` counts down)."""
    return f"(CASE WHEN coalesce(size({s}), 0) > 0 THEN sequence(0, size({s}) - 1) ELSE {EMPTY_INT} END)"


def is_missing(x: str) -> str:
    return f"({x} IS NULL OR isnan({x}) OR abs({x}) = {INF})"


def bound(kernel: Callable[..., str]) -> Callable[..., str]:
    """A kernel whose input is evaluated once per row. Catalyst puts a column's
    derivation wherever the column is read, also inside a lambda, where it would
    be computed again for every element; a lambda variable it leaves alone."""

    @functools.wraps(kernel)
    def build(y: str, *args, **kwargs) -> str:
        return let(y, lambda v: kernel(v, *args, **kwargs))

    return build


def canonical(s: str) -> str:
    x = var("x")
    return f"transform({s}, {x} -> CASE WHEN {is_missing(x)} THEN {NAN} ELSE CAST({x} AS DOUBLE) END)"


# ------------------------------------------------------------------ medians

def median_sorted(s: str) -> str:
    h = f"(size({s}) div 2)"
    return (
        f"(CASE WHEN size({s}) = 0 THEN {NAN} WHEN size({s}) % 2 = 1 THEN {s}[{h}] "
        f"ELSE ({s}[{h} - 1] + {s}[{h}]) / 2 END)"
    )


def nan_median(s: str) -> str:
    z = var("z")
    return let(f"array_sort(filter({s}, {z} -> NOT {is_missing(z)}))", median_sorted)


@bound
def median(s: str) -> str:
    z = var("z")
    return f"(CASE WHEN exists({s}, {z} -> isnan({z})) THEN {NAN} ELSE {let(f'array_sort({s})', median_sorted)} END)"


# ------------------------------------------------------------------ gap fills

def valid_positions(y: str) -> str:
    i = var("i")
    return f"filter({positions(y)}, {i} -> NOT isnan({y}[{i}]))"


def _gap_fill(y: str, v: str, fill: Callable[[str, str, str], str]) -> str:
    """Fill missing points from the list ``v`` of valid positions (O(n)):
    repeat the first valid value before ``v[0]``, emit ``y[a]`` and the
    filled ``a+1 … b-1`` for consecutive valid ``a < b``, repeat the last
    valid value from ``v[-1]`` on."""
    n, m = f"size({y})", f"size({v})"
    first, last = f"{v}[0]", f"element_at({v}, -1)"
    head = f"array_repeat({y}[{first}], {first})"
    tail = f"array_repeat({y}[{last}], {n} - {last})"
    k, j = var("k"), var("j")
    a, b = f"{v}[{k}]", f"{v}[{k} + 1]"
    middle = f"flatten(transform(sequence(0, {m} - 2), {k} -> transform(sequence({a}, {b} - 1), {j} -> {fill(a, b, j)})))"
    return (
        f"(CASE WHEN {y} IS NULL THEN {y} WHEN {m} = 0 OR {m} = {n} THEN {y} "
        f"WHEN {m} = 1 THEN concat({head}, {tail}) ELSE concat({head}, {middle}, {tail}) END)"
    )


@bound
def interpolate(y: str) -> str:
    """``y[a] + (j-a)*((y[b]-y[a])/(b-a))``, as ``np.interp``."""

    def lin(a, b, j):
        return f"({y}[{a}] + ({j} - {a}) * (({y}[{b}] - {y}[{a}]) / ({b} - {a})))"

    return let(valid_positions(y), lambda v: _gap_fill(y, v, lin))


@bound
def neighbor_mean_fill(y: str) -> str:
    def mean_of_neighbours(a, b, j):
        return f"(CASE WHEN {j} = {a} THEN {y}[{a}] ELSE ({y}[{a}] + {y}[{b}]) / 2 END)"

    return let(valid_positions(y), lambda v: _gap_fill(y, v, mean_of_neighbours))


# ------------------------------------------------------------------ rolling windows

def _edge_padded(y: str, pad: int) -> str:
    return f"concat(array_repeat({y}[0], {pad}), {y}, array_repeat(element_at({y}, -1), {pad}))"


@bound
def rolling_median(y: str, window: int) -> str:
    if window <= 1:
        return y
    pad = window // 2
    x, i = var("x"), var("i")

    def body(p):
        return f"transform({y}, ({x}, {i}) -> {nan_median(f'slice({p}, {i} + 1, {window})')})"

    return f"(CASE WHEN coalesce(size({y}), 0) = 0 THEN {y} ELSE {let(_edge_padded(y, pad), body)} END)"


@bound
def moving_average(y: str, window: int) -> str:
    if window % 2 == 0:
        raise ValueError(f"moving_average needs an odd window, got {window}")
    if window <= 1:
        return y
    pad = window // 2
    weight = dbl(1.0 / window)
    x, i, acc, z = var("x"), var("i"), var("acc"), var("z")

    def body(p):
        return (
            f"transform({y}, ({x}, {i}) -> aggregate(slice({p}, {i} + 1, {window}), 0.0D, "
            f"({acc}, {z}) -> {acc} + {z} * {weight}))"
        )

    return f"(CASE WHEN coalesce(size({y}), 0) = 0 THEN {y} ELSE {let(_edge_padded(y, pad), body)} END)"


# ------------------------------------------------------------------ running sums

SCAN_BLOCK = 256


@bound
def running_sum(y: str, kind: str) -> str:
    """Sum of the elements up to each position, one after another from the
    first; a NULL counts as 0. ``kind`` is the SQL type of the sums. A fold
    that appends to one long list copies it for every element, so blocks of
    ``SCAN_BLOCK`` sums are folded and put together at the end."""
    b, acc, x, a = var("b"), var("acc"), var("x"), var("a")
    zero, none, nested = f"CAST(0 AS {kind})", f"CAST(array() AS ARRAY<{kind}>)", f"CAST(array() AS ARRAY<ARRAY<{kind}>>)"

    def step(s):
        return f"named_struct('s', {s}, 'o', array_append({a}.o, {s}))"

    block = (
        f"aggregate(slice({y}, {b} + 1, {SCAN_BLOCK}), named_struct('s', {acc}.s, 'o', {none}), "
        f"({a}, {x}) -> {let(f'CAST({a}.s + coalesce({x}, {zero}) AS {kind})', step)})"
    )
    joined = let(block, lambda r: f"named_struct('s', {r}.s, 'o', array_append({acc}.o, {r}.o))")
    scan = (
        f"aggregate(sequence(0, size({y}) - 1, {SCAN_BLOCK}), named_struct('s', {zero}, 'o', {nested}), "
        f"({acc}, {b}) -> {joined}, {acc} -> flatten({acc}.o))"
    )
    return f"(CASE WHEN coalesce(size({y}), 0) = 0 THEN CAST({y} AS ARRAY<{kind}>) ELSE {scan} END)"


# ------------------------------------------------------------------ runs

def mask_runs(mask: str) -> str:
    """Half-open runs of true values as ``array<struct<start:int, end:int>>``."""

    def body(m):
        i, e, a, b = var("i"), var("e"), var("a"), var("b")
        starts = f"filter({positions(m)}, {i} -> {m}[{i}] AND (CASE WHEN {i} = 0 THEN true ELSE NOT {m}[{i} - 1] END))"
        ends = (
            f"filter(transform({positions(m)}, {i} -> {i} + 1), "
            f"{e} -> {m}[{e} - 1] AND (CASE WHEN {e} = size({m}) THEN true ELSE NOT {m}[{e}] END))"
        )
        return f"zip_with({starts}, {ends}, ({a}, {b}) -> named_struct('start', {a}, 'end', {b}))"

    return let(mask, body)


# ------------------------------------------------------------------ cleaning steps

def clip_value(x: str, lo: str, hi: str) -> str:
    """``np.clip`` that keeps NaN."""
    return f"(CASE WHEN isnan({x}) THEN {x} WHEN {x} < {lo} THEN {lo} WHEN {x} > {hi} THEN {hi} ELSE {x} END)"


@bound
def fill_and_clip(y: str, bounds: str, do_clip: bool) -> str:
    """All-missing non-empty sequences take the median (0.0 without one), then
    clip to ``bounds.lo``/``bounds.hi`` (NaN kept)."""
    med = f"{bounds}.median"
    fill = f"(CASE WHEN {med} IS NULL OR isnan({med}) THEN 0.0D ELSE {med} END)"
    x, z = var("x"), var("z")
    filled = (
        f"(CASE WHEN size({y}) > 0 AND NOT exists({y}, {z} -> NOT {is_missing(z)}) "
        f"THEN transform({y}, {x} -> {fill}) ELSE {y} END)"
    )
    if not do_clip:
        return filled
    c = var("c")
    return f"transform({filled}, {c} -> {clip_value(c, f'{bounds}.lo', f'{bounds}.hi')})"


@bound
def coerce_float(s: str, element: str) -> str:
    """NULL elements → NaN, numeric strings parsed, one unparsable element
    empties the sequence, ±inf → NaN; a NULL sequence becomes empty."""
    x = var("x")
    if element == "string":
        bad = f"exists({s}, {x} -> {x} IS NOT NULL AND try_cast({x} AS DOUBLE) IS NULL)"
        y = var("y")
        base = f"(CASE WHEN {bad} THEN CAST(array() AS ARRAY<DOUBLE>) ELSE transform({s}, {y} -> try_cast({y} AS DOUBLE)) END)"
    else:
        base = f"transform({s}, {x} -> CAST({x} AS DOUBLE))"
    return f"(CASE WHEN {s} IS NULL THEN CAST(array() AS ARRAY<DOUBLE>) ELSE {canonical(base)} END)"


@bound
def coerce_int(s: str, element: str) -> str:
    """Floats truncate; strings must be whole numbers (read exactly); any NULL,
    NaN, ±inf or unreadable string empties the sequence; a NULL sequence
    becomes empty."""
    x, y = var("x"), var("y")
    empty = "CAST(array() AS ARRAY<BIGINT>)"
    if element in ("double", "float"):
        bad = f"exists({s}, {x} -> {is_missing(x)})"
        vals = s
    elif element == "string":
        vals = f"transform({s}, {y} -> try_cast({y} AS BIGINT))"
        bad = f"exists({vals}, {x} -> {x} IS NULL)"
    else:
        bad = f"exists({s}, {x} -> {x} IS NULL)"
        vals = s
    z = var("z")
    return f"(CASE WHEN {s} IS NULL OR {bad} THEN {empty} ELSE transform({vals}, {z} -> CAST({z} AS BIGINT)) END)"


# ------------------------------------------------------------------ hash RNG (same draws as functions.rng)

def s(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def _key(parts) -> str:
    return "concat_ws('|', " + ", ".join(f"CAST({p} AS STRING)" for p in parts) + ")"


def _hex32(digest: str, first: int) -> str:
    return f"CAST(conv(substring({digest}, {first}, 8), 16, 10) AS BIGINT)"


def u32(*parts: str) -> str:
    """Uniform integer in [0, 2^32) keyed by the SQL expressions ``parts``."""
    return _hex32(f"md5({_key(parts)})", 1)


def normal(*parts: str) -> str:
    """Standard normal by Box–Muller from the two halves of one digest."""

    def body(d):
        v1 = f"(({_hex32(d, 1)} + 1) / 4294967296.0D)"
        v2 = f"(({_hex32(d, 9)} + 1) / 4294967296.0D)"
        return f"(sqrt(ln({v1}) * -2.0D) * cos({dbl(6.283185307179586)} * {v2}))"

    return let(f"md5({_key(parts)})", body)


def coin(*parts: str) -> str:
    return f"({u32(*parts)} < 2147483648)"
