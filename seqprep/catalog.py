"""Registry of the queries the driver runs, each with its SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator on tables
derived from the test data; ``ORACLES[name]`` is the DuckDB restatement.
Array results are returned in long form ``(id, pos, …)`` and doubles are
rounded to 6 decimals in both, so the comparison sees values, not last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = expand_round6(sql)
        return fn

    return deco


def round6(x: Column) -> Column:
    """Round to 6 decimals for the oracle comparison.

    ``round(x·1e6·(1+1e-12))/1e6`` with -0.0 written as 0.0. The tiny relative
    nudge moves exact decimal ties (a mean of 2-decimal values over 32
    points ends in ...5 at the 7th decimal) off the rounding edge, so
    last-bit differences between engines' summation orders do not flip
    them. Presentation only; library results are not rounded."""
    r = F.round(x * 1e6 * (1 + 1e-12))
    return F.when(r == 0, F.lit(0.0)).otherwise(r / 1e6)


def r6(c: Column | str) -> Column:
    return round6(F.col(c) if isinstance(c, str) else c)


def expand_round6(sql: str) -> str:
    """Rewrite every ``round(E, 6)`` in an oracle into the same scaled rounding."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i : j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        comma = -1
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner_arg = sql[comma + 1 : k].strip() if comma >= 0 else ""
        if comma < 0 or inner_arg != "6":
            out.append(sql[i : j + 6])
            i = j + 6
            continue
        e = expand_round6(sql[j + 6 : comma])
        out.append(sql[i:j])
        out.append(
            f"(CASE WHEN round(({e})*1e6*(1+1e-12)) = 0 THEN 0.0::DOUBLE ELSE round(({e})*1e6*(1+1e-12))/1e6 END)"
        )
        i = k + 1


def long_form(df: DataFrame, keys: list[str], arrays: dict[str, str], rounded: bool = True) -> DataFrame:
    """Explode aligned array columns into one row per point: keys, pos, values."""
    z = F.arrays_zip(*[F.col(src).alias(out) for out, src in arrays.items()])
    exploded = df.select(*keys, F.posexplode(z).alias("pos", "_p"))
    vals = []
    for out in arrays:
        v = F.col("_p")[out]
        dt = dict(df.select(*[F.col(s).alias(o) for o, s in arrays.items()]).dtypes)[out]
        if rounded and dt.startswith("array<double"):
            v = round6(v)
        vals.append(v.alias(out))
    return exploded.select(*keys, F.col("pos").cast("long").alias("pos"), *vals)


# importing the query modules fills the registries
from seqprep.queries import (  # noqa: E402,F401
    q_tables,
    q_kernels,
    q_clean,
    q_corrupt,
    q_model,
    q_io,
)
