"""Counter-based random numbers from a hash of (seed, key…).

A draw depends only on its key, never on row order, partitioning or retries,
so a lost executor recomputes the same values and results do not change with
the cluster size. The hash is MD5 because it is available with identical
output in Spark and in SQL engines used as oracles.

Fixed values: 32-bit draws are the first 8 (and, for a second draw, the next
8) hex digits of ``md5(concat_ws('|', parts))``; uniforms are
``(u32 + 1) / 2^32`` so a logarithm is always finite.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0
TWO_PI = 2.0 * math.pi


def _key(parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def _hex_to_long(hexstr: Column) -> Column:
    return F.conv(hexstr, 16, 10).cast("long")


def u32(*parts) -> Column:
    """Uniform integer in [0, 2^32) keyed by ``parts``."""
    return _hex_to_long(F.substring(F.md5(_key(parts)), 1, 8))


def randint(low: int, high: int, *parts) -> Column:
    """Integer uniform on [low, high] (inclusive)."""
    return (u32(*parts) % (high - low + 1) + low).cast("int")
