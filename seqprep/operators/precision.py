"""Coordinate precision loss, its repair, and the point error report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.functions import rng
from seqprep.functions.arrays import let, neighbor_mean_fill
from seqprep.functions.geo import haversine_m
from seqprep.functions.missing import NAN, is_missing

COORDINATES = ["longitude", "latitude"]


def _round_to(x: Column, d: Column) -> Column:
    # the scale of round() must be a literal, hence one branch per scale
    return (
        F.when(d == 2, F.round(x, 2))
        .when(d == 3, F.round(x, 3))
        .when(d == 4, F.round(x, 4))
        .when(d == 5, F.round(x, 5))
        .otherwise(F.round(x, 6))
    )


def precision_loss(df: DataFrame, percentage: int = 10, seed: int = 0, columns: list[str] | None = None,
                   id_col: str = "id") -> DataFrame:
    """Each finite value, with probability ``percentage``%, is rounded to a
    random 2–6 decimals (hash draws keyed by seed, id, column, position).
    NULL sequences stay NULL; NaN/inf stay as they are."""
    cols = [c for c in (columns or COORDINATES) if c in df.columns]
    out = df
    for c in cols:
        loss = _loss(seed, F.col(id_col), c, percentage)
        out = out.withColumn(c, F.when(F.col(c).isNull(), F.col(c)).otherwise(F.transform(F.col(c), loss)))
    return out


def _loss(seed: int, ident: Column, c: str, percentage: int):
    def one(x, i):
        hit = rng.randint(1, 100, seed, ident, c, i, "hit") <= percentage
        d = rng.randint(2, 6, seed, ident, c, i, "dec")
        return F.when(is_missing(x) | ~hit, x).otherwise(_round_to(x, d))

    return one


def is_low_precision(x: Column, digits: int = 13, tol: float = 1e-14) -> Column:
    """``|x − round(x, digits)| < tol`` with NumPy's rounding (``rint(x·10^d)/10^d``)."""
    scale = float(10 ** digits)
    return F.abs(x - F.rint(x * scale) / scale) < tol


def precision_repair(df: DataFrame, columns: list[str] | None = None, digits: int = 13, tol: float = 1e-14) -> DataFrame:
    """Blank the values that look rounded (unless every value of that axis
    does) and fill each gap with the mean of its previous and next valid
    values; edges take the nearest. Values already missing are filled too, and
    ±inf counts as missing (a coordinate is finite).
    Empty sequences are unchanged; NULL passes through."""
    cols = [c for c in (columns or COORDINATES) if c in df.columns]
    out = df
    for c in cols:
        y = F.col(c)
        flagged = F.transform(y, lambda x: F.coalesce(is_low_precision(x, digits, tol), F.lit(False)))

        def blank(fl):
            # flags bound once per row; "all flagged" computed once, outside the per-point lambda
            return let(F.forall(fl, lambda f: f), lambda allf: F.transform(
                y,
                lambda x, i: F.when(fl[i] & ~allf, NAN()).when(is_missing(x), NAN()).otherwise(x),
            ))

        out = out.withColumn("_blank", let(flagged, blank))
        repaired = neighbor_mean_fill("_blank")
        out = out.withColumn(
            c, F.when(y.isNull() | (F.size(y) == 0), y).otherwise(repaired)
        ).drop("_blank")
    return out


def point_error(original: DataFrame, cleaned: DataFrame, id_col: str = "id") -> DataFrame:
    """Per point, the distance in metres between the original and the
    cleaned coordinate (all rows, all points; joined on id)."""
    a = original.select(F.col(id_col), F.col("latitude").alias("_lat0"), F.col("longitude").alias("_lon0"))
    b = cleaned.select(F.col(id_col), F.col("latitude").alias("_lat1"), F.col("longitude").alias("_lon1"))
    j = a.join(b, on=id_col, how="inner")
    z = F.arrays_zip(F.col("_lat0").alias("a"), F.col("_lon0").alias("b"), F.col("_lat1").alias("c"),
                     F.col("_lon1").alias("d"))
    pts = j.select(id_col, F.posexplode(z).alias("pos", "p"))
    return pts.select(
        id_col,
        F.col("pos").cast("long").alias("pos"),
        F.col("p.a").alias("lat_original"),
        F.col("p.c").alias("lat_cleaned"),
        F.col("p.b").alias("lon_original"),
        F.col("p.d").alias("lon_cleaned"),
        haversine_m(F.col("p.a"), F.col("p.b"), F.col("p.c"), F.col("p.d")).alias("error_m"),
    )
