"""Exact ranks and rank cuts without a window over a whole group.

``ranked_keys`` sorts the distinct (group, order) keys with their row counts
by ranges -- a group with a third of all rows spreads over many ranges -- and
writes them. A key's place is the running count inside its file plus the
counts of the files before it; less the place of its group's first key, that
is its rank in the group. Only keys and counts are shuffled and windowed, one
file at a time.

``rank_bands`` needs just the few keys at which a rank cut falls: they form a
small table, one row per group, that every row is compared with in place. The
wide rows are not shuffled, nothing is joined on row identifiers, so rows are
neither lost nor multiplied: null group keys form a group (null-safe joins),
null order values come first, and rows that tie on all order columns share the
band of the first of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqprep.plans.state import State, materialize
from seqprep.sources.io import write_scratch_table


def null_safe_join(df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equality join in which NULL keys match each other; keeps ``df``'s keys."""
    if not on:
        raise ValueError("null_safe_join needs key columns")
    renamed = side.withColumnsRenamed({c: f"_side_{c}" for c in on})
    cond = None
    for c in on:
        eq = F.col(c).eqNullSafe(F.col(f"_side_{c}"))
        cond = eq if cond is None else cond & eq
    return df.join(renamed, cond, how).drop(*[f"_side_{c}" for c in on])


def part_number(file: Column) -> Column:
    """Number of a part file from its name or path. Names have five digits up to
    part 99,999 and more beyond, so they do not sort as numbers do."""
    return F.regexp_extract(file, r"part-([0-9]+)[^/]*$", 1).cast("long")


# Keys sorted and numbered by one task, in bytes.
RANGE_BYTES = 64 * 1024 * 1024


def ranked_keys(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Distinct keys with ``_c`` (rows that have the key), ``_rank`` (0-based
    rank of the first of them in its group) and ``_n`` (rows of the group).

    The keys are written and measured before they are sorted: there are as many
    ranges as their bytes ask for, and the sampling of the range bounds does not
    aggregate the rows a second time."""
    pc, oc = list(partition_cols), list(order_cols)
    measured = materialize(df.groupBy(*pc, *oc).agg(F.count(F.lit(1)).alias("_c")))
    keys = measured.df
    order = [F.col(c).asc_nulls_first() for c in [*pc, *oc]]
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-measured.est_bytes // RANGE_BYTES))
    table = write_scratch_table(keys.repartitionByRange(parts, *order).sortWithinPartitions(*order)).select(
        "*", part_number(F.col("_metadata.file_name")).alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    # part files are numbered in range order; one row per file here
    totals = table.groupBy("_file").agg(F.sum("_c").alias("_t"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_file", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_file").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = table.join(base, "_file").withColumn("_at", F.col("_base") + F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    placed = placed.select(*pc, *oc, "_c", "_at")
    if not pc:
        total = placed.agg(F.sum("_c").alias("_n"))
        return placed.join(F.broadcast(total)).select(*oc, "_c", F.col("_at").alias("_rank"), "_n")
    groups = placed.groupBy(*pc).agg(F.min("_at").alias("_start"), F.sum("_c").alias("_n"))
    return null_safe_join(placed, groups, pc).select(*pc, *oc, "_c", (F.col("_at") - F.col("_start")).alias("_rank"), "_n")


def cut_keys(
    df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str], cuts: Callable[[Column], list[Column]]
) -> State:
    """Per group its rows ``_n`` and, in ``_cuts``, the key each rank cut falls
    on: ``(i, key, inside)``; ``inside`` tells that rows with that key began
    before the cut (they tie, and stay below it)."""
    pc, oc = list(partition_cols), list(order_cols)
    keys = ranked_keys(df, pc, oc)
    wanted = F.filter(
        F.transform(F.array(*[c.cast("long") for c in cuts(F.col("_n"))]), lambda c, i: F.struct(i.alias("i"), c.alias("at"))),
        lambda x: (x["at"] >= F.col("_rank")) & (x["at"] < F.col("_rank") + F.col("_c")),
    )
    hit = F.transform(wanted, lambda x: F.struct(
        x["i"].alias("i"), F.struct(*[F.col(c) for c in oc]).alias("key"), (x["at"] > F.col("_rank")).alias("inside")
    ))
    # the first key of a group carries its size even where no cut falls on it
    rows = keys.withColumn("_hit", hit).filter((F.size("_hit") > 0) | (F.col("_rank") == 0))
    agg = [F.max("_n").alias("_n"), F.flatten(F.collect_list("_hit")).alias("_cuts")]
    return materialize(rows.groupBy(*pc).agg(*agg) if pc else rows.agg(*agg))


def _cut(i: int) -> Column:
    return F.get(F.filter("_cuts", lambda x: x["i"] == i), 0)


def rank_bands(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: Sequence[str],
    cuts: Callable[[Column], list[Column]],
    out: str = "band",
) -> DataFrame:
    """Add ``out``: how many of the rank cuts (a rising list that depends on the
    group's number of rows) are at or below the row's rank in its group."""
    pc, oc = list(partition_cols), list(order_cols)
    state = cut_keys(df, pc, oc, cuts)
    side = state.side()
    joined = null_safe_join(df, side, pc) if pc else df.join(F.broadcast(side))
    here = F.struct(*[F.col(c) for c in oc])
    band = F.lit(0)
    for i, cut in enumerate(cuts(F.col("_n"))):
        at = _cut(i)
        above = F.when(cut <= 0, True).when(cut >= F.col("_n"), False).otherwise(
            (here > at["key"]) | ((here == at["key"]) & ~at["inside"])
        )
        band = band + above.cast("int")
    return joined.withColumn(out, band).drop("_n", "_cuts")
