"""Distributed primitives against brute force on small random inputs."""

import struct

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seqprep.operators import clean, inject
from seqprep.operators.split import split_cuts, temporal_split
from seqprep.plans.quantiles import exact_quantiles, ordered_key
from seqprep.plans import rank
from seqprep.plans.rank import part_number, rank_bands, ranked_keys
from seqprep.plans.state import materialize


def _rows(seed):
    """A hot group with a third of the rows, a NULL group, NULL and negative
    order values, ids that repeat."""
    rng = np.random.default_rng(seed)
    groups = [None] * 60 + [0] * 300 + [int(g) for g in rng.integers(1, 40, 540)]
    order = [None if rng.random() < 0.05 else int(v) for v in rng.integers(-250, 250, len(groups))]
    return [(i // 2 if i % 10 == 1 else i, g, o) for i, (g, o) in enumerate(zip(groups, order))]


def test_rank_bands_equal_window_ranks(spark):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "id long, g long, o long")
    got = rank_bands(df, ["g"], ["o", "id"], split_cuts, out="band")
    # rows that tie on (o, id) share the rank of the first of them
    w = Window.partitionBy("g").orderBy("o", "id")
    rank, n = F.rank().over(w) - 1, F.count(F.lit(1)).over(Window.partitionBy("g"))
    want = df.withColumn("band", sum(F.when(rank >= c, 1).otherwise(0) for c in split_cuts(n)))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.select("id", "g", "o", "band").collect()), key=key) == sorted(map(tuple, want.select("id", "g", "o", "band").collect()), key=key)
    assert got.count() == len(rows)


def test_ranked_keys_are_exact_ranks(spark):
    rows = _rows(2)
    df = spark.createDataFrame(rows, "id long, g long, o long")
    got = {(r["o"], r["id"]): (r["_rank"], r["_c"], r["_n"]) for r in ranked_keys(df, [], ["o", "id"]).collect()}
    ordered = sorted(((o, i) for i, _, o in rows), key=lambda k: (k[0] is not None, k))
    for k in set(ordered):
        assert got[k] == (ordered.index(k), ordered.count(k), len(rows))


def test_temporal_split_keeps_every_row_and_the_order_of_time(spark):
    rows = [(i, None if i % 9 == 0 else i % 3, [] if i % 7 == 0 else None if i % 11 == 0 else [1000 * (i - 60), 5]) for i in range(120)]
    df = spark.createDataFrame(rows + rows[:5], "id long, userId long, timestamp array<long>")
    got = temporal_split(df).collect()
    assert len(got) == 125
    place = {"train": 0, "val": 1, "test": 2}
    by_user = {}
    for r in got:
        first = r["timestamp"][0] if r["timestamp"] else None
        by_user.setdefault(r["userId"], []).append(((first is not None, first or 0, r["id"]), place[r["split"]]))
    assert set(by_user) == {None, 0, 1, 2}
    for keys in by_user.values():
        bands = [b for _, b in sorted(keys)]
        assert bands == sorted(bands) and set(bands) == {0, 1, 2}


def test_injection_cuts_follow_the_proportions(spark):
    for n in (0, 1, 7, 100, 1003):
        cuts = spark.range(1).select(*inject.injection_cuts(F.lit(n))).first()
        assert list(cuts) == sorted(cuts) and len(cuts) == 13
        if n == 1003:
            assert cuts[6] == 501 and cuts[1] == 150 and cuts[3] == 300 and cuts[0] == 120


def test_state_is_measured_by_its_content(spark):
    short = materialize(spark.range(100).select("id", F.array_repeat(F.lit(1), 2).alias("a")))
    long = materialize(spark.range(100).select("id", F.array_repeat(F.lit(1), 5000).alias("a")))
    assert short.rows == long.rows == 100
    assert short.est_bytes < 20_000 and long.est_bytes > 100 * 5000 * 8
    assert long.side(1000) is long.df


def test_ordered_key_is_the_bits_of_a_double(spark):
    rng = np.random.default_rng(5)
    edges = [5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, 1 / 3, 2.0**1000, 2.0**-900]
    values = edges + [2.0**k for k in range(-1074, 1024)] + list(rng.standard_normal(500) * 10.0 ** rng.integers(-300, 300, 500))
    values += [np.nextafter(x, 0) for x in values] + [-x for x in values] + [0.0, -0.0]
    df = spark.createDataFrame([(float(x),) for x in values], "x double")
    for r in df.select("x", ordered_key(F.col("x")).alias("k")).collect():
        bits = struct.unpack(">q", struct.pack(">d", abs(r["x"])))[0]
        assert r["k"] == (-bits if r["x"] < 0 else bits)


def test_quantiles_of_geometric_values(spark):
    values = [2.0**k for k in range(-1000, 1001)]
    got = exact_quantiles(spark.createDataFrame([(x,) for x in values], "x double"), [], "x", [0.005, 0.5, 0.995]).first()
    assert np.allclose([got["q0"], got["q1"], got["q2"]], np.quantile(values, [0.005, 0.5, 0.995]), rtol=1e-14, atol=0)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    data = {
        "a": rng.normal(0, 1, 800),
        "b": np.concatenate([np.full(600, 7.0), rng.normal(7, 2, 300)]),  # a hot value
        "c": rng.integers(0, 3, 40).astype(float),
        "d": np.array([1.5]),
        "e": np.array([-1.7e308, 1.7e308, 0.0, 5e-324, -1.0, 1e-300]),  # the width of the range overflows
        None: np.array([3.0, 1.0, 2.0]),
    }
    rows = [(k, float(x)) for k, v in data.items() for x in v] + [("a", None), ("z", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.005, 0.5, 0.995, 0.0, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "x", probs).collect()}
    assert set(got) == set(data)
    for k, v in data.items():
        if k == "e":
            assert got[k]["q1"] in (0.0, 5e-324) and got[k]["q3"] == -1.7e308 and got[k]["q4"] == 1.7e308
            continue
        want = np.quantile(v, probs)
        for i, q in enumerate(want):
            assert abs(got[k][f"q{i}"] - q) <= 1e-12 * max(1.0, abs(q)), (k, probs[i])
        assert got[k]["n"] == v.size
    whole = exact_quantiles(df, [], "x", [0.5]).collect()
    assert len(whole) == 1


def test_bounds_of_a_null_group_are_its_own(spark):
    cfg = clean.CleaningConfig(seq_float_cols=["y"], min_seq_len=1, smooth=False)
    rows = [(i, None if i < 50 else "a", [1, 2], [0, 1], [float(i), float(i)]) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, g string, timestamp array<long>, time_elapsed array<long>, y array<double>")
    bounds = {r["g"]: (r["lo"], r["hi"], r["median"]) for r in clean.fit_bounds(df, cfg, ["g"]).collect()}
    assert bounds[None][2] == 24.5 and bounds["a"][2] == 74.5 and bounds[None][:2] == (0.0, 49.0)
    out = clean.clean(df, clean.fit_bounds(df, cfg, ["g"]), cfg, ["g"])
    assert out.count() == 100 and out.where("id = 0").first()["y"] == [0.0, 0.0]


def test_part_files_are_ordered_by_number(spark):
    names = [f"part-{n:05d}-4d2c8a9e-0c00.c000.snappy.parquet" for n in (100_001, 99_999, 7, 100_000)]
    df = spark.createDataFrame([(n,) for n in names], "f string").select(part_number(F.col("f")).alias("n"))
    assert [r["n"] for r in df.collect()] == [100_001, 99_999, 7, 100_000]
    paths = spark.createDataFrame([("file:/a/part-7/part-100000-x.parquet",)], "f string")
    assert paths.select(part_number(F.col("f")).alias("n")).first()["n"] == 100_000


def test_ranges_grow_with_the_keys(spark, monkeypatch):
    """As many ranges as the keys' bytes ask for; the ranks stay the same."""
    df = spark.createDataFrame(_rows(3), "id long, g long, o long")
    few = sorted(map(repr, ranked_keys(df, ["g"], ["o", "id"]).collect()))
    asked = []
    ranges = type(df).repartitionByRange
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, n, *order: (asked.append(n), ranges(self, n, *order))[1])
    monkeypatch.setattr(rank, "RANGE_BYTES", 1000)
    many = sorted(map(repr, ranked_keys(df, ["g"], ["o", "id"]).collect()))
    assert asked[0] > 20 and many == few


def test_cleaning_counts_in_the_same_pass(spark):
    cfg = clean.CleaningConfig(seq_float_cols=["x"], seq_int_cols=["timestamp"], min_seq_len=2)
    rows = [(1, [1, 2], [1.0, 2.0]), (2, [1], [1.0]), (3, [1, 2], [1.0]), (4, None, None), (5, [1, 2, 3], [None, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "id long, timestamp array<long>, x array<double>")
    out, report = clean.clean_observed(df, clean.fit_bounds(df, cfg), cfg)
    kept = out.collect()
    assert sorted(r["id"] for r in kept) == [1, 5] and report.get == {"kept": 2, "dropped": 3}
    empty, none = clean.clean_observed(df.where("false"), clean.fit_bounds(df, cfg), cfg, name="nothing")
    assert empty.collect() == [] and none.get == {"kept": 0, "dropped": 0}
