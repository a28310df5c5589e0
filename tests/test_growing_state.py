"""State that grows: moments merged over batches, stored versions, files that come later."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqprep.operators import clean, scale
from seqprep.sources import fixtures as fx
from seqprep.sources import io
from seqprep.streaming import stream

SF = "/root/testdata/sf0.001"
SCHEMA = "userId long, a array<double>, b array<long>"


def _rows(seed, users):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(60):
        n = int(rng.integers(0, 9))
        user = users[i % len(users)] if i % 3 else users[0]  # one user has a third of all rows
        rows.append((user, (1e9 + rng.normal(0, 1e-2, n)).tolist(), rng.integers(-5, 6, n).tolist()))
    return rows


def test_merged_moments_equal_one_fit(spark):
    first, second = _rows(1, [1, 2, None]), _rows(2, [1, 3, None])
    first.append((2, None, [7]))
    second.append((3, [None, 1e9, float("nan")], []))
    cols = ["a", "b"]
    parts = [scale.fit_user_moments(spark.createDataFrame(rows, SCHEMA), cols) for rows in (first, second)]
    merged = scale.user_stats(scale.merge_user_moments(*parts, columns=cols), cols).collect()
    assert len(merged) == 4
    for r in merged:
        for i, c in enumerate(cols):
            x = np.array([v for row in first + second if row[0] == r["userId"] for v in (row[1 + i] or []) if v is not None])
            want = (x.mean(), x.std() + scale.STD_EPS) if len(x) else (None, None)
            if len(x) and math.isnan(want[0]):
                assert math.isnan(r[f"{c}_mean"]) and math.isnan(r[f"{c}_std"])
            elif len(x):
                # the spread is 1e-11 of the values: sums of squares would lose it
                assert r[f"{c}_mean"] == pytest.approx(want[0], rel=1e-14)
                assert r[f"{c}_std"] == pytest.approx(want[1], rel=1e-4)
            else:
                assert (r[f"{c}_mean"], r[f"{c}_std"]) == want


def test_moments_without_rows_or_points(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert scale.fit_user_moments(empty, ["a"]).count() == 0
    none = scale.user_stats(scale.fit_user_moments(spark.createDataFrame([(1, [], None)], SCHEMA), ["a", "b"]), ["a", "b"]).first()
    assert none.asDict() == {"userId": 1, "a_mean": None, "a_std": None, "b_mean": None, "b_std": None}


def test_moments_keep_points_in_their_row(spark):
    df = spark.createDataFrame(_rows(1, [1, 2]), SCHEMA)
    plan = df.select(scale._row_moments("a"))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan


def test_state_versions(spark, tmp_path):
    path = str(tmp_path / "state")
    with pytest.raises(io.MissingInputError):
        io.read_state(spark, path)
    io.write_state(spark.range(3), path)
    old = io.read_state(spark, path)
    # a version that was written but not named yet does not count
    spark.range(50).write.parquet(f"{path}/version-unfinished")
    assert io.read_state(spark, path).count() == 3
    io.write_state(old.select((F.col("id") + 10).alias("id")), path)  # made from the version it follows
    assert sorted(r["id"] for r in io.read_state(spark, path).collect()) == [10, 11, 12]
    assert sorted(r["id"] for r in old.collect()) == [0, 1, 2]


def test_arriving_files_are_cleaned_once(spark, tmp_path):
    cfg = clean.CleaningConfig(seq_float_cols=["heart_rate"], seq_int_cols=["timestamp"])
    rows = io.write_scratch_table(fx.dirty(spark, SF).select("id", "sport", "timestamp", "heart_rate"))
    path, sink, marks = (str(tmp_path / k) for k in ("in", "out", "marks"))

    def run():
        stream.clean_arriving_files(spark, path, rows.schema, sink, marks, cfg, dataset="/(part-[^/]*)$").awaitTermination()
        back = spark.read.parquet(sink)
        return back.count(), back.select("dataset").distinct().count()

    rows.where("id % 2 = 0").coalesce(1).write.parquet(path)
    first = run()
    assert first[1] == 1 and run() == first  # nothing new
    rows.where("id % 2 = 1").coalesce(1).write.mode("append").parquet(path)
    assert run()[1] == 2
    for part in (0, 1):
        mine = rows.where(f"id % 2 = {part}")
        want = clean.fit_transform(mine, cfg).select("id", "heart_rate").collect()
        got = spark.read.parquet(sink).where(f"id % 2 = {part}").select("id", "heart_rate").collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))
