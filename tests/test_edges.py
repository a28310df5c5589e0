"""Edge cases of FIXTURES.md §3 and the contracts of each operator."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqprep.operators import clean, derive, encode, evaluate, scale, split, windows


def test_split_cut_n90_and_n10(spark):
    rows = [(1, i, [1000 + i]) for i in range(90)] + [(2, 100 + i, [5000 + i]) for i in range(10)]
    df = spark.createDataFrame(rows, "userId long, id long, timestamp array<long>")
    out = split.temporal_split(df).groupBy("userId", "split").count().collect()
    got = {(r["userId"], r["split"]): r["count"] for r in out}
    assert (got[(1, "train")], got[(1, "val")], got[(1, "test")]) == (61, 10, 19)
    assert (got[(2, "train")], got[(2, "val")], got[(2, "test")]) == (6, 1, 3)


def test_split_is_temporal_per_user(spark):
    rows = [(7, i, [10_000 - i * 86400 * 3]) for i in range(20)]  # ids reversed in time
    df = spark.createDataFrame(rows, "userId long, id long, timestamp array<long>")
    res = {r["id"]: r["split"] for r in split.temporal_split(df).collect()}
    # latest rows (smallest id here) are the test rows
    assert res[0] == "test" and res[19] == "train"


def _clean_input(spark):
    ts = [0, 1, 2, 3, 4]
    rows = [
        (1, ts, [float("nan"), 1.0, 2.0, float("nan"), 3.0]),
        (2, ts, [float("nan")] * 5),
        (3, ts, None),
        (4, [0, 1], [1.0, 2.0]),
    ]
    df = spark.createDataFrame(rows, "id long, timestamp array<long>, heart_rate array<double>")
    # a NULL inside elapsed time empties it on coercion; the repair recomputes it
    te = F.when(F.col("id") == 1, F.array(F.lit(0), F.lit(None), F.lit(2), F.lit(3), F.lit(4)).cast("array<long>"))
    return df.withColumn("time_elapsed", te.otherwise(F.transform("timestamp", lambda t: t - F.col("timestamp")[0])))


def test_clean_edges(spark):
    df = _clean_input(spark)
    cfg = clean.CleaningConfig(seq_float_cols=["heart_rate"], clip=False, smooth=False)
    out = {r["id"]: r for r in clean.fit_transform(df, cfg).collect()}
    assert out[1]["heart_rate"] == [1.0, 1.0, 2.0, 2.5, 3.0]
    # all-missing: the column median of the finite points (1, 2, 3) → 2.0
    assert out[2]["heart_rate"] == [2.0] * 5
    # NULL sequence: length 0, dropped by the validation; too short: dropped
    assert 3 not in out and 4 not in out
    # elapsed time with a NULL is repaired from the timestamps
    assert out[1]["time_elapsed"] == [0, 1, 2, 3, 4]


def test_clean_requires_columns(spark):
    df = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError, match="Missing required columns"):
        clean.fit_bounds(df)


def test_clip_keeps_nan(spark):
    from seqprep.operators.clean import clip_value

    df = spark.createDataFrame([(float("nan"),), (5.0,), (-5.0,)], "x double")
    got = [r[0] for r in df.select(clip_value(F.col("x"), F.lit(-1.0), F.lit(1.0))).collect()]
    assert math.isnan(got[0]) and got[1:] == [1.0, -1.0]


def test_speed_zero_dt(spark):
    df = spark.createDataFrame(
        [(1, [0, 0], [40.0, 40.001], [10.0, 10.0]), (2, [0, 0], [40.0, 40.0], [10.0, 10.0])],
        "id long, timestamp array<long>, latitude array<double>, longitude array<double>",
    )
    out = {r["id"]: r["derived_speed"] for r in derive.derive_features(df).collect()}
    assert out[1][0] == 0.0 and math.isinf(out[1][1])
    assert math.isnan(out[2][1])


def test_haversine_matches_python(spark):
    def hav(lat1, lon1, lat2, lon2):
        p1, l1, p2, l2 = map(math.radians, (lat1, lon1, lat2, lon2))
        h = math.sin((p2 - p1) / 2) ** 2 * math.cos((l2 - l1) / 2) ** 2 + math.cos((p1 + p2) / 2) ** 2 * math.sin(
            (l2 - l1) / 2) ** 2
        return 6371.0 * 2 * math.asin(math.sqrt(h))

    lat, lon = [48.1, 48.2, 47.9], [11.5, 11.7, 11.2]
    df = spark.createDataFrame([(1, [0, 5, 9], lat, lon)],
                               "id long, timestamp array<long>, latitude array<double>, longitude array<double>")
    d = derive.derive_features(df).first()["derived_distance"]
    assert d[0] == 0.0
    assert abs(d[1] - hav(lat[0], lon[0], lat[1], lon[1])) < 1e-9
    assert abs(d[2] - hav(lat[1], lon[1], lat[2], lon[2])) < 1e-9


def test_scaler_policies(spark):
    train = spark.createDataFrame([(1, [1.0, 3.0]), (1, [5.0])], "userId long, hr array<double>")
    st = scale.fit_user_stats(train, ["hr"])
    row = st.first()
    assert abs(row["hr_mean"] - 3.0) < 1e-12
    assert abs(row["hr_std"] - (np.std([1.0, 3.0, 5.0]) + 1e-6)) < 1e-12
    data = spark.createDataFrame([(1, [3.0]), (2, [7.0])], "userId long, hr array<double>")
    neutral = {r["userId"]: r["hr_standardized"] for r in scale.apply_user_stats(data, st, ["hr"], policy="neutral").collect()}
    assert neutral[2] == [7.0] and abs(neutral[1][0]) < 1e-9
    with pytest.raises(Exception, match="user not in fitted state"):
        scale.apply_user_stats(data, st, ["hr"], policy="strict").collect()


def test_encoder_first_appearance_and_unseen(spark):
    rows = [(1, 10, "walking", [300]), (2, 11, "biking", [100]), (3, 12, "walking", [200]), (4, 13, None, [50])]
    df = spark.createDataFrame(rows, "id long, userId long, sport string, timestamp array<long>")
    st = encode.fit_encoder(df, ["sport"])
    idx = {r["value"]: r["idx"] for r in st.collect()}
    assert idx == {None: 0, "biking": 1, "walking": 2}
    new = spark.createDataFrame([(9, "running"), (8, "biking")], "id long, sport string")
    got = {r["id"]: r["sport_idx"] for r in encode.apply_encoder(new, st, ["sport"]).collect()}
    assert got == {9: None, 8: 1}


def test_windows_alignment_and_lag(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0], [10.0, 20.0, 30.0])], "id long, x array<double>, hr array<double>")
    w = windows.sliding_windows(df, ["x"], "hr", heartrate_input_column="hr", window_size=2).orderBy("t").collect()
    assert [r["t"] for r in w] == [0, 1, 2]
    assert [list(map(list, r["features"])) for r in w] == [
        [[0.0, 0.0], [1.0, 0.0]],
        [[1.0, 0.0], [2.0, 10.0]],
        [[2.0, 10.0], [3.0, 20.0]],
    ]
    assert [r["target"] for r in w] == [10.0, 20.0, 30.0]


def test_attach_signal_last_wins_and_missing(spark):
    target = spark.createDataFrame([(1, [10, 20])], "id long, timestamp array<long>")
    raw = spark.createDataFrame([(1, [10, 20, 10], [1.0, 2.0, 9.0])], "id long, timestamp array<long>, altitude array<double>")
    assert derive.attach_signal(target, raw).first()["altitude"] == [9.0, 2.0]
    missing = spark.createDataFrame([(1, [10, 30])], "id long, timestamp array<long>")
    assert derive.attach_signal(missing, raw, on_missing="null").first()["altitude"] == [9.0, None]
    with pytest.raises(Exception, match="no raw signal"):
        derive.attach_signal(missing, raw, on_missing="error").collect()


def test_repair_elapsed_after_null(spark):
    from seqprep.operators.validate import coerce_int

    df = spark.createDataFrame([(1, [5, 6, 9], [0, None, 4])], "id long, timestamp array<long>, time_elapsed array<long>")
    df = df.withColumn("time_elapsed", coerce_int("time_elapsed", df.schema["time_elapsed"].dataType))
    assert derive.repair_time_elapsed(df).first()["time_elapsed"] == [0, 1, 4]


def test_coerce_float_strings(spark):
    from seqprep.operators.validate import coerce_float

    df = spark.createDataFrame([(["1.5", None, "2"],), (["1", "x"],)], "s array<string>")
    got = [r[0] for r in df.select(coerce_float("s", df.schema["s"].dataType)).collect()]
    assert got[0][0] == 1.5 and math.isnan(got[0][1]) and got[0][2] == 2.0
    assert got[1] == []


def test_pandas_scorer_matches_expression_scorer(spark):
    """The generic model path (window rows + mapInPandas) gives the same
    predictions as the in-row expression scorer."""
    from seqprep.operators import evaluate

    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], [60.0, 62.0, 64.0, 66.0]), (2, [5.0], [70.0])],
                               "id long, x array<double>, hr array<double>")
    w = windows.sliding_windows(df, ["x"], "hr", heartrate_input_column="hr", window_size=3)

    def predict(pdf):
        return pdf["features"].apply(lambda f: float(np.mean([step[-1] for step in f])))

    by_pandas = evaluate.regroup(evaluate.score_windows_pandas(w, predict))
    inline = windows.predict_inline(df, evaluate.lagged_mean_scorer, ["x"], "hr", heartrate_input_column="hr",
                                    window_size=3)
    a = {r["id"]: r["predicted_heart_rate"] for r in by_pandas.collect()}
    b = {r["id"]: r["predicted_heart_rate"] for r in inline.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert np.allclose(a[k], b[k])
    assert np.allclose(b[1], [0.0, 20.0, (60.0 + 62.0) / 3, (60.0 + 62.0 + 64.0) / 3])


def test_a_model_on_whole_sequences_needs_no_shuffle(spark):
    from seqprep.operators import evaluate

    rows = [(1, [1.0, 2.0, 3.0, 4.0], [60.0, 62.0, 64.0, 66.0]), (2, [5.0], [70.0]), (3, [], []), (4, None, None)]
    df = spark.createDataFrame(rows, "id long, x array<double>, hr array<double>")
    scored = evaluate.score_sequences(df, lambda f: f[:, :, -1].mean(axis=1), ["x"], "hr", window_size=3)
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: r["predicted_heart_rate"] for r in scored.collect()}
    assert np.allclose(got[1], [0.0, 20.0, 122 / 3, 62.0]) and got[2] == [0.0] and got[3] == got[4] == []
    with pytest.raises(Exception, match="differ in length"):
        evaluate.score_sequences(df.withColumn("x", F.slice("x", 1, 1)), lambda f: f[:, 0, 0], ["hr"], "x", window_size=3).collect()


def test_regressor_solves_the_normal_equations(spark):
    from seqprep.operators import evaluate

    rng = np.random.default_rng(2)
    rows = [(i, *[[float(v) for v in rng.normal(0, 1, n)] for _ in range(2)]) for i, n in enumerate(rng.integers(1, 40, 30))]
    df = spark.createDataFrame(rows, "id long, x array<double>, hr array<double>").repartition(3)
    got = {r["feature"]: r["coefficient"] for r in evaluate.fit_regressor(df, ["x"], "hr", "hr", window_size=4, reg_param=0.01).collect()}
    w = windows.sliding_windows(df, ["x"], "hr", heartrate_input_column="hr", window_size=4).toPandas()
    X = np.array([np.append(np.ravel([list(s) for s in f]), 1.0) for f in w["features"]])
    want = np.linalg.solve(X.T @ X / len(X) + np.diag([0.01] * 8 + [0.0]), X.T @ w["target"].to_numpy(float) / len(X))
    assert np.allclose([got[i] for i in range(9)], want, atol=1e-9)
    assert evaluate.fit_regressor(df.where("false"), ["x"], "hr").count() == 0


def test_attach_signal_to_unsorted_and_repeated_times(spark):
    left = spark.createDataFrame([(1, [5, 3, 3, 9, None]), (2, []), (3, None), (4, [1])], "id long, timestamp array<long>")
    raw = spark.createDataFrame([(1, [9, 3, 5, 3], [90.0, 30.0, 50.0, 31.0]), (2, [1], [1.0])], "id long, timestamp array<long>, altitude array<double>")
    out = derive.attach_signal(left, raw, on_missing="null")
    assert {r["id"]: r["altitude"] for r in out.collect()} == {1: [50.0, 31.0, 31.0, 90.0, None], 2: [], 3: None, 4: [None]}
    with pytest.raises(Exception, match="no raw signal for id 4 at timestamp 1"):
        derive.attach_signal(left.where("id = 4"), raw).collect()


def test_package_usage_example_runs(spark):
    from seqprep.operators import corrupt, evaluate, validate
    from seqprep.sources import fixtures as fx

    workouts = fx.seq_type(spark, "/root/testdata/sf0.001")
    df = derive.derive_features(derive.with_time_elapsed(workouts))
    df = validate.filter_valid_lengths(df, ["heart_rate", "altitude"])
    labeled = split.temporal_split(df)
    train = labeled.where("split = 'train'")
    stats = scale.fit_user_stats(train, ["heart_rate", "altitude"])
    df = scale.apply_user_stats(labeled, stats, ["heart_rate", "altitude"], policy="neutral")
    noisy = corrupt.random_noise(df, ["heart_rate"], std_scale=2.0, seed=42, out_prefix="erroneous_")
    assert "erroneous_heart_rate" in noisy.columns
    cleaned = clean.fit_transform(df)
    scored = windows.predict_inline(cleaned, evaluate.lagged_mean_scorer, ["altitude"], "heart_rate",
                                    heartrate_input_column="heart_rate")
    m = evaluate.metrics(scored).first()
    assert m["n_points"] > 0 and m["mae"] >= 0


def test_regression_with_static_columns(spark):
    """Coefficients and scores against the normal equations in NumPy; a row
    without points and a missing static value do not break either."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=n).tolist(), (rng.normal(size=n) + i).tolist(), i % 4) for i, n in enumerate([0, 1, 7, 12, 30, 30])]
    df = spark.createDataFrame(rows, "id long, x array<double>, hr array<double>, code long")
    model = evaluate.fit_regressor(df, ["x"], "hr", "hr", window_size=3, reg_param=0.01, static_columns=["code"])
    a, y = [], []
    for _, x, hr, code in rows:
        px, ph = np.float32([0, 0, *x]), np.float32([0, 0, 0, *hr])
        for t in range(len(x)):
            a.append([*np.column_stack((px[t : t + 3], ph[t : t + 3])).ravel(), code, 1.0])
            y.append(np.float32(hr[t]))
    a, y = np.array(a, float), np.array(y, float)
    want = np.linalg.solve(a.T @ a / len(a) + np.diag([0.01] * 7 + [0]), a.T @ y / len(a))
    got = [r["coefficient"] for r in model.orderBy("feature").collect()]
    assert np.allclose(got, want)
    unseen = df.unionByName(spark.createDataFrame([(99, [1.0], [2.0], None)], df.schema))
    scored = evaluate.predict_regressor(unseen, model, ["x"], "hr", 3, ["code"]).orderBy("id").collect()
    assert np.allclose(np.concatenate([r["predicted_heart_rate"] for r in scored[:-1]]), a @ want)
    assert np.isnan(scored[-1]["predicted_heart_rate"][0])


def test_last_static_record_wins(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (None, [3.0])], "id long, x array<double>")
    records = spark.createDataFrame(
        [(1, "a", 2), (1, "b", 1), (None, "c", 1), (None, "d", 1)], "id long, sport string, place long")
    out = windows.attach_static(df, records, ["sport"], ["place"])
    assert {r["id"]: r["sport"] for r in out.collect()} == {1: "a", 2: None, None: "d"}
    assert windows.attach_static(df, records.where("false"), ["sport"], ["place"]).count() == 3
