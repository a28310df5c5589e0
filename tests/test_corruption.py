"""Noise injection: the invariants the reference tests, checked on every row."""

import numpy as np
import pytest

from seqprep.operators import corrupt, inject


@pytest.fixture(scope="module")
def signals(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 200)]) for i in range(60)]
    rows.append((1000, [4.0] * 200))  # constant sequence
    return spark.createDataFrame(rows, "id long, signal array<double>")


def _arrays(df, col="signal"):
    return {r["id"]: np.array(r[col]) for r in df.select("id", col).collect()}


@pytest.mark.parametrize("method", ["constant", "random"])
def test_std_scaling_exact(spark, signals, method):
    fn = corrupt.constant_noise if method == "constant" else corrupt.random_noise
    out = fn(signals, ["signal"], segment_fraction=0.2, num_segments=2, std_scale=3.0, seed=5, out_prefix="e_")
    orig, err = _arrays(out), _arrays(out, "e_signal")
    for i in orig:
        if i == 1000:
            continue
        assert abs(np.std(err[i]) / np.std(orig[i]) - 3.0) < 1e-9


def test_constant_sequence_fallback(spark, signals):
    out = corrupt.constant_noise(signals, ["signal"], segment_fraction=0.2, num_segments=2, std_scale=3.0, seed=5,
                                 out_prefix="e_")
    e = _arrays(out, "e_signal")[1000]
    assert abs(np.std(e) - 4.0 * np.sqrt(8.0)) < 1e-9


def test_segment_fraction_and_constant_shift(spark, signals):
    out = corrupt.constant_noise(signals, ["signal"], segment_fraction=0.2, num_segments=2, std_scale=2.0, seed=9,
                                 out_prefix="e_")
    orig, err = _arrays(out), _arrays(out, "e_signal")
    s = max(2, int(200 * 0.2))
    for i in orig:
        diff = err[i] - orig[i]
        changed = np.nonzero(np.abs(diff) > 0)[0]
        assert len(changed) == s
        assert np.allclose(diff[changed], diff[changed][0])


def test_random_noise_touches_at_most_s_points(spark, signals):
    out = corrupt.random_noise(signals, ["signal"], segment_fraction=0.4, num_segments=3, std_scale=2.0, seed=9,
                               out_prefix="e_")
    orig, err = _arrays(out), _arrays(out, "e_signal")
    for i in orig:
        assert np.count_nonzero(err[i] - orig[i]) <= int(200 * 0.4)


def test_row_fraction_exact_count(spark, signals):
    out = corrupt.constant_noise(signals, ["signal"], row_fraction=0.25, std_scale=2.0, seed=3, out_prefix="e_")
    orig, err = _arrays(out), _arrays(out, "e_signal")
    changed = [i for i in orig if not np.array_equal(orig[i], err[i])]
    assert len(changed) == max(1, int(61 * 0.25))


def test_same_result_for_any_partitioning(spark, signals):
    a = corrupt.random_noise(signals.repartition(1), ["signal"], std_scale=2.0, seed=4)
    b = corrupt.random_noise(signals.repartition(7), ["signal"], std_scale=2.0, seed=4)
    assert _arrays(a) .keys() == _arrays(b).keys()
    for i, v in _arrays(a).items():
        assert np.array_equal(v, _arrays(b)[i])


def test_error_handling(spark, signals):
    with pytest.raises(ValueError, match="std_scale must be > 1"):
        corrupt.constant_noise(signals, ["signal"], std_scale=1.0)
    with pytest.raises(ValueError, match="Column 'B' not found"):
        corrupt.random_noise(signals, ["B"], std_scale=2.0)
    with pytest.raises(ValueError, match="num_segments"):
        corrupt.random_noise(signals, ["signal"], num_segments=0, std_scale=2.0)


@pytest.mark.parametrize("method", ["constant", "random"])
def test_short_and_empty_rows_stay_as_they_are(spark, method):
    rows = [(1, [1.0, 2.0, 3.0]), (2, []), (3, None), (4, [float(i) for i in range(40)]), (5, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "id long, signal array<double>")
    out = {r["id"]: r["signal"] for r in corrupt.corrupt(df, method, ["signal"], segment_fraction=0.2, num_segments=3).collect()}
    assert [out[i] for i in (1, 2, 3, 5)] == [[1.0, 2.0, 3.0], [], None, [1.0, 2.0]]
    assert out[4] != rows[3][1] and abs(np.std(out[4]) / np.std(rows[3][1]) - 2) < 1e-9


def test_injection_on_ragged_rows_of_two_columns(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "abc"[i % 3] if i % 10 else None, [float(v) for v in rng.normal(0, 1, n)], [float(v) for v in rng.normal(5, 2, n)])
            for i, n in enumerate(rng.integers(0, 60, 90).tolist())]
    df = spark.createDataFrame(rows, "id long, sport string, longitude array<double>, latitude array<double>")
    out = inject.inject(df, std_scales=(2, 4), seed=1)
    assert out.count() == 180
    for r in out.collect():
        n, size = len(r["longitude"]), max(2, int(len(r["longitude"]) * r["fraction"]))
        for c in ("longitude", "latitude"):
            e = r["erroneous_" + c]
            if n > 2 and r["num_segments"] <= size < n:
                assert abs(np.std(e) / np.std(r[c]) - r["std_scale"]) < 1e-6
                assert sum(x != y for x, y in zip(e, r[c])) <= size
            else:
                assert e == r[c]
    audit = inject.audit(out, ["longitude", "latitude"]).collect()
    assert sum(a["n"] for a in audit) == 180 and {a["sport"] for a in audit} == {"a", "b", "c", None}


@pytest.mark.parametrize("method", ["constant", "random"])
def test_noise_on_a_stream_equals_the_batch(spark, signals, tmpdir_path, method):
    signals.write.parquet(f"{tmpdir_path}/in")
    batch = spark.read.parquet(f"{tmpdir_path}/in")
    want = {r["id"]: r["signal"] for r in corrupt.corrupt(batch, method, ["signal"]).collect()}
    stream = spark.readStream.schema(batch.schema).parquet(f"{tmpdir_path}/in")
    query = (corrupt.corrupt(stream, method, ["signal"]).writeStream.format("parquet").option("path", f"{tmpdir_path}/out")
             .option("checkpointLocation", f"{tmpdir_path}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    assert {r["id"]: r["signal"] for r in spark.read.parquet(f"{tmpdir_path}/out").collect()} == want


def test_injection_assignment_counts(spark):
    n = 101
    df = spark.createDataFrame([(i, "biking") for i in range(n)], "id long, sport string")
    a = inject.assign_injection(df, seed=42).select("assignment.*").groupBy("method", "fraction", "k").count()
    got = {(r["method"], round(r["fraction"], 1), r["k"]): r["count"] for r in a.collect()}

    def part(m):
        s1, s2 = int(m * 0.3), int(m * 0.6)
        out = {}
        for frac, c in [(0.2, s1), (0.4, s2 - s1), (0.6, m - s2)]:
            if frac < 0.5:
                out[(frac, 1)], out[(frac, 2)] = int(c * 0.8), c - int(c * 0.8)
            else:
                out[(frac, 1)], out[(frac, 2)], out[(frac, 3)] = int(c * 0.6), int(c * 0.8) - int(c * 0.6), c - int(c * 0.8)
        return out

    mid = int(n * 0.5)
    want = {("constant", *k): v for k, v in part(mid).items()} | {("random", *k): v for k, v in part(n - mid).items()}
    want = {k: v for k, v in want.items() if v}
    assert got == want


def test_inject_and_audit(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "running", [float(x) for x in rng.normal(0, 1, 64)], [float(x) for x in rng.normal(0, 1, 64)])
            for i in range(40)]
    df = spark.createDataFrame(rows, "id long, sport string, longitude array<double>, latitude array<double>")
    out = inject.inject(df, std_scales=[2, 4])
    aud = inject.audit(out, columns=["longitude", "latitude"]).collect()
    for r in aud:
        assert r["n"] == 40 and r["n_ok_longitude"] == 40 and r["n_ok_latitude"] == 40
