"""Tables stored in buckets: same rows, no shuffle on the key, opened from the path."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from seqprep.operators import derive
from seqprep.plans import dataset
from seqprep.sources.buckets import buckets_for, read_bucketed, write_bucketed, write_bucketed_together
from seqprep.sources.io import MissingInputError


def _plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def _hashed_on(df):
    """First columns of the hash exchanges in a plan."""
    return re.findall(r"hashpartitioning\((\w+)#", _plan(df))


def _inputs(spark, n=400):
    ids = spark.range(n).select(F.col("id"))
    times = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: (F.col("id") * 1000 + i * 10).cast("long"))
    records = ids.select(
        # one user has a third of the rows
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).cast("long").alias("userId"), "id",
        F.element_at(F.array(F.lit("run"), F.lit("bike"), F.lit("hiking")), (F.col("id") % 3 + 1).cast("int")).alias("sport"),
        F.lit("f").alias("gender"), times.alias("timestamp"),
        *[F.transform(times, lambda t, k=k: (t % (97 + k)) / 10.0).alias(c)
          for k, c in enumerate(("heart_rate", "latitude", "longitude"))],
    )
    raw = spark.range(0, n + 50).select("id", times.alias("timestamp"), F.transform(times, lambda t: (t % 31) / 2.0).alias("altitude"))
    return records, raw


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_attach_on_buckets_shuffles_nothing(spark, tmpdir_path, no_broadcast):
    records, raw = _inputs(spark)
    attach = lambda r, s: derive.attach_signal(r, derive.semi_by_id(s, r))
    plain = attach(records, raw)
    stored = write_bucketed_together({"records": records, "signal": raw}, f"{tmpdir_path}/in", "id", 6)
    bucketed = attach(stored["records"], stored["signal"])
    assert "id" in _hashed_on(plain)
    assert "Exchange" not in _plan(bucketed)
    rows = lambda df: sorted((r["id"], tuple(r["altitude"])) for r in df.collect())
    assert rows(bucketed) == rows(plain)


def test_prepared_dataset_has_no_exchange_on_id(spark, tmpdir_path, no_broadcast):
    records, raw = _inputs(spark)
    stored = dataset.store_inputs(records, raw, f"{tmpdir_path}/in", 6)
    got, want = dataset.prepare(*stored), dataset.prepare(records, raw)
    assert "id" not in _hashed_on(got) and "id" in _hashed_on(want)
    columns = ["id", "userId", "sport", "altitude", "derived_distance"]
    key = lambda r: (r["id"], repr(r))
    assert sorted(got.select(columns).collect(), key=key) == sorted(want.select(columns).collect(), key=key)


def test_layout_is_read_from_the_path(spark, tmpdir_path, no_broadcast):
    rows = spark.createDataFrame(
        [(1, "a", [1.0]), (None, "b", None), (1, "c", []), (7, None, [2.0, None])], "id long, `odd name` string, v array<double>")
    path = f"{tmpdir_path}/it's"
    write_bucketed(rows, path, "id", 4)
    back = read_bucketed(spark, path)
    assert back.schema.simpleString() == rows.schema.simpleString()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))
    assert "Exchange" not in _plan(back.groupBy("id").count())
    assert {r["n"] for r in back.groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()} == {1, 2}


def test_empty_table_missing_path_and_no_overwriting(spark, tmpdir_path):
    empty = spark.createDataFrame([], "id long, v string")
    write_bucketed(empty, f"{tmpdir_path}/empty")
    assert read_bucketed(spark, f"{tmpdir_path}/empty").count() == 0
    with pytest.raises(MissingInputError):
        read_bucketed(spark, f"{tmpdir_path}/none")
    with pytest.raises(Exception, match="exist"):
        write_bucketed(empty, f"{tmpdir_path}/empty")
    assert buckets_for(empty) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert buckets_for(spark.range(100_000_000), bytes_each=1 << 20) > 700
