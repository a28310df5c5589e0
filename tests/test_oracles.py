"""Every registered query against its DuckDB oracle on the smallest tables.

SEQPREP_FAST_ORACLES=1 runs a few of them only, while iterating.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from seqprep.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["events", "embeddings"]
FAST = ["a1_user_stats", "w1_temporal_split", "k2_constant_noise", "c1_clean", "m1_score_windows", "j1_attach_signal"]
NAMES = FAST if os.environ.get("SEQPREP_FAST_ORACLES") else sorted(ORACLES)


def _norm(v):
    # exact: both sides round to 6 decimals the same way, so values must be equal bit for bit
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert srows == drows
