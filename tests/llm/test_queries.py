"""The registered queries over whole tables, against SQL or plain versions."""

import hashlib
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seqprep.llm.queries import ORACLES, QUERIES
from tests.llm.test_methods import _plain_simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    table = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").reset_index(drop=True)
    return table.assign(text=table.text.fillna(""))


def result(spark, name):
    return QUERIES[name](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLES[name])
    assert sorted(want.columns) == sorted(got.columns)
    order = [got.columns.index(c) for c in want.columns]
    assert Counter(tuple(r[i] for i in order) for r in got.collect()) == Counter(want.fetchall())


@pytest.mark.parametrize("name", ["op1_mixing", "op6_url_filters", "op8_exact_dedup", "op9_license_scan"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "ExternalRDD"))


def test_fingerprints(spark, docs):
    got, texts = result(spark, "op2_fingerprints"), list(docs.text)
    following = texts[1:] + texts[:1]
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, following)]
    assert (got.doc_id == docs.doc_id).all() and (got.n_chars == [len(t) for t in texts]).all()
    assert (got.edited_sha256 == [hashlib.sha256(t.encode()).hexdigest() for t in edited]).all()
    assert len(set(zip(texts, got.fingerprint))) == len(set(texts))
    assert 0.4 < got.near_edited.mean() < 0.6 and got.near_next.mean() < 0.05 and (got.near_edited > got.near_next).mean() > 0.97


def test_quality_on_the_held_out_fold(spark, docs):
    got = result(spark, "op3_quality")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all() and len(got) == len(docs)
    known = got.merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    held = known[known.held_out]
    assert (held.predicted == held.quality).mean() > 0.8 and (known.predicted == known.quality).mean() > 0.9


def test_language_model(spark, docs):
    got = result(spark, "op4_lm_scores")
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in docs.doc_id]
    tokens = [t.encode().lower().split() + [b"\n"] for t in docs.text]
    c = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    assert (got.held_out == held).all() and (got.train_tokens == n).all()
    assert (got.n_tokens == [len(t) for t in tokens]).all() and (got.n_known == [sum(w in c for w in t) for t in tokens]).all()
    assert np.allclose(got.base_score, [sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t) for t in tokens])
    assert got[got.held_out].score.sum() > got[got.held_out].base_score.sum()


def test_near_duplicates(spark, docs):
    got = result(spark, "op5_simhash_dedup")
    fps = [_plain_simhash(t, 3) for t in docs.text]
    assert list(got.fingerprint) == [f"{f:016x}" for f in fps]
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert list(got.component_id) == [docs.doc_id[find(i)] for i in range(len(fps))]


def _ids(docs, end):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [np.array(plain.encode(t, add_special_tokens=False).ids + [end], "<u4") for t in docs.text]


def test_token_files(spark, docs):
    got, ids = result(spark, "op7_token_files"), _ids(docs, 2)
    sizes = np.array([len(x) for x in ids])
    assert (got.doc_id == docs.doc_id).all() and (got.n_tokens == sizes).all() and (got.start == np.cumsum(sizes) - sizes).all()
    assert (got.ids_crc32 == [zlib.crc32(x.tobytes()) for x in ids]).all()


def test_packing(spark, docs):
    got, ids = result(spark, "op10_packing"), dict(zip(docs.doc_id, _ids(docs, 0)))
    pieces = zip(got.doc_id, got.start, got.length, got.ids_crc32)
    assert all(zlib.crc32(ids[d][s : s + n].tobytes()) == crc for d, s, n, crc in pieces)
    assert (got.doc_tokens == [len(ids[d]) for d in got.doc_id]).all()
    by_doc = got.sort_values(["doc_id", "start"])
    assert (by_doc.start == by_doc.groupby("doc_id").length.cumsum() - by_doc.length).all()
    assert (got.groupby("doc_id").length.sum() == pd.Series({d: len(x) for d, x in ids.items()})).all()
    by_sequence = got.sort_values(["sequence_id", "offset"])
    sums = by_sequence.groupby("sequence_id").length
    assert (by_sequence.offset == sums.cumsum() - by_sequence.length).all() and sums.sum().max() <= 1024
    assert 1024 * len(sums.sum()) - sums.sum().sum() <= 0.02 * 1024 * len(sums.sum())
