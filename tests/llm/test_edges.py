"""Every operator on nulls, empty and very long texts, ties, repeated rows,
empty tables and clashing column names, against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from seqprep.llm import dedup, fingerprint, license, lm, mixing, packing, quality, simhash, tokens, urlfilter
from seqprep.llm.common import scratch_path
from tests.llm.test_methods import _plain_simhash

BPE = public_tokenizers.path("byte_bpe_50k.json")
N = 12


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


# ---- exact dedup ----


def plain_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
    return Counter(
        (i, min((x for x in g if x is not None), default=None), len(g), hashlib.sha256(t.encode()).hexdigest())
        for t, g in groups.items() for i in g
    )


@pytest.mark.parametrize("digest", [dedup.sha256, lambda text: F.unhex(F.sha2(F.substring(text, 1, 3), 256)), lambda text: F.unhex(F.lit("00"))])
def test_exact_dedup_whatever_the_digest(odd, digest):
    result = dedup.exact_dedup(odd, digest=digest)
    rows = result.collect()
    strong = {(r["id"], r["keep_id"], r["group_size"]): 0 for r in rows}
    want = plain_groups(texts_of(odd))
    assert len(rows) == N and set(strong) == {k[:3] for k in want}
    assert sum(r["kept"] for r in rows) == len({k[3] for k in want})
    if digest is dedup.sha256:
        assert Counter((r["id"], r["keep_id"], r["group_size"], bytes(r["digest"]).hex()) for r in rows) == want


def test_dropping_exact_duplicates_keeps_rows_whole(odd, empty):
    kept = dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == 8
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 5, 6, 7, 8, None}
    assert dedup.drop_exact_duplicates(empty).count() == 0 and dedup.exact_dedup(empty).count() == 0


def test_state_resumes_with_new_files(spark, tmpdir_path):
    path, checkpoint = f"{tmpdir_path}/keys", f"{tmpdir_path}/state"
    keys = lambda rows: spark.createDataFrame(rows, "digest binary, id long, _file string, _row long")
    keys([(b"a", 5, "f", 0), (b"b", 7, "f", 1)]).write.parquet(path)
    schema = spark.read.parquet(path).schema
    dedup.run_state(spark, path, schema, checkpoint).collect()
    keys([(b"a", 2, "g", 0), (b"c", 9, "g", 1)]).write.mode("append").parquet(path)
    state = {bytes(r["digest"]): (r["keeper"]["id"], r["n"]) for r in dedup.run_state(spark, path, schema, checkpoint).collect()}
    assert state == {b"a": (2, 2), b"b": (7, 1), b"c": (9, 1)}


# ---- simhash ----


def test_simhash_classes(odd, empty):
    rows = simhash.simhash_dedup(odd).collect()
    fps = {i: _plain_simhash(t, 3) for i, t in texts_of(odd) if i not in (None, 8)}
    assert len(rows) == N
    for r in rows:
        if r["id"] in fps:
            assert r["fp"] % (1 << 64) == fps[r["id"]]
            assert r["component_id"] == min(i for i, f in fps.items() if (f ^ fps[r["id"]]).bit_count() <= 2)
    assert simhash.simhash_dedup(empty).count() == 0


def test_dropping_near_duplicates_keeps_one_document_of_a_group(odd, empty):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == [None, 1, 3, 5, 7, 8, 8]
    assert simhash.drop_near_duplicates(empty).count() == 0
    with pytest.raises(ValueError):
        simhash.near_links(odd.select("fp"), 3)


# ---- token files and packing ----


def encoded(rows, end):
    plain = Tokenizer.from_file(BPE)
    return Counter((i, tuple(plain.encode(t, add_special_tokens=False).ids + [end])) for i, t in rows)


def test_token_files_round_trip(spark, odd, empty):
    path = scratch_path(spark, "tokens")
    tokens.write_token_files(odd, path, BPE, end_id=2)
    stored = tokens.read_token_files(spark, path).orderBy("_file", "_row").collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in stored) == encoded(texts_of(odd), 2)
    ids = [r["doc_id"] for r in stored]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    index = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in tokens.token_index(spark, path).collect()}
    at = 0
    for r in stored:
        assert index[(r["doc_id"], at)] == (len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes()))
        at += len(r["ids"])
    none = scratch_path(spark, "tokens")
    tokens.write_token_files(empty, none, BPE, end_id=2)
    assert tokens.token_index(spark, none).count() == 0


def test_token_files_have_the_stated_layout(spark, odd, tmpdir_path):
    import pyarrow.parquet as pq
    from pathlib import Path

    tokens.write_token_files(odd, f"{tmpdir_path}/t", BPE, end_id=2)
    whole = [pq.ParquetFile(p) for p in sorted(Path(tmpdir_path, "t").glob("*.parquet"))]
    # the dictionary gives way where a file is too small for it: take the longest text's
    group = max((f.metadata.row_group(0) for f in whole if f.metadata.num_rows), key=lambda g: g.column(2).num_values)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings and columns["ids.list.element"].has_dictionary_page
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index


def test_packing_holds_every_id_once(odd, empty):
    rows = packing.pack_documents(odd, BPE, end_id=0, with_ids=True).collect()
    want = encoded(texts_of(odd), 0)
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[(r["doc_id"], r["doc_tokens"])].append((r["start"], tuple(r["ids"])))
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 1024
    # rows that repeat an id and a length stand side by side: compare their ids as a bag
    for (doc, n), pieces in documents.items():
        same = [ids for (i, ids), c in want.items() if i == doc and len(ids) == n for _ in range(c)]
        assert sum(len(ids) for _, ids in pieces) == sum(map(len, same))
        if len(same) == 1:
            assert sum((ids for _, ids in sorted(pieces)), ()) == same[0]
    assert len(documents) == len({(i, len(ids)) for i, ids in want})
    assert packing.pack_documents(empty, BPE).count() == 0


# ---- mixing ----


def test_mix_takes_what_the_targets_say(odd, empty):
    rows = mixing.mix_sources(odd, shards=3, block_words=8).collect()
    by_row = defaultdict(list)
    for r in rows:
        by_row[(r["_file"], r["_row"])].append(r)
    assert len(by_row) == N
    taken = Counter()
    for pieces in by_row.values():
        size = pieces[0]["size"]
        assert sum(p["words"] for p in pieces) <= 3 * size
        assert all((p["shard"] is None) == (p["words"] == 0) for p in pieces)
        taken[pieces[0]["source"]] += sum(p["words"] for p in pieces)
    target = {r["source"]: r["target"] for r in rows}
    sizes = {r["source"]: r["source_size"] for r in rows}
    assert set(target) == {None, "a", "b", "c"} and sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - t) <= 0.5 and t <= 3 * sizes[s] for s, t in target.items())
    assert mixing.mix_sources(empty, shards=2).count() == 0


def test_mix_is_the_same_again_and_blocks_fill_shards_exactly(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 50), f"s{i % 4}" if i % 3 else "s0") for i in range(3000)], "doc_id long, text string, source string")
    first, second = (mixing.mix_sources(docs, shards=5, block_words=100).drop("_file", "_row").collect() for _ in range(2))
    assert Counter(first) == Counter(second)
    words = Counter()
    for r in first:
        words[r["shard"]] += r["words"]
    words.pop(None, None)
    assert len(words) == 5 and max(words.values()) < 1.3 * min(words.values())
    mixed = mixing.mixed_documents(docs, shards=5, block_words=100)
    assert mixed.columns == docs.columns
    again = Counter((r["doc_id"], len(r["text"].split())) for r in mixed.collect())
    assert again == Counter((r["id"], r["words"]) for r in first if r["words"])


def test_mix_by_given_weights(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "ab"[i % 2]) for i in range(200)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 3.0), ("zzz", 9.0)], "source string, weight double")
    rows = mixing.mix_sources(docs, weights=weights, shards=2, block_words=50).collect()
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["words"]
    assert taken == {"a": 2000, "b": 0}


def test_mixed_documents_keep_odd_rows_whole(odd, empty):
    mixed = mixing.mixed_documents(odd, shards=2, block_words=8)
    assert mixed.columns == odd.columns
    assert {r["doc_id"] for r in mixed.collect()} <= {1, 2, 5, 7, 8, None}
    assert mixing.mixed_documents(empty, shards=2).count() == 0


# ---- language model ----


def test_scores_equal_a_plain_count(odd, empty):
    learn = odd.filter("doc_id <= 5 or doc_id is null")
    model = lm.train(learn, shards=3)
    rows = lm.score_documents(odd, model, keep={"n": F.col("n_chars")}).collect()
    split = lambda t: t.encode().lower().split() + [b"\n"]
    counts = Counter(w for _, t in texts_of(learn) for w in split(t))
    total, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in texts_of(odd):
        words = split(t)
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (v + 1))) for w in words)
        want[(i, len(words), sum(w in counts for w in words), total, round(base, 6))] += 1
    assert Counter((r["id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == want
    assert all(r["score"] <= 0 for r in rows)
    assert lm.score_documents(empty, model).count() == 0


def test_pair_probabilities_are_the_smoothed_ones_and_sum_to_one(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "b", "c", "d", "e"], 40)) for _ in range(60)]
    model = lm.train(spark.createDataFrame([(t,) for t in texts], "text string"), shards=4)
    tokens_, starts = lm.token_hashes([t.encode() for t in texts])
    words = np.unique(tokens_)
    rank, count = lm.find_words(model, words)
    assert sorted(rank) == list(range(len(words))) and (lm.counts_of(model, rank) == count).all()
    pairs = Counter()
    for t in texts:
        w = [b"\n", *t.encode().split(), b"\n"]
        pairs.update(zip(w, w[1:]))
    h = lambda w: int(rank[np.searchsorted(words, lm.token_hashes([w])[0][0])]) if w != b"\n" else int(rank[words == lm.END][0])
    c_of = dict(zip(rank.tolist(), count.tolist()))
    for context in (b"a", b"\n"):
        mass = 0.0
        for w in (b"a", b"b", b"c", b"d", b"e", b"\n"):
            c = c_of[h(context)]
            k = model.weights[int(np.log2(c))]
            want = k * pairs[(context, w)] / c + (1 - k) * float(model.p_word(np.array([c_of[h(w)]]))[0])
            got = lm.find_pairs(model, np.array([h(context)]), np.array([h(w)]))[0]
            assert (got >= 0) == (pairs[(context, w)] > 0)
            if got >= 0:
                assert abs(-got / lm.STEPS - np.log10(want)) <= 0.5 / lm.STEPS + 1e-9
            mass += want
        assert mass == pytest.approx(1, abs=1e-3)


def test_model_of_nothing_knows_nothing(odd, empty):
    model = lm.train(empty, shards=2)
    rows = lm.score_documents(odd, model).collect()
    assert len(rows) == N and all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == r["score"] == 0 for r in rows)


def test_trie_asks_for_a_mounted_folder():
    with pytest.raises(ValueError):
        lm.mounted("hdfs://host/checkpoints")


# ---- quality ----


def test_quality_scores_everything(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (5, 0, 1), (5, 0, 1), (7, None, 0), (None, 0, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    field = quality.fit_quality(odd, labels)
    scores = quality.score_quality(odd.select("doc_id", "text"), field).collect()
    assert len(scores) == N and all(0 <= r["score"] <= 1 for r in scores)
    by = {r["doc_id"]: r["score"] for r in scores}
    assert by[1] > 0.5 > by[5]
    kept = quality.drop_low_quality(odd, labels, threshold=0.5)
    assert kept.columns == odd.columns and 0 < kept.count() < N
    assert quality.score_quality(empty, field, out="s").count() == 0
    for none in (labels.filter("false"), labels.filter("quality = 1")):
        assert {round(r["score"], 5) for r in quality.score_quality(odd.select("text"), quality.fit_quality(odd, none)).collect()} <= {0.5, 1.0}


def test_low_quality_filter_keeps_all_without_both_classes(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 0), (99, 1), (98, 0)], "doc_id long, quality int")
    for known in (labels.filter("false"), labels.filter("doc_id > 90"), labels.filter("quality = 0"), labels.filter("quality = 1")):
        kept = quality.drop_low_quality(odd, known, threshold=0.7)
        assert kept.columns == odd.columns and Counter(kept.collect()) == Counter(odd.collect())


# ---- fingerprints ----


def test_fingerprints_beside_the_next_document(odd, empty):
    rows = fingerprint.fingerprint_documents(odd).collect()
    order = sorted(texts_of(odd), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = Counter()
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        want[(i, len(t), hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == want
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))
    assert len({r["fingerprint"] for r in rows}) == len({t for _, t in order})
    assert fingerprint.fingerprint_documents(empty).count() == 0


# ---- URL filters ----


def test_captures_meet_the_entries_of_their_time(spark):
    entries = spark.createDataFrame([
        ("d:bad.example", 10, "add"), ("d:bad.example", 20, "remove"), ("d:bad.example", 30, "add"), ("d:bad.example", 30, "add"),
        ("p:ok.example/ads/", 5, "add"), ("u:ok.example/one?x=1", 7, "add"), ("d:same.example", 4, "add"), ("d:same.example", 4, "remove"),
        (None, 1, "add"), ("d:ok.example", None, "add"), ("d:ok.example", 1, "maybe"),
    ], "key string, at long, action string")
    captures = spark.createDataFrame([
        (1, "HTTP://user:pw@WWW.Bad.example:80/x", 9), (2, "https://www.bad.example/x", 10), (3, "https://bad.example", 20),
        (4, "https://a.b.bad.example/", 31), (5, "https://ok.example/ads/deep/page.html#top", 6), (6, "https://ok.example/ads", 6),
        (7, "https://ok.example/one?x=1#frag", 7), (8, "https://ok.example/one?x=2", 7), (9, None, 50), (10, "not a url", 50),
        (11, "https://bad.example/", None), (12, "https://same.example/", 9), (12, "https://same.example/", 9), (None, "https://notbad.example/", 50),
    ], "page_id long, url string, fetched long")
    rows = urlfilter.judge_captures(captures, entries).collect()
    assert len(rows) == 14
    assert {(r["id"], r["rule"], r["since"]) for r in rows if r["blocked"]} == {
        (2, "d:bad.example", 10), (4, "d:bad.example", 30), (5, "p:ok.example/ads/", 5), (7, "u:ok.example/one?x=1", 7)}
    assert not urlfilter.judge_captures(captures, entries.filter("false")).filter("blocked").count()
    assert urlfilter.judge_captures(captures.filter("false"), entries).count() == 0


# ---- licences ----


def test_license_lines(spark, odd, empty):
    docs = spark.createDataFrame([
        (1, "Text.\nReleased under the MIT License.\nReleased under an MIT License"), (2, "licensed under the APACHE license - version 2.0"),
        (3, None), (4, ""), (5, "MIT"), (6, "Licensed under CC BY-NC 4.0.\r\nLicensed under CC BY 4.0."), (7, "word " * 50_000),
    ], "doc_id long, text string")
    rows = {r["id"]: r for r in license.scan_licenses(docs).collect()}
    assert [(m["line"], m["license"], m["dice"]) for m in rows[1]["matches"]] == [(2, "MIT", 1.0)]
    assert rows[2]["licenses"] == "Apache-2.0" and rows[6]["licenses"] == "CC-BY-4.0,CC-BY-NC-4.0"
    assert all(rows[i]["n_matches"] == 0 and rows[i]["best"] is None for i in (3, 4, 5, 7))
    assert license.scan_licenses(odd).count() == N and license.scan_licenses(empty).count() == 0
    assert license.scan_licenses(docs, templates={}).filter("n_matches > 0").count() == 0


def plain_windows(text, templates, least=0.8):
    """Every window of the text's words against every template, best first."""
    words = re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()
    found = []
    for name, body in templates.items():
        own = set(license.template_bigrams(body))
        for i in range(len(words)):
            for j in range(i, len(words)):
                pairs = {" ".join(p) for p in zip(words[i:j], words[i + 1 : j + 1])} or {words[i]}
                dice = 2.0 * len(pairs & own) / (len(pairs) + len(own))
                if dice >= least:
                    found.append((-dice, -len(pairs & own), j - i, i, name, j))
    kept = []
    for w in sorted(found):
        if all(w[3] > k[5] or w[5] < k[3] for k in kept):
            kept.append(w)
    return [(w[4], -w[0]) for w in sorted(kept, key=lambda w: w[3])]


def test_license_notices_wrapped_inline_and_repeated(spark):
    wrapped = "Some text.\nThis work is licensed under the GNU General\nPublic License, version 3.\nMore."
    docs = [
        "Copyright 2024 Foo. Released under the MIT License.", wrapped, "Released under the MIT License. " * 13,
        "See below: released under under under the the MIT MIT License, and licensed\n\nunder CC BY 4.0 too",
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string")
    rows = [r["matches"] for r in license.scan_licenses(df).orderBy("id").collect()]
    assert [(m["line"], m["license"], m["dice"]) for m in rows[0]] == [(1, "MIT", 1.0)]
    assert [(m["line"], m["license"], m["dice"]) for m in rows[1]] == [(2, "GPL-3.0", 1.0)]
    assert [(m["license"], m["dice"]) for m in rows[2]] == [("MIT", 1.0)] * 13
    assert [[(m["license"], m["dice"]) for m in r] for r in rows] == [plain_windows(t, license.TEMPLATES) for t in docs]


def test_license_bodies_and_single_words_equal_all_windows(spark):
    rng = random.Random(4)
    body = "\n".join(" ".join(rng.choice("abcdefghij") * 2 for _ in range(6)) for _ in range(5))
    templates = {"BODY": body, "WORD": "mit", "SHORT": "aa bb cc dd"}
    words = body.split()
    docs = ["x y " + " \n".join(words[:20] + ["zz"] + words[20:]) + " q", "MIT or aa bb cc\ndd", None, "", "\n\nmit"]
    for _ in range(30):
        part = [w for w in words if rng.random() > 0.1]
        docs.append("".join(w + rng.choice([" ", "\n", ", "]) for w in rng.choices(words, k=5) + part + ["aa", "bb", "cc"] + rng.choices(words, k=12)))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string")
    rows = license.scan_licenses(df, templates, least=0.7).orderBy("id").collect()
    got = [[(m["license"], m["dice"]) for m in r["matches"]] for r in rows]
    assert got == [plain_windows(t, templates, 0.7) for t in docs] and sum(map(len, got)) > 30
    assert [m["line"] for m in rows[4]["matches"]] == [3]


def test_size_bounds_lose_no_match():
    for least in (0.5, 0.8, 0.95):
        for a in range(1, 40):
            for b in range(1, 40):
                if 2 * min(a, b) / (a + b) >= least:
                    assert b * least / (2 - least) - 1e-9 <= a <= b * (2 - least) / least + 1e-9


# ---- pipeline ----


def test_pipeline_stages_against_plain_versions(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    out, before = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, before, sf).write.parquet(path)
        before = out[name] = spark.read.parquet(path)
        assert name == names[-1] or before.columns == docs.columns
    clean = {i: t for i, t in texts_of(out["quality"])}
    kept = [labels[i] for i in clean if i in labels]
    assert 0.97 <= sum(kept) / len(kept) and sum(kept) >= 0.97 * sum(labels.values())
    first = {}
    for i in sorted(clean):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", clean[i]), i)
    assert {i for i, _ in texts_of(out["exact_dedup"])} == set(first.values())
    ids = sorted(first.values())
    fps, parent = {i: _plain_simhash(clean[i], 3) for i in ids}, {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {i for i, _ in texts_of(out["near_dedup"])} == {i for i in ids if find(i) == i}
    mixed, total = texts_of(out["mixing"]), sum(len(clean[i].encode().split()) for i in ids if find(i) == i)
    assert abs(sum(len(t.encode().split()) for _, t in mixed) - total) <= 20
    packed = out["packing"].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    plain, want = Tokenizer.from_file(BPE), Counter()
    for i, t in mixed:
        want[i] += len(plain.encode(t, add_special_tokens=False).ids) + 1
    assert {r["doc_id"]: r["n"] for r in packed} == want
