"""The methods' own pieces against plain versions."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seqprep.llm import components, eliasfano, fingerprint, lm, mixing, packing, quality, simhash
from seqprep.llm.encoding import Encoder

BPE = public_tokenizers.path("byte_bpe_50k.json")


# ---- token ids ----


def test_encoder_equals_the_tokenizer_on_awkward_texts():
    rng = random.Random(5)
    parts = [" ", " ", " ", "\n", "\t", "a", "B", "é", "1", ".", ",", "!", "'", "s", "　", "\xa0", "中", "😀", "\x1c", "\x85",
             "<|endoftext|>", "\r", "٣", "́", "the", "word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(8000)] + [None, ""]
    enc, plain = Encoder(BPE, kept=500), Tokenizer.from_file(BPE)
    for i in range(0, len(texts), 400):
        part = texts[i : i + 400]
        want = [e.ids for e in plain.encode_batch([t or "" for t in part], add_special_tokens=False)]
        ids, sizes = enc.encode(pa.array(part, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_encoder_keeps_pieces_in_arrays_and_encodes_new_ones_joined(monkeypatch):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzABCéßøŁ"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) + rng.choice(["", "", ".", "!", ",.", "1", "'s"])
    texts = ["\n".join(" ".join(word() for _ in range(rng.randint(1, 6))) for _ in range(30)) for _ in range(60)]
    enc, plain = Encoder(BPE), Tokenizer.from_file(BPE)
    monkeypatch.setattr(enc, "_whole", None)  # no text or piece is encoded by itself
    for _ in range(2):
        ids, sizes = enc.encode(pa.array(texts, pa.string()))
        want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    assert len(enc.pieces) > 3000 and enc.pieces.nbytes + enc.ids.nbytes < 60 * len(enc.pieces)


# ---- Elias-Fano ----


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1), (5, 5), (900, 1 << 20), (5000, 1 << 64), (700, 703)])
def test_elias_fano_finds_every_value_and_nothing_else(n, universe):
    r = np.random.default_rng(n)
    values = np.unique(r.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True)) if n else np.zeros(0, np.uint64)
    level = eliasfano.EliasFano(eliasfano.EliasFano.build(values, universe))
    probe = np.concatenate((values, r.integers(0, universe - 1, 3000, dtype=np.uint64, endpoint=True)))
    place = {int(v): i for i, v in enumerate(values)}
    assert level.find(probe).tolist() == [place.get(int(x), -1) for x in probe]


def test_pack_and_unpack_round_trip():
    r = np.random.default_rng(1)
    columns = [r.integers(0, 1 << 63, 1000).astype(np.uint64), np.arange(1000), np.ones(1000, np.int64)]
    assert all((a == b.astype(np.uint64)).all() for a, b in zip(lm.unpack(lm.pack(*columns), 3), columns))


def test_shards_ascend_and_start_where_they_say():
    for shards in (1, 3, 8, 50):
        starts = np.array([lm.shard_start(s, shards) for s in range(shards)], np.uint64)
        assert lm.shard_of(starts, shards).tolist() == list(range(shards))
        assert lm.shard_of(starts[1:] - np.uint64(1), shards).tolist() == list(range(shards - 1))


def test_wide_pairs_sort_like_narrow_ones():
    r = np.random.default_rng(2)
    c, w = r.integers(0, 50, 400).astype(np.uint64), r.integers(0, 50, 400).astype(np.uint64)
    narrow, wide = lm.summed_pairs(c, w, np.ones(400, np.int64), 50), lm.summed_pairs(c, w, np.ones(400, np.int64), 1 << 40)
    assert all((a == b).all() for a, b in zip(narrow, wide))
    assert dict(zip(zip(narrow[0], narrow[1]), narrow[2])) == Counter(zip(c, w))


# ---- packing ----


def test_differencing_keeps_every_item_once_and_evens_windows_out():
    rng = random.Random(3)
    for n, k in itertools.product((1, 2, 7, 40, 200), (1, 2, 5, 30)):
        sizes = [rng.randrange(1, 257) for _ in range(n)]
        windows = packing.difference(sizes, k)
        assert sorted(i for _, items in windows for i in items) == list(range(n))
        assert all(total == sum(sizes[i] for i in items) for total, items in windows) and len(windows) <= k
        if n >= 10 * k:
            assert max(t for t, _ in windows) - min(t for t, _ in windows) <= 16


def test_differencing_merges_by_hand():
    # 8|7 and 6|5 lie 1 apart each; 4 goes on the 7, then 11|8 meets 5|6
    windows = packing.difference([8, 7, 6, 5, 4], 2)
    assert sorted(total for total, _ in windows) == [14, 16]


def test_windows_rise_until_nothing_is_over_capacity():
    for sizes in ([], [1], [256] * 9, [200] * 30, [255, 256, 3] * 50, [1024, 1024, 5]):
        windows = packing.pack_items(sizes, 1024)
        assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in w) <= 1024 for w in windows)
    assert len(packing.pack_items([200] * 30, 1024)) == 6


def test_little_padding_over_a_group():
    rng = random.Random(9)
    lengths = [rng.randrange(1, 4000) for _ in range(packing.GROUP)]
    pieces = list(packing._pieces(lengths, 1024))
    held = Counter()
    for _, _, length, sequence, _ in pieces:
        held[sequence] += length
    assert sum(held.values()) == sum(lengths) and max(held.values()) <= 1024
    assert sum(1024 - n for n in held.values()) <= 0.01 * 1024 * len(held)


# ---- quality ----


def _by_enumeration(unary, moves):
    n = len(unary)
    weights = {}
    for path in itertools.product((0, 1), repeat=n):
        weights[path] = math.exp(sum(u for u, y in zip(unary, path) if y) + sum(moves[a][b] for a, b in zip(path, path[1:])))
    total = sum(weights.values())
    return [sum(w for p, w in weights.items() if p[i]) / total for i in range(n)]


def test_marginals_equal_enumeration_for_chains_of_any_length():
    r = np.random.default_rng(4)
    sizes = [1, 5, 2, 9, 1, 7]
    starts = np.cumsum([0] + sizes[:-1])
    unary, moves = r.normal(size=sum(sizes)), r.normal(size=(2, 2))
    forward, backward = quality._passes(unary, starts, moves)
    got = quality._sigmoid(forward + backward)
    want = np.concatenate([_by_enumeration(unary[a : a + n], moves) for a, n in zip(starts, sizes)])
    assert np.allclose(got, want, atol=1e-12)


def test_line_features_by_hand():
    table, length, starts = quality.line_features([b"AB cd.\nAB cd.", None, b"x"])
    f = dict(zip(quality.FEATURES, table[0]))
    assert length.tolist() == [6, 6, 0, 1] and starts.tolist() == [0, 2, 3]
    assert f["upper"] == pytest.approx(2 / 5) and f["marks"] == pytest.approx(1 / 2) and f["repeated"] == 1 and f["ending"] == 1
    assert f["distinct"] == 1 and table[3][quality.FEATURES.index("repeated")] == 0


def test_field_learns_from_neighbours_and_ignores_batching():
    rng = random.Random(0)
    good = lambda: " ".join(rng.choice(["the", "of", "house", "green", "walks"]) for _ in range(9)) + "."
    bad = lambda: " | ".join(rng.choice(["BUY", "NOW", "$$$", "&&&"]) for _ in range(9))
    texts, labels = [], []
    for i in range(200):
        y = i % 2
        texts.append("\n".join((good if y else bad)() for _ in range(rng.randrange(1, 6))).encode())
        labels.append(y)
    table, _, starts = quality.line_features(texts)
    field = quality.fit_field(table, starts, np.array(labels))
    scores = quality.score_texts(field, texts)
    assert ((scores >= 0.7) == np.array(labels, bool)).mean() > 0.98
    assert np.allclose(scores, np.concatenate([quality.score_texts(field, [t]) for t in texts]))
    assert 0 <= quality.score_texts(field, [None])[0] <= 1


# ---- fingerprints ----


def test_likeness_falls_with_edits():
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    near = text[:2000] + "Z" + text[2000:]
    half = text[:2000] + "".join(rng.choice("qrstuvw ") for _ in range(2000))
    other = "".join(rng.choice("qrstuvw ") for _ in range(4000))
    a, b, c, d = fingerprint.fingerprints([text, near, half, other])
    assert fingerprint.likeness(a, a) == 1 and fingerprint.likeness(a, b) > 0.85
    assert 0.35 < fingerprint.likeness(a, c) < 0.65 and fingerprint.likeness(a, d) < 0.1


def test_fingerprints_do_not_depend_on_company():
    texts = ["", "a", "abc" * 500, "é中😀" * 30, "x" * 5000]
    together = fingerprint.fingerprints(texts)
    assert all((x == fingerprint.fingerprints([t])[0]).all() for x, t in zip(together, texts))
    assert len(together[0]) == 0 and fingerprint.likeness(together[0], together[0]) == 1 and fingerprint.likeness(together[0], together[1]) == 0


def test_walk_equals_a_plain_walk():
    text = "abcabcaabbcc" * 20
    code, p, step, seen = fingerprint.codes(text), 0, 0, {}
    while p < len(code):
        seen[step] = p
        p += int(fingerprint._moves(step // (fingerprint.STRIDE * 8))[step % (fingerprint.STRIDE * 8), code[p]])
        step += 1
    symbols = fingerprint.walk([text])[0]
    for level in range(len(symbols) // fingerprint.SAMPLES):
        for s, column in fingerprint._sampled(level).items():
            assert (symbols[column] > 0) == (s in seen)


def test_near_links_equal_all_pairs_where_bands_meet(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(1500)) for _ in range(12)]
    texts = base + [t[:700] + "!" + t[701:] for t in base]
    crowd = [base[0][: 1490] + f"{i:04d}" for i in range(90)]  # a bucket too large to pair up
    fps = [fingerprint.as_text(s) for s in fingerprint.fingerprints(texts + crowd)]
    df = spark.createDataFrame([(f,) for f in fps], "fp string")
    found = {(r["a"], r["b"]) for r in fingerprint.near_links(df, 0.8).collect()}
    symbol = {f: s for f, s in zip(fps, fingerprint.fingerprints(texts + crowd))}
    want = {(a, b) for a, b in itertools.combinations(sorted(set(fps)), 2) if fingerprint.likeness(symbol[a], symbol[b]) >= 0.8}
    assert found <= want and len(found) >= 0.9 * len(want)


def _alike_classes(fps, least):
    """Classes by comparing every fingerprint with every other."""
    table = fingerprint._symbols(fps, max(map(len, fps)))
    left, classes = set(range(len(fps))), []
    while left:
        todo, own = [left.pop()], set()
        while todo:
            i = todo.pop()
            own.add(fps[i])
            met = set(np.flatnonzero(fingerprint._likenesses(table[i], table) >= least).tolist()) & left
            left -= met
            todo += met
        classes.append(frozenset(own))
    return set(classes)


def test_classes_of_a_crowd_of_thousands_equal_all_pairs(spark):
    rng = random.Random(10)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1200))
    def edited(text, n):
        for _ in range(n):
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice("xyz") + text[at + 1 :]
        return text
    # one crowd of 2,500 around one text, a second that some of them lead to
    far = edited(base, 40)
    texts = [edited(base, rng.randrange(1, 14)) for _ in range(2000)] + [edited(far, rng.randrange(1, 14)) for _ in range(500)]
    texts += ["".join(rng.choice("abcdefgh ") for _ in range(1200)) for _ in range(100)]
    fps = sorted({fingerprint.as_text(s) for s in fingerprint.fingerprints(texts)})
    got = {}
    for r in fingerprint.near_classes(spark.createDataFrame([(f,) for f in fps], "fp string")).collect():
        got.setdefault(r["root"], set()).add(r["fp"])
    want = _alike_classes(fps, 0.8)
    root = {f: k for k, c in got.items() for f in c}
    linked = sum(len(c) - 1 for c in want)
    assert sorted(root) == fps and all(any(c <= w for w in want) for c in map(frozenset, got.values()))
    kept = sum(len(c) - len({root[f] for f in c}) for c in want)
    print("classes", len(got), "of", len(want), "largest", max(map(len, want)), "links kept", kept, "of", linked)
    assert linked > 1500 and kept >= 0.99 * linked


# ---- simhash ----


def _plain_simhash(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_a_plain_count():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["A", "bé", "Ç", "d e", "f,"]) for _ in range(n)) for n in (0, 1, 2, 3, 4, 50)] + [None, " \n", "x\ty  z"]
    for text in texts:
        assert simhash.simhash(text.encode() if text is not None else None, 3) == _plain_simhash(text, 3)


def _components(fps, bits):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(fps), 2):
        if (a ^ b).bit_count() <= bits:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    groups = {}
    for f in fps:
        groups.setdefault(find(f), set()).add(f)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("bits, bucket", [(0, 32), (1, 32), (2, 32), (2, 2)])
def test_near_links_connect_what_brute_force_connects(spark, bits, bucket):
    rng = random.Random(bits + bucket)
    fps = {0, (1 << 64) - 1}
    for _ in range(25):
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            fps.add(f)
            for _ in range(rng.randrange(1, 4)):
                f ^= 1 << rng.randrange(64)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, bucket)
    found = {}
    for r in components.connected_components(links).collect():
        found.setdefault(r["root"], set()).add(r["node"] % (1 << 64))
    assert {frozenset(g) for g in found.values()} == _components(fps, bits)


def test_components_of_a_long_chain_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7), (5000, 5000), (2001, 2000)]
    random.Random(1).shuffle(links)
    rows = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in rows}
    assert len(rows) == len(roots) == 301 + 200 + 2
    assert {roots[i] for i in range(301)} == {0} and {roots[1000 + i] for i in range(200)} == {1000} and roots[2001] == 2000


# ---- mixing ----


def test_levels_equal_repeated_resharing(spark):
    rng = random.Random(12)
    for _ in range(3):
        sizes = [rng.choice([0, 1, 5, 50, 400, 5000]) for _ in range(9)]
        weights = [float(rng.choice([5, 2, 1])) for _ in sizes]
        capped, target = set(), [0.0] * 9
        while True:
            left = sum(sizes) - sum(3 * sizes[i] for i in capped)
            weight = sum(w for i, w in enumerate(weights) if i not in capped)
            target = [3.0 * sizes[i] if i in capped else left * weights[i] / weight for i in range(9)]
            over = {i for i in range(9) if i not in capped and target[i] > 3 * sizes[i]}
            if not over:
                break
            capped |= over
        names = [f"s{i}" for i in range(8)] + [None]
        sized = spark.createDataFrame([(s, 1, n) for s, n in zip(names, sizes)], "source string, n long, source_size long")
        table = spark.createDataFrame(list(zip(names, weights)), "source string, weight double")
        got = {r["source"]: r["target"] for r in mixing.source_targets(sized, table, 3).collect()}
        assert all(got[s] == pytest.approx(t, rel=1e-12) for s, t in zip(names, target))


def test_splitting_tree_keeps_quotas_and_shard_sizes(spark):
    quotas = [0, 1, 7, 400, 12_345, 90]
    df = spark.createDataFrame(list(enumerate(quotas)), "sid int, blocks long")
    for shards in (1, 2, 7, 40):
        rows = mixing.split_quotas(df, shards, seed=1).collect()
        assert len(rows) == shards * len(quotas) and min(r["n"] for r in rows) >= 0
        by_source, by_shard = Counter(), Counter()
        for r in rows:
            by_source[r["sid"]] += r["n"]
            by_shard[r["shard"]] += r["n"]
        assert [by_source[i] for i in range(len(quotas))] == quotas
        assert max(by_shard.values()) - min(by_shard[s] for s in range(shards)) <= 1
        assert {(r["sid"], r["shard"], r["n"]) for r in mixing.split_quotas(df, shards, seed=1).collect()} == {tuple(r) for r in rows}


def test_draws_follow_the_hypergeometric_distribution(spark):
    pop, hits, draws, n = 60, 25, 18, 4000
    expr = mixing._hypergeometric("pop", "hits", "draws", "u")
    rows = spark.range(n).selectExpr(f"{pop}L AS pop", f"{hits}L AS hits", f"{draws}L AS draws", f"(id + 0.5D) / {n} AS u").selectExpr(f"{expr} AS k").groupBy("k").count().collect()
    exact = {k: math.comb(hits, k) * math.comb(pop - hits, draws - k) / math.comb(pop, draws) for k in range(draws + 1)}
    assert all(abs(r["count"] / n - exact[r["k"]]) < 2 / n for r in rows)


def test_first_words_keeps_white_space(spark):
    df = spark.createDataFrame([(" a  b\tc\nd ",)], "t string")
    assert df.select(mixing.first_words(F.col("t"), F.lit(3))).first()[0] == " a  b\tc"


# ---- language model ----


def test_weights_prefer_what_explains_the_counts():
    cells = np.zeros((lm.BUCKETS, lm.BINS))
    cells[0, lm.BINS - 1] = 10.0  # pairs far likelier than their words
    cells[1, 0] = 10.0  # pairs that were never seen elsewhere
    w = lm.fit_weights(cells)
    assert w[0] > 0.9 and w[1] < 1e-3 and w[2] == 0


def test_crc_of_ids_is_the_plain_one(spark):
    from seqprep.llm.tokens import _checksums

    ids = [[1, 70000], [], list(range(500))]
    rows = spark.createDataFrame([(i, x, 0, i) for i, x in enumerate(ids)], "doc_id long, ids array<int>, _file long, _row long")
    got = rows.coalesce(1).mapInArrow(_checksums, "doc_id long, n_tokens long, ids_crc32 long, _file long, _row long").orderBy("doc_id").collect()
    assert [r["ids_crc32"] for r in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert [r["n_tokens"] for r in got] == [2, 0, 500]


def test_starts_follow_file_numbers_beyond_99999(spark):
    from seqprep.llm.tokens import with_starts

    rows = spark.createDataFrame([(f, r, 10) for f in (99_999, 100_000, 100_001) for r in (0, 1)], "_file long, _row long, n_tokens long")
    totals = spark.createDataFrame([(99_999, 20), (100_000, 20), (100_001, 20)], "_file long, total long")
    got = {(r["_file"], r["_row"]): r["start"] for r in with_starts(rows, totals).collect()}
    assert [got[k] for k in sorted(got)] == [0, 10, 20, 30, 40, 50]
