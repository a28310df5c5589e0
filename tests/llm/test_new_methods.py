"""Repeated strings, periodic runs and fill-in-the-middle against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from seqprep.llm import induce, infill, periods, repeats
from tests.llm.test_queries import SF, docs, result  # noqa: F401  (a fixture)

# ---- external induced sorting ----


def plain_repeated(text, length):
    seen = defaultdict(list)
    for i in range(len(text)):
        seen[bytes(text[i : i + length])].append(i)
    want = np.zeros(len(text), bool)
    for places in seen.values():
        if len(places) > 1:
            want[places] = True
    return want


@pytest.mark.parametrize("base, memory", [(1 << 20, 1 << 20), (0, 1 << 20), (2, 64)])  # by doubling, by recursion, on disk
def test_induced_sorting_finds_repeated_strings(tmp_path, base, memory):
    rng = random.Random(base + memory)
    for turn in range(120):
        letters = rng.choice([1, 2, 3, 5, 20])
        body = [rng.randint(1, letters) for _ in range(rng.randint(1, 300))]
        if turn % 2:
            part = body[: rng.randint(1, len(body))]
            body = body + part + body[::2] + part
        text = np.array([*body, 0], np.uint8)
        length = rng.choice([1, 2, 3, 5, 8, 20, 50])
        got = induce.repeated(text, length, memory, str(tmp_path / str(turn)), base)
        assert (got == plain_repeated(text, length)).all()
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


@pytest.mark.parametrize("base", [1 << 20, 0])
def test_induced_suffixes_are_in_order(base):
    rng = random.Random(3)
    for _ in range(60):
        text = np.array([rng.randint(1, 3) for _ in range(rng.randint(1, 80))] + [0], np.uint8)
        order, prefix = [], []
        for pos, lcp in induce.sorted_suffixes(text, 1000, induce.Store(), base):
            order += pos.tolist()
            prefix += lcp.tolist()
        t = bytes(text)
        want = sorted(range(len(t) - 1), key=lambda i: t[i:], reverse=True)
        assert order == want
        for a, b, n in zip(want, want[1:], prefix[1:]):
            shared = next(k for k in range(len(t)) if t[a + k] != t[b + k])
            assert n == (shared if t[a] == t[b] else 0)


# ---- repeated strings in documents ----


def plain_removal(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate(([0], gone))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def cut(df, **options):
    done = repeats.remove_repeats(df, **options)
    return done.select("id", "n_bytes", "n_removed", F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("sha")).collect()


def test_repeated_strings_of_all_documents(spark, docs):  # noqa: F811
    got = result(spark, "op11_repeated_strings")
    want = plain_removal([t.encode() for t in docs.text], 400)
    assert [tuple(r) for r in got[["n_bytes", "n_removed", "n_spans", "kept_sha256"]].itertuples(index=False)] == want


@pytest.mark.parametrize("hot, memory", [(512, 1 << 26), (1, 1 << 26), (3, 1 << 12)])
def test_repeated_strings_of_crowded_regions(spark, hot, memory):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
    shared = " ".join(word() for _ in range(120))
    texts = [" ".join(word() for _ in range(rng.randint(0, 40))) + rng.choice(["", " ", "x"]) + shared + " ".join(word() for _ in range(20)) for _ in range(60)]
    texts += [texts[0]] * 5 + ["ab" * 900, "ab" * 300, "", shared[:300], "a" * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["id"]: tuple(r)[1:] for r in cut(df, hot=hot, memory=memory, shard=1 << 14)}
    assert [got[i] for i in range(len(texts))] == plain_removal([t.encode() for t in texts], 400)


def test_long_texts_are_cut_into_chunks(spark, monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    texts = [text, "zz" + text[100:], text[::-1]]
    want = plain_removal([t.encode() for t in texts], 400)
    monkeypatch.setattr(repeats, "CHUNK", 900)
    bounds = np.cumsum([0, *map(len, texts)])
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = []
    for low, high, a, b, base in repeats._chunks(bounds, 400):
        doc, first, last, _, _ = repeats.anchors(raw[low:high], a, b, 400)
        starts += [x for f, e in zip(first + low, last + low) for x in range(f, e + 1)]
    assert sorted(starts) == [x for a, b in zip(bounds, bounds[1:]) for x in range(a, b - 399)]  # every start once
    assert want[0][1] > 4000


def test_short_texts_are_hashed_in_groups_that_fit_a_cache(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([0, 90, 399, 400, 2000]))).encode() for _ in range(400)]
    texts[7] = texts[7] + b"x" * 150_000  # one longer than a group stays whole
    held, anchors = [], repeats.anchors
    monkeypatch.setattr(repeats, "anchors", lambda raw, *a: held.append(len(raw)) or anchors(raw, *a))
    column = pa.array(texts, pa.binary())
    rows = pa.RecordBatch.from_arrays([pa.array([5] * 400), pa.array(range(400)), column], names=["file", "row", "text"])
    (got,) = repeats._anchor_batches(400)([rows])
    assert max(n for n in held if n < 150_000) <= 1 << 17 and len([n for n in held if n >= 150_000]) == 1
    starts = sorted((r["row"], s) for r in got.to_pylist() for s in range(r["a"], r["b"] + 1))
    assert starts == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - 399)]  # every start once
    for r in got.to_pylist()[::50]:
        text = texts[r["row"]][r["a"] : r["b"] + 400]
        assert r["digest"] == np.array(xxhash.xxh64_intdigest(text), np.uint64).view(np.int64) and r["a"] <= r["at"] <= r["a"] + 300 + r["b"] - r["a"]


def test_repeated_strings_on_odd_rows(spark, odd, empty):
    got = Counter((r["id"], r["n_bytes"], r["n_removed"], r["sha"]) for r in cut(odd))
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in odd.collect()]
    want = plain_removal([t for _, t in rows], 400)
    assert got == Counter((i, n, g, h) for (i, _), (n, g, _, h) in zip(rows, want))
    assert cut(empty) == []


# ---- periodic runs ----


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, q, b - a) for (a, b), q in found.items())


def periodic_texts():
    rng = random.Random(9)
    texts = [None, "", " \t\n ", "a", "a " * 5, "a " * 6, " ".join("ab" * 40), "x " + "a b c " * 30 + "a b d"]
    for _ in range(60):
        words = [rng.choice("abcde") for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 4)):
            block = [rng.choice("abcde") for _ in range(rng.randint(1, 20))]
            at = rng.randint(0, len(words))
            words[at:at] = (block * 9)[: rng.randint(1, 9 * len(block))]
        texts.append(rng.choice([" ", "\n", " \x0b\f "]).join(words))
    return texts


@pytest.mark.parametrize("span", [16, 64, 1 << 14])  # nearly all documents in pieces, some, none
def test_runs_whatever_the_span(spark, span):
    texts = periodic_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in periods.collapse_runs(df, span=span).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r["id"]] or "")
        runs = [(x["start"], x["period"], x["length"]) for x in r["runs"]]
        assert runs == plain_runs(words)
        gone = {i for a, q, n in runs for i in range(a + q, a + n)}
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_on_odd_rows(spark, odd, empty):
    got = Counter((r["id"], len(r["runs"]), r["collapsed"]) for r in periods.collapse_runs(odd).collect())
    want = Counter()
    for r in odd.collect():
        words = (r["text"] or "").split()
        runs = [(0, 2, len(words))] if len(words) > 100 else []  # the long text is "ab cd. " over and over
        want[r["doc_id"], len(runs), " ".join(words[:2] if runs else words)] += 1
    assert got == want
    assert periods.collapse_runs(empty).count() == 0


# ---- fill in the middle ----


def plain_infill(doc_id, text, rate, spm_rate):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(lines), "plain", None, None, text
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < spm_rate:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block", [1, 3, 1024])
@pytest.mark.parametrize("rate", [100, 40])
def test_infill_whatever_the_block(spark, block, rate):
    rng = random.Random(4)
    texts = ["", "\n", "\n\n\n", "one", "one\n", "é\n中文😀\nx", "a <P> b\n", "<M>", "<S\n>x\n<", "<\nS>\n"]
    texts += ["".join(rng.choice("ab é😀\n<PSM>") for _ in range(rng.randint(0, 400))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = infill.fill_in_middle(df, seed=7, rate=rate, block=block)
    for r in done.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect():
        assert tuple(r)[1:6] == plain_infill(r["id"], texts[r["id"]], rate, 50) and r["back"] == texts[r["id"]]


def test_infill_on_odd_rows(spark, odd, empty):
    got = Counter(tuple(r) for r in infill.fill_in_middle(odd, seed=7).collect())
    assert got == Counter((r["doc_id"], *plain_infill(r["doc_id"], r["text"] or "", 100, 50)) for r in odd.collect())
    assert infill.fill_in_middle(empty, seed=7).count() == 0


def test_line_index_finds_every_cut():
    text = ("line\n" * 700 + "\n" * 300 + "é" * 5000 + "\nlast").encode()
    for block in (1, 7, 64, 1024, 1 << 20):
        index = infill.LineIndex(np.frombuffer(text, np.uint8), block)
        ends = [0] + [m.end() for m in re.finditer(rb"[^\n]*\n|[^\n]+", text)]
        assert index.n == len(ends) - 1
        for k in (0, 1, 350, 699, 700, 701, 1000, index.n - 1, index.n):
            assert index.after(k) == (ends[k], len(text[: ends[k]].decode()))
