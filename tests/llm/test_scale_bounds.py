"""What keeps the operators right or bounded as their input grows."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seqprep.llm import dedup, encoding, lm, mixing, packing, repeats

BPE = public_tokenizers.path("byte_bpe_50k.json")


# ---- mixing: the block permutation ----


def _orders(spark, counts, key="7L, n"):
    rows = spark.createDataFrame([(n,) for n in counts], "n long").withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    found = defaultdict(dict)
    for r in mixing.permuted(rows, "x", "n", key, "y").collect():
        found[r["n"]][r["x"]] = r["y"]
    return {n: [at[x] for x in range(n)] for n, at in found.items()}


def test_blocks_are_permuted_for_every_count(spark):
    orders = _orders(spark, range(1, 1001))
    assert all(sorted(order) == list(range(n)) for n, order in orders.items()) and len(orders) == 1000
    for n, order in orders.items():
        if n >= 32:
            # no rotation, reversal or other affine order: neighbours' distances differ
            steps = {(b - a) % n for a, b in zip(order, order[1:])}
            assert len(steps) > n // 4
    # far from the identity, and another one for another key
    large, other = orders[1000], _orders(spark, [1000], "8L, n")[1000]
    assert sum(a == i for i, a in enumerate(large)) < 15 and sum(a == b for a, b in zip(large, other)) < 15


def test_large_block_numbers_stay_in_range_and_apart(spark):
    n = (1 << 40) + 12_345
    rows = spark.range(20_000).select((F.lit(n) - 1 - F.col("id") * 7919).alias("x"), F.lit(n).alias("n"))
    ys = [r["y"] for r in mixing.permuted(rows, "x", "n", "7L", "y").collect()]
    assert len(set(ys)) == len(ys) and min(ys) >= 0 and max(ys) < n
    assert abs(np.mean(ys) / n - 0.5) < 0.02


def test_no_blocks_no_rows(spark):
    assert mixing.permuted(spark.createDataFrame([], "x long, n long"), "x", "n", "7L", "y").count() == 0


# ---- exact dedup: state partitions ----


def test_state_partitions_follow_the_keys(spark, tmpdir_path, monkeypatch):
    keys = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("digest"), "id", F.lit("f").alias("_file"), F.col("id").alias("_row"))
    keys.write.parquet(f"{tmpdir_path}/keys")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(dedup, "partitions_for", lambda df: 3 + int(before))
    state = dedup.run_state(spark, f"{tmpdir_path}/keys", keys.schema, f"{tmpdir_path}/state")
    assert state.count() == 4000
    stored = spark.read.format("statestore").load(f"{tmpdir_path}/state")
    assert stored.select("partition_id").distinct().count() == 3 + int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


# ---- packing: groups bounded by tokens ----


def test_groups_end_at_their_tokens(monkeypatch):
    sizes = []
    pieces = packing._pieces
    monkeypatch.setattr(packing, "_pieces", lambda lengths, capacity: sizes.append(list(lengths)) or pieces(lengths, capacity))
    monkeypatch.setattr(packing, "GROUP_TOKENS", 5_000)
    monkeypatch.setattr(packing, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 2})())}))
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.choice([3, 50, 4_000]))) for _ in range(60)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = pa.Table.from_batches(packing._packer(BPE, 0, 1024, False)(iter([batch])))
    # a group ends with the document that brings it to the bound
    assert all(sum(group[:-1]) < 5_000 for group in sizes) and len(sizes) > 5
    rows = out.to_pylist()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    assert len(by_doc) == len(texts)
    for parts in by_doc.values():
        parts.sort(key=lambda r: r["start"])
        ends = [r["start"] + r["length"] for r in parts]
        assert [r["start"] for r in parts] == [0, *ends[:-1]] and ends[-1] == parts[0]["doc_tokens"]
    held = defaultdict(int)
    for r in rows:
        held[r["sequence_id"]] += r["length"]
    assert max(held.values()) <= 1024 and min(held) >= 2 << 32


# ---- packing: memory of a worker ----


def test_few_kept_pieces_and_small_batches_pack_the_same(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 9))) for _ in range(60)) for _ in range(40)] + [None, "", "a  b"]
    monkeypatch.setattr(encoding, "_ENCODERS", {})
    first = encoding.encoder(BPE)
    want = [first.encode(pa.array([t], pa.string()))[0].tolist() for t in texts]
    few = encoding.encoder(BPE, 200)
    assert few is first and not few.pieces and not few.old  # what a query before it kept is gone
    held = []
    for text, ids in zip(texts, want):
        assert few.encode(pa.array([text], pa.string()))[0].tolist() == ids
        held.append(len(few.pieces) + len(few.old))
    assert max(held) <= 400 < len({w for t in texts for w in (t or "").split()})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    plain = packing.pack_documents(docs, BPE, with_ids=True).collect()
    assert packing.pack_documents(docs, BPE, with_ids=True, batch_bytes=1 << 10, kept_pieces=200).collect() == plain


def test_the_pipelines_packing_keeps_its_workers_small(spark, monkeypatch):
    kept = []
    packer = packing._packer
    monkeypatch.setattr(packing, "_packer", lambda *a: kept.append(a[4]) or packer(*a))
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    assert corpus_pipeline.packing(spark, docs, "").count() == 1
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 1 << 20 and kept == [150_000]


def test_the_pipelines_stages_keep_executors_small(spark, monkeypatch, tmpdir_path):
    batch = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, f"some words {i % 3} of a text") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    labels.write.parquet(f"{tmpdir_path}/labels.parquet")
    for stage in (corpus_pipeline.quality, corpus_pipeline.near):
        spark.conf.set(batch, str(32 << 20))
        stage(spark, docs, tmpdir_path).count()
        assert int(spark.conf.get(batch)) <= 1 << 20
    # the stores are bounded together, when the state is built and when it is read
    bounded, seen = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", []
    kept = dedup.written
    monkeypatch.setattr(dedup, "written", lambda df, kind: seen.append((kind, spark.conf.get(bounded, None))) or kept(df, kind))
    assert corpus_pipeline.exact(spark, docs, "").count() == 3
    assert dict(seen)["groups"] == "true" and dict(seen)["hits"] is None


# ---- repeated strings: files of the tables in between ----


def test_repeats_write_few_files(spark, monkeypatch, tmpdir_path):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(500)]
    shared = " ".join(rng.choice(words) for _ in range(120))
    texts = [" ".join(rng.choice(words) for _ in range(60)) + shared + str(i) + shared for i in range(120)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(40).write.parquet(f"{tmpdir_path}/docs")
    docs = spark.read.parquet(f"{tmpdir_path}/docs")
    most, files = 2 * spark.sparkContext.defaultParallelism, {}

    def counted(df, kind):
        out = keep(df, kind)
        files[kind] = len(out.inputFiles())
        return out

    keep = repeats.written
    monkeypatch.setattr(repeats, "written", counted)
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.files.openCostInBytes": "64m", "spark.sql.files.maxPartitionBytes": "64m"}
    with dedup._settings(spark, settings):
        done = repeats.remove_repeats(docs, hot=2)
        assert done.count() == 120 and done.rdd.getNumPartitions() <= most < docs.rdd.getNumPartitions()
    assert {"anchors", "regions", "region-texts"} <= set(files)
    assert max(files[k] for k in ("anchors", "regions", "region-texts")) <= most


# ---- language model: counts of other executors ----


def test_counts_that_are_not_visible_raise(tmp_path):
    assert all(len(a) == 0 for a in lm._counted(f"{tmp_path}/none", 3, 0))
    with pytest.raises(FileNotFoundError, match="shard 3"):
        lm._counted(f"{tmp_path}/none", 3, 5)
    three = {k: np.arange(3, dtype=np.uint64) for k in ("context", "word", "n")}
    lm.write_arrays(f"{tmp_path}/counts-1", three)
    assert [a.tolist() for a in lm._counted(f"{tmp_path}/counts-1", 1, 3)] == [[0, 1, 2]] * 3
    with pytest.raises(OSError, match="not 5"):
        lm._counted(f"{tmp_path}/counts-1", 1, 5)


def test_training_fails_without_a_shards_counts(spark, monkeypatch):
    texts = spark.createDataFrame([(f"a b c {i} d e",) for i in range(300)], "text string")
    merge = lm._merge_pairs

    def losing(model):
        inner = merge(model)
        root = model.path

        def run(key, table):
            import os

            out = inner(key, table)
            if key[0].as_py() == 1:
                os.replace(f"{root}/counts-1", f"{root}/elsewhere")
            return out

        return run

    monkeypatch.setattr(lm, "_merge_pairs", losing)
    with pytest.raises(Exception, match="pairs of shard 1"):
        lm.train(texts, shards=3)
