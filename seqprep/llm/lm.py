"""Language-model scores from an Elias-Fano n-gram trie.

The trie has two levels, cut into shards by hash so that each stays small
whatever the corpus. Level one holds the words (64-bit hashes, Elias-Fano) and
their counts; a word's rank in it is its id. Level two holds, per context word,
its successors' ids in ascending order behind monotone pointers (Elias-Fano and
unary), and for each the quantised logarithm of its smoothed probability. A
query finds the context, selects its pointer pair, and searches the successor
inside that range only. Shards are files in the shared checkpoint folder that
tasks map into memory, so a task holds the pages it touches, not the model.

Counting is distributed: tasks count their own words and pairs, send one packed
block per shard, and one task per shard merges the blocks. Smoothing is
interpolated: ``p(w|v) = k p_ml(w|v) + (1 - k) p(w)``, where ``k`` depends on
how often ``v`` occurs (one weight per power of two) and is fitted by
expectation maximisation on leave-one-out counts of the whole corpus.

The checkpoint folder must be a mounted path, since files are mapped.

Defined results: a null or empty text is its end token alone; repeated rows
count and score once each; without training rows every word is unknown; an
empty table gives an empty result; extra columns are ignored. Words are told
apart by 64-bit hashes.
"""

from __future__ import annotations

import mmap
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.llm.common import bounded_batches, partitions_for, scratch_path
from seqprep.llm.eliasfano import EliasFano, Unary, from_bytes, search, to_bytes

END = np.uint64(xxhash.xxh64_intdigest(b"\n"))  # no word holds white space
FLUSH = 4_000_000  # tokens a task counts before it sends blocks
STEPS = 2048  # quantised levels per unit of log10
BUCKETS, BINS = 64, 96
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """What a task needs to open the trie: one number per shard and the weights."""

    path: str
    bases: tuple[int, ...]  # rank of the first word of each shard, then the vocabulary size
    tokens: int
    weights: tuple[float, ...] = ()

    @property
    def shards(self) -> int:
        return len(self.bases) - 1

    @property
    def vocabulary(self) -> int:
        return self.bases[-1]

    def p_word(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1))


# ---- files -----------------------------------------------------------------


def mounted(path: str) -> str:
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"the trie's files are mapped into memory: spark.checkpoint.dir must be a mounted folder, not {path}")
    return url.path


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of named arrays, moved into place when complete (a task that
    runs twice writes the same file)."""
    arrays = {k: np.ascontiguousarray(a) for k, a in arrays.items()}
    head, at = [], 4096
    for name, a in arrays.items():
        head.append(f"{name} {a.dtype.str} {len(a)} {at}")
        at += -(-a.nbytes // 64) * 64
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write("\n".join(head).encode().ljust(4096, b"\n"))
        for a in arrays.values():
            f.write(a.tobytes().ljust(-(-a.nbytes // 64) * 64, b"\0"))
    os.replace(part, path)


def read_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file as views of its mapping."""
    with open(path, "rb") as f:
        pages = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    out = {}
    for line in pages[:4096].decode().split("\n"):
        if line:
            name, kind, n, at = line.split()
            out[name] = np.frombuffer(pages, np.dtype(kind), int(n), int(at))
    return out


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length as byte planes, compressed."""
    planes = b"".join(c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    size = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(pa.Codec("zstd").decompress(blob[8:], size), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(c.T).view("<u8").reshape(-1) for c in raw]


# ---- words and shards ------------------------------------------------------


def token_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (each text ends with END) and each text's first place."""
    digest = xxhash.xxh64_intdigest
    parts, starts, at = [], [], 0
    for text in texts:
        words = (text or b"").lower().split()  # on bytes: ASCII letters and white space only
        starts.append(at)
        at += len(words) + 1
        parts += [np.fromiter(map(digest, words), np.uint64, len(words)), np.array([END])]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array(starts, np.int64)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards by the upper half of the hash; ascending with it."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def shard_start(shard: int, shards: int) -> int:
    return -(-(shard << 32) // shards) << 32


def pair_shard(context: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    mixed = (context * _SPREAD ^ word) * _SPREAD
    return shard_of(mixed ^ (mixed >> np.uint64(29)), shards)


def pair_order(context: np.ndarray, word: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order of the pairs, and where a new pair begins in it."""
    bits = max(1, vocabulary.bit_length())
    if 2 * bits <= 64:
        key = context << np.uint64(bits) | word
        order = np.argsort(key, kind="stable")
        key = key[order]
        return order, np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    order = np.lexsort((word, context))
    c, w = context[order], word[order]
    return order, np.concatenate(([True], (c[1:] != c[:-1]) | (w[1:] != w[:-1]))) if len(c) else np.zeros(0, bool)


def summed_pairs(context: np.ndarray, word: np.ndarray, count: np.ndarray, vocabulary: int) -> tuple[np.ndarray, ...]:
    order, new = pair_order(context, word, vocabulary)
    at = np.flatnonzero(new)
    return context[order][at], word[order][at], np.add.reduceat(count[order], at) if len(at) else count[:0]


@lru_cache(maxsize=256)
def _words(path: str, shard: int) -> tuple[EliasFano, np.ndarray]:
    arrays = read_arrays(f"{path}/words-{shard}")
    return EliasFano(arrays), arrays["count"]


@lru_cache(maxsize=256)
def _pairs(path: str, shard: int) -> dict | None:
    arrays = read_arrays(f"{path}/pairs-{shard}")
    return arrays | {
        "contexts": EliasFano(arrays), "pointers": Unary(arrays["pointer_words"], arrays["pointer_zeros_before"]),
        "width": int(arrays["word_width"][0]),
    }


def _each_shard(shards: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shards, kind="stable")
    ends = np.searchsorted(shards[order], np.arange(n + 1))
    for s in range(n):
        if ends[s] < ends[s + 1]:
            yield s, order[ends[s] : ends[s + 1]]


def find_words(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank (-1: unknown) and count of each word."""
    rank, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
    for s, at in _each_shard(shard_of(hashes, model.shards), model.shards):
        level, counts = _words(model.path, s)
        found = level.find(hashes[at] - np.uint64(shard_start(s, model.shards)))
        hit = found >= 0
        rank[at[hit]] = found[hit] + model.bases[s]
        count[at[hit]] = counts[found[hit]]
    return rank, count


def counts_of(model: Model, ranks: np.ndarray) -> np.ndarray:
    """Counts of the words with these ranks."""
    out = np.zeros(len(ranks), np.int64)
    bases = np.array(model.bases, np.int64)
    for s, at in _each_shard(np.searchsorted(bases[1:], ranks, "right"), model.shards):
        out[at] = _words(model.path, s)[1][ranks[at] - bases[s]]
    return out


def find_pairs(model: Model, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Quantised log10 probability of each successor in its context, or -1."""
    out = np.full(len(context), -1, np.int64)
    c, w = context.astype(np.uint64), word.astype(np.uint64)
    for s, at in _each_shard(pair_shard(c, w, model.shards), model.shards):
        level = _pairs(model.path, s)
        place = level["contexts"].find(c[at])
        at, place = at[place >= 0], place[place >= 0]
        lo, hi = level["pointers"].ones_before_zero(place - 1), level["pointers"].ones_before_zero(place)
        found = search(level["successors"], level["width"], lo, hi, w[at])
        out[at[found >= 0]] = level["log_p"][found[found >= 0]]
    return out


# ---- counting and building -------------------------------------------------


def _blocks(shards: np.ndarray, n: int, *columns: np.ndarray) -> pa.RecordBatch:
    rows = [(s, pack(*(c[at] for c in columns))) for s, at in _each_shard(shards, n)]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "block"]
    )


def _runs(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and text starts of about FLUSH tokens at a time."""
    kept, starts, n = [], [], 0
    for batch in batches:
        tokens, first = token_hashes(batch.column(0).to_pylist())
        kept.append(tokens)
        starts.append(first + n)
        n += len(tokens)
        if n >= FLUSH:
            yield np.concatenate(kept), np.concatenate(starts)
            kept, starts, n = [], [], 0
    if n:
        yield np.concatenate(kept), np.concatenate(starts)


def _count_words(shards: int):
    def count(batches):
        for tokens, _ in _runs(batches):
            words, n = np.unique(tokens, return_counts=True)
            yield _blocks(shard_of(words, shards), shards, words, n)

    return count


def _build_words(path: str, shards: int):
    def build(key, table):
        shard = key[0].as_py()
        words, n = (np.concatenate(c) for c in zip(*(unpack(b, 2) for b in table.column("block").to_pylist())))
        order = np.argsort(words, kind="stable")
        words = words[order]
        at = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        n = np.add.reduceat(n[order], at)
        first, end = shard_start(shard, shards), shard_start(shard + 1, shards)
        kind = "<u4" if int(n.max()) < 1 << 32 else "<u8"
        write_arrays(f"{path}/words-{shard}", EliasFano.build(words[at] - np.uint64(first), end - first) | {"count": n.astype(kind)})
        return pa.table({"shard": pa.array([shard], pa.int32()), "words": [len(at)], "tokens": [int(n.sum())]})

    return build


def _empty_shards(path: str, missing: list[int], shards: int) -> None:
    for s in missing:
        size = shard_start(s + 1, shards) - shard_start(s, shards)
        write_arrays(f"{path}/words-{s}", EliasFano.build(np.zeros(0, np.uint64), size) | {"count": np.zeros(0, "<u4")})


def contexts_of(ranks: np.ndarray, starts: np.ndarray, end_rank: int) -> np.ndarray:
    """The word before each token; a text begins after an end."""
    context = np.concatenate(([0], ranks[:-1])) if len(ranks) else ranks.copy()
    context[starts] = end_rank
    return context


def _count_pairs(model: Model):
    def count(batches):
        end_rank = int(find_words(model, np.array([END]))[0][0])
        for tokens, starts in _runs(batches):
            words, inverse = np.unique(tokens, return_inverse=True)
            ranks = find_words(model, words)[0][inverse]
            context = contexts_of(ranks, starts, end_rank).astype(np.uint64)
            c, w, n = summed_pairs(context, ranks.astype(np.uint64), np.ones(len(ranks), np.int64), model.vocabulary)
            yield _blocks(pair_shard(c, w, model.shards), model.shards, c, w, n)

    return count


def _bucket(count: np.ndarray) -> np.ndarray:
    return np.frexp(np.maximum(count, 1).astype(float))[1] - 1


def _merge_pairs(model: Model):
    """Sum a shard's pairs, keep them in a file, and return how often each
    (context bucket, leave-one-out ratio to the word's probability) occurs, and
    under -1 - shard the number of its pairs."""

    def merge(key, table):
        shard = key[0].as_py()
        c, w, n = (np.concatenate(x) for x in zip(*(unpack(b, 3) for b in table.column("block").to_pylist())))
        c, w, n = summed_pairs(c, w, n, model.vocabulary)
        write_arrays(f"{model.path}/counts-{shard}", {"context": c, "word": w, "n": n})
        of_context = counts_of(model, c.astype(np.int64))
        p_word = model.p_word(counts_of(model, w.astype(np.int64)))
        ratio = (n.astype(float) - 1) / np.maximum(of_context - 1, 1) / p_word
        with np.errstate(divide="ignore"):
            # bin 0: a pair seen once; then thirds of powers of two
            bins = np.where(ratio > 0, np.clip(np.floor(3 * np.log2(np.maximum(ratio, 1e-30))) + 16, 1, BINS - 1), 0).astype(np.int64)
        seen = np.bincount(_bucket(of_context) * BINS + bins, weights=n, minlength=BUCKETS * BINS)
        at = np.flatnonzero(seen)
        # one more row says how many pairs the shard's file has
        cell, number = np.append(at, -1 - shard), np.append(seen[at], len(n))
        return pa.table({"cell": pa.array(cell, pa.int32()), "n": pa.array(number, pa.float64())})

    return merge


def fit_weights(cells: np.ndarray) -> tuple[float, ...]:
    """Per context bucket the weight of the pair's own frequency, by EM."""
    ratio = np.concatenate(([0.0], 2.0 ** ((np.arange(1, BINS) - 16 + 0.5) / 3)))
    total = cells.sum(axis=1)
    k = np.full(len(cells), 0.5)
    for _ in range(300):
        own = k[:, None] * ratio
        k = np.where(total > 0, (cells * own / (own + 1 - k[:, None])).sum(axis=1) / np.maximum(total, 1), 0.0)
        k = np.clip(k, 1e-6, 0.999)
    return tuple(float(x) for x in np.where(total > 0, k, 0.0))


def _counted(path: str, shard: int, pairs: int) -> list[np.ndarray]:
    """A shard's summed pairs; an error where the file that another executor wrote
    is not there or not whole, as in a folder that is not shared."""
    if not pairs:
        return [np.zeros(0, np.uint64)] * 3
    if not os.path.exists(path):
        raise FileNotFoundError(f"{path} with the {pairs} pairs of shard {shard} is not visible here: spark.checkpoint.dir must be shared")
    arrays = list(read_arrays(path).values())
    if len(arrays[0]) != pairs:
        raise OSError(f"{path} has {len(arrays[0])} pairs of shard {shard}, not {pairs}")
    return arrays


def _build_pairs(model: Model, pairs: np.ndarray):
    """Write a shard's level two from its summed pairs, ``pairs`` of each shard."""

    def build(batches):
        weights = np.array(model.weights)
        width = max(1, -(-model.vocabulary.bit_length() // 8))
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                raw = f"{model.path}/counts-{shard}"
                if not os.path.exists(f"{model.path}/pairs-{shard}"):
                    c, w, n = _counted(raw, shard, int(pairs[shard]))
                    of_context = counts_of(model, c.astype(np.int64))
                    k = weights[_bucket(of_context)]
                    p = k * n / np.maximum(of_context, 1) + (1 - k) * model.p_word(counts_of(model, w.astype(np.int64)))
                    log_p = np.clip(np.rint(-np.log10(np.maximum(p, 1e-30)) * STEPS), 0, 65535).astype("<u2")
                    new = np.concatenate(([True], c[1:] != c[:-1])) if len(c) else np.zeros(0, bool)
                    contexts = c[new]
                    pointers = Unary.build(np.cumsum(new) - 1, len(contexts))
                    write_arrays(f"{model.path}/pairs-{shard}", EliasFano.build(contexts, max(1, model.vocabulary)) | {
                        "pointer_words": pointers["words"], "pointer_zeros_before": pointers["zeros_before"],
                        "successors": to_bytes(w, width), "word_width": np.array([width], "<u8"), "log_p": log_p,
                    })
                if os.path.exists(raw):
                    os.unlink(raw)
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32())], names=["shard"])

    return build


def train(texts: DataFrame, text_col: str = "text", shards: int | None = None) -> Model:
    """Count every row of ``texts`` and build the trie in the checkpoint folder.

    The driver receives three numbers per shard and the weights' table of
    ``BUCKETS * BINS`` cells."""
    spark = texts.sparkSession
    bounded_batches(spark)
    shards = shards or partitions_for(texts, 32 << 20)
    path = mounted(scratch_path(spark, "trie"))
    raw = texts.select(F.col(text_col).cast("string").cast("binary").alias("text"))
    block = "shard int, block binary"
    built = (
        raw.mapInArrow(_count_words(shards), block).groupBy("shard")
        .applyInArrow(_build_words(path, shards), "shard int, words long, tokens long").collect()
    )
    sizes = {r["shard"]: r["words"] for r in built}
    _empty_shards(path, [s for s in range(shards) if s not in sizes], shards)
    bases = np.concatenate(([0], np.cumsum([sizes.get(s, 0) for s in range(shards)])))
    model = Model(path, tuple(int(b) for b in bases), sum(r["tokens"] for r in built))
    cells, pairs = np.zeros(BUCKETS * BINS), np.zeros(shards, np.int64)
    if model.tokens:
        merged = raw.mapInArrow(_count_pairs(model), block).groupBy("shard").applyInArrow(_merge_pairs(model), "cell int, n double")
        for r in merged.groupBy("cell").agg(F.sum("n").alias("n")).collect():
            if r["cell"] >= 0:
                cells[r["cell"]] = r["n"]
            else:
                pairs[-1 - r["cell"]] = r["n"]
    model = Model(path, model.bases, model.tokens, fit_weights(cells.reshape(BUCKETS, BINS)))
    spark.range(shards, numPartitions=shards).selectExpr("CAST(id AS INT) AS shard").mapInArrow(_build_pairs(model, pairs), "shard int").count()
    return model


# ---- scoring ---------------------------------------------------------------


def score_texts(model: Model, texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """Scores of a few texts."""
    tokens, starts = token_hashes(texts)
    words, inverse = np.unique(tokens, return_inverse=True)
    rank, count = find_words(model, words)
    p_word = np.log10(model.p_word(count))[inverse]
    rank, count = rank[inverse], count[inverse]
    end_rank, end_count = (int(x[0]) for x in find_words(model, np.array([END])))
    context = contexts_of(rank, starts, end_rank)
    context_count = contexts_of(count, starts, end_count)
    log_p = p_word + np.log10(1 - np.where(context_count > 0, np.array(model.weights)[_bucket(context_count)], 0.0))
    known = np.flatnonzero((rank >= 0) & (context >= 0))
    c, w = context[known].astype(np.uint64), rank[known].astype(np.uint64)
    order, new = pair_order(c, w, model.vocabulary)
    at = order[new]
    found = find_pairs(model, c[at], w[at])[np.cumsum(new) - 1] if len(at) else np.zeros(0, np.int64)
    log_p[known[order[found >= 0]]] = -found[found >= 0] / STEPS
    return {
        "n_tokens": np.diff(np.append(starts, len(tokens))), "n_known": np.add.reduceat((count > 0).astype(np.int64), starts),
        "base_score": np.add.reduceat(p_word, starts), "score": np.add.reduceat(log_p, starts),
    }


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` for every row
    (and the columns ``keep`` names)."""
    bounded_batches(docs.sparkSession)
    keep = keep or {}
    rows = docs.select(
        F.col(text_col).cast("string").cast("binary").alias("_text"), F.col(id_col).alias("id"), *[c.alias(n) for n, c in keep.items()]
    )
    kept = rows.select("id", *keep).schema
    fields = "n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                s = score_texts(model, batch.column(0).to_pylist())
                s = {"n_tokens": s["n_tokens"], "n_known": s["n_known"], "train_tokens": np.full(batch.num_rows, model.tokens), **s}
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], *map(pa.array, s.values())], names=[*batch.schema.names[1:], *s]
                )

    return rows.mapInArrow(score, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", " + fields)
