"""Quality classifier: a linear-chain conditional random field over lines.

Every line is labelled good or bad from features of the line and of its two
neighbours (each cut into bins) and from the labels beside it. Forward and
backward passes give each line's marginal, and a document's quality is their
mean weighted by line length. Labels exist for documents only, so in training
every line carries its document's label.

The field is fitted by gradient ascent on the exact likelihood of at most
``FIT_DOCUMENTS`` labelled documents, those with the smallest hash of their
identifier (a bounded sample; scoring covers all rows). Only texts enter a
score.

Defined results: a null or empty text is one empty line, weighed as length one;
rows whose label is null are not learnt from; repeated rows score alike;
without labelled rows, or with one class only, the score is that class's share
(0.5 without any), and ``drop_low_quality`` keeps all rows, since nothing was
learnt that tells them apart; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.llm.common import bounded_batches

# Labelled documents that the fit uses at most.
FIT_DOCUMENTS = 6_000
BINS = 8
ROUNDS = 200
RATE = 0.1
RIDGE = 1e-3
# Bytes of text that are turned into features at a time; that takes many times as much.
CHUNK = 1 << 20
BATCH_BYTES = 1 << 20

FEATURES = ("length", "words", "word_length", "upper", "digits", "space", "marks", "symbols", "wide", "distinct", "repeated", "ending")


def _classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)  # 0: lower case
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[9, 10, 11, 12, 13, 32]] = 3
    table[[ord(c) for c in ".,;:'\"-?()"]] = 4
    table[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 5
    table[128:] = 6
    table[[*range(9), *range(14, 32), 127]] = 7
    return table


_CLASS = _classes()


def line_features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features per line, line lengths in bytes, and each text's first line."""
    lines, starts, repeated = [], [], []
    for text in texts:
        own = (text or b"").split(b"\n")
        starts.append(len(lines))
        lines += own
        seen = Counter(own)
        repeated += [seen[x] > 1 for x in own] if len(seen) < len(own) else [False] * len(own)
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    raw = np.frombuffer(b"".join(lines), np.uint8)
    counts = np.bincount(np.repeat(np.arange(len(lines)) * 8, length) + _CLASS[raw], minlength=8 * len(lines)).reshape(-1, 8)
    words = [x.split() for x in lines]
    n_words = np.fromiter(map(len, words), np.int64, len(lines))
    distinct = np.fromiter((len(set(w)) for w in words), np.int64, len(lines))
    ending = np.fromiter((x[-1:] in (b".", b"?", b'"', b")") for x in lines), bool, len(lines))
    size, some = np.maximum(length, 1), np.maximum(n_words, 1)
    inked = np.maximum(length - counts[:, 3], 1)
    table = np.stack([
        np.log1p(length), np.log1p(n_words), inked / some, counts[:, 1] / inked, counts[:, 2] / inked, counts[:, 3] / size,
        counts[:, 4] / some, (counts[:, 5] + counts[:, 7]) / inked, counts[:, 6] / inked, distinct / some, np.array(repeated, bool), ending,
    ], axis=1).astype(np.float32)
    return table, length, np.array(starts, np.int64)


@dataclass(frozen=True)
class Field:
    """A fitted field: bin edges per feature, log-odds per neighbour, feature
    and bin, and the transition scores (rows: label of the line before)."""

    edges: tuple[np.ndarray, ...]
    odds: np.ndarray  # (3 neighbours, features, BINS + 1); the last bin: no such line
    bias: float
    moves: np.ndarray  # (2, 2)
    fitted: bool = True  # on both classes


def _codes(edges: tuple[np.ndarray, ...], table: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, table[:, f], "right") for f, e in enumerate(edges)], axis=1)


def _around(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Codes of the line before, the line and the line after: (lines, 3, features)."""
    out = np.full((len(codes), 3, codes.shape[1]), BINS, np.int64)
    out[:, 1] = codes
    out[1:, 0] = codes[:-1]
    out[:-1, 2] = codes[1:]
    ends = np.append(starts[1:], len(codes)) - 1
    out[starts, 0] = BINS
    out[ends, 2] = BINS
    return out


def _cells(around: np.ndarray) -> np.ndarray:
    """Flat places in ``Field.odds`` of every line's features."""
    n = around.shape[2]
    base = (np.arange(3)[:, None] * n + np.arange(n)) * (BINS + 1)
    return (around + base).reshape(len(around), -1)


def _passes(unary: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward beliefs (own line included) and backward messages as log-odds of
    good, for chains that begin at ``starts``; one step serves all chains."""
    ends = np.append(starts[1:], len(unary))
    order = np.argsort(starts - ends, kind="stable")
    first, size = starts[order], (ends - starts)[order]
    longest = int(size[0]) if len(size) else 0
    alive = len(size) - np.searchsorted(size[::-1], np.arange(longest), "right")
    forward, backward = unary.copy(), np.zeros(len(unary))
    for t in range(1, longest):
        at = first[: alive[t]] + t
        x = forward[at - 1]
        forward[at] += np.logaddexp(x + moves[1, 1], moves[0, 1]) - np.logaddexp(x + moves[1, 0], moves[0, 0])
    last = ends[order] - 1
    for t in range(1, longest):
        at = last[: alive[t]] - t
        x = unary[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(x + moves[1, 1], moves[1, 0]) - np.logaddexp(x + moves[0, 1], moves[0, 0])
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_field(table: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> Field:
    """Maximise the field's likelihood with Adam; ``labels`` is 0 or 1 per text."""
    edges = tuple(np.unique(np.quantile(table[:, f], np.arange(1, BINS) / BINS)) for f in range(table.shape[1]))
    cells = _cells(_around(_codes(edges, table), starts))
    n_cells = 3 * table.shape[1] * (BINS + 1)
    sizes = np.diff(np.append(starts, len(table)))
    y = np.repeat(labels, sizes)
    inner = np.ones(len(table), bool)
    inner[np.cumsum(sizes) - 1] = False
    left = np.flatnonzero(inner)
    seen_moves = np.bincount(2 * y[left] + y[left + 1], minlength=4).reshape(2, 2)
    theta = np.zeros(n_cells + 5)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        odds, bias, moves = theta[:n_cells], theta[n_cells], theta[n_cells + 1 :].reshape(2, 2)
        unary = odds[cells].sum(axis=1) + bias
        forward, backward = _passes(unary, starts, moves)
        error = y - _sigmoid(forward + backward)
        after = unary[left + 1] + backward[left + 1]
        scores = np.stack([np.zeros(len(left)) + moves[0, 0], moves[0, 1] + after, forward[left] + moves[1, 0], forward[left] + moves[1, 1] + after])
        scores = np.exp(scores - scores.max(axis=0)) if len(left) else scores
        expected = (scores / scores.sum(axis=0)).sum(axis=1).reshape(2, 2) if len(left) else np.zeros((2, 2))
        gradient = np.concatenate((
            np.bincount(cells.reshape(-1), weights=np.repeat(error, cells.shape[1]), minlength=n_cells),
            [error.sum()], (seen_moves - expected).reshape(-1),
        )) / len(table) - RIDGE * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(edges, theta[:n_cells], float(theta[n_cells]), theta[n_cells + 1 :].reshape(2, 2))


def constant_field(share: float) -> Field:
    """The field of a sample with one class (or no rows): every line alike."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Field(tuple(np.zeros(0) for _ in FEATURES), np.zeros(3 * len(FEATURES) * (BINS + 1)), float(np.log(share / (1 - share))), np.zeros((2, 2)), fitted=False)


def line_marginals(field: Field, table: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Probability of good for every line."""
    unary = field.odds[_cells(_around(_codes(field.edges, table), starts))].sum(axis=1) + field.bias
    forward, backward = _passes(unary, starts, field.moves)
    return _sigmoid(forward + backward)


def score_texts(field: Field, texts: list[bytes | None]) -> np.ndarray:
    """Length-weighted mean marginal of each text."""
    out, at = [], 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size < CHUNK):
            size += len(texts[to] or b"")
            to += 1
        table, length, starts = line_features(texts[at:to])
        weight = np.maximum(length, 1).astype(float)
        good = line_marginals(field, table, starts)
        out.append(np.add.reduceat(weight * good, starts) / np.add.reduceat(weight, starts))
        at = to
    return np.concatenate(out) if out else np.zeros(0)


def fit_quality(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, limit: int = FIT_DOCUMENTS,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Field:
    """Fit the field on the labelled documents that ``learn`` (a condition on
    the labels table) admits, at most ``limit`` of them."""
    bounded_batches(docs.sparkSession, size=BATCH_BYTES)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known if learn is None else known.filter(learn)
    # one label per document: rows that repeat an id must not depend on order
    picked = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("y"))
    picked = picked.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").cast("binary").alias("text")).join(
        F.broadcast(picked), "_id"
    ).select("_id", "text", "y").dropDuplicates(["_id"])

    def features(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                table, _, _ = line_features([batch.column(1)[i].as_py()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([table.tobytes()], pa.binary()), batch.column(2).slice(i, 1)], names=["id", "lines", "y"]
                )

    kind = texts.schema["_id"].dataType.simpleString()
    rows = texts.mapInArrow(features, f"id {kind}, lines binary, y int").orderBy("id").collect()
    y = np.array([r["y"] for r in rows], np.int64)
    if len(np.unique(y)) < 2:
        return constant_field(float(y.mean()) if len(y) else 0.5)
    tables = [np.frombuffer(r["lines"], np.float32).reshape(-1, len(FEATURES)) for r in rows]
    starts = np.cumsum([0] + [len(t) for t in tables[:-1]])
    return fit_field(np.concatenate(tables), starts, y)


def score_quality(docs: DataFrame, field: Field, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the quality of each text in ``out``."""
    bounded_batches(docs.sparkSession, size=BATCH_BYTES)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        return pd.Series(score_texts(field, list(texts)), index=texts.index, dtype="float64")

    return docs.withColumn(out, score(F.col(text_col).cast("string").cast("binary")))


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, threshold: float = 0.7, **columns: str
) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns;
    all of them when the labels that join ``docs`` are not of both classes."""
    field = fit_quality(docs, labels, learn, **columns)
    if not field.fitted:
        return docs
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    text_col = columns.get("text_col", "text")
    scored = score_quality(row.select("doc", F.col(f"doc.`{text_col}`").alias("text")), field)
    return scored.filter(F.col("score") >= threshold).select("doc.*")
