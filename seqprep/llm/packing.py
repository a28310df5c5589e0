"""Packing token sequences by Karmarkar-Karp multiway differencing.

Each document's ids are cut into full windows, and the rest into items of at
most ``ITEM`` tokens. The items of a group of documents are dealt to ``k``
windows: every item starts as a partial partition of its own; the two with the
largest differences are merged, the full windows of one onto the empty windows
of the other, until one partition is left with near-equal windows. ``k``
starts at the fewest windows that could hold the tokens and rises whenever a
window exceeds the capacity.

A group is ``GROUP`` consecutive documents of one partition, or fewer once they
hold ``GROUP_TOKENS`` ids, so memory is bounded by a group and the longest text,
nothing is shuffled, and padding is under one window per group.

Defined results: a null or empty text is packed as its end id alone; repeated
rows are packed once each; rows with null ids are packed too; an empty table
gives an empty result; extra columns are ignored. Sequence ids are unique;
they number the sequences inside each partition of the input.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.llm.common import bounded_batches
from seqprep.llm.encoding import KEPT_PIECES

ITEM = 256
GROUP = 512
GROUP_TOKENS = 1 << 21
BATCH_BYTES = 8 << 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _merge(a: list, b: list, k: int) -> list:
    """Lay partial partition ``b`` on ``a`` with opposing imbalances. Both list
    their non-empty windows ``(sum, items)`` in descending order."""
    free = k - len(b)  # the fullest windows of a meet the empty ones of b
    light = b[::-1]  # then the next fullest the lightest of b, and so on
    rest = a[free:]
    out = a[:free] + [(x[0] + y[0], (x[1], y[1])) for x, y in zip(rest, light)] + light[len(rest) :]
    out.sort(key=lambda w: -w[0])
    return out


def difference(sizes: list[int], k: int) -> list[tuple[int, list[int]]]:
    """``k`` windows (sum, item numbers) with near-equal sums."""

    def entry(windows):
        spread = windows[0][0] - (windows[-1][0] if len(windows) == k else 0)
        return (-spread, next(count), windows)

    count = iter(range(1 << 62))
    heap = [entry([(s, i)]) for i, s in sorted(enumerate(sizes), key=lambda x: -x[1])]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        heapq.heappush(heap, entry(_merge(a, b, k)))
    windows = []
    for total, tree in heap[0][2] if heap else []:
        items, todo = [], [tree]
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo.extend(node)
            else:
                items.append(node)
        windows.append((total, sorted(items)))
    return windows


def pack_items(sizes: list[int], capacity: int) -> list[list[int]]:
    """Item numbers of each window; no window holds more than ``capacity``."""
    k = -(-sum(sizes) // capacity)
    while sizes:
        windows = difference(sizes, k)
        over = max(total for total, _ in windows) - capacity
        if over <= 0:
            return [items for _, items in windows]
        k += max(1, k * over // (8 * capacity))
    return []


def _pieces(lengths: list[int], capacity: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` for a group of documents."""
    sequence, items = 0, []
    for d, n in enumerate(lengths):
        full = n - n % capacity
        for start in range(0, full, capacity):
            yield d, start, capacity, sequence, 0
            sequence += 1
        items += [(d, start, min(ITEM, n - start)) for start in range(full, n, ITEM)]
    for window in pack_items([x[2] for x in items], capacity):
        offset, at = 0, 0
        while at < len(window):
            d, start, length = items[window[at]]
            # neighbouring items of a document become one piece again
            while at + 1 < len(window) and items[window[at + 1]][:2] == (d, start + length):
                at += 1
                length += items[window[at]][2]
            yield d, start, length, sequence, offset
            offset += length
            at += 1
        sequence += 1


def _packer(tokenizer_path: str, end_id: int, capacity: int, with_ids: bool, kept_pieces: int = KEPT_PIECES):
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def pack(batches):
        from seqprep.llm.encoding import encoder

        enc, end = encoder(tokenizer_path, kept_pieces), np.array([end_id], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 32
        ids, coded, held = [], [], 0

        def flush():
            nonlocal base, held
            rows = list(_pieces([len(raw) // 4 for raw in coded], capacity))
            last = max((r[3] for r in rows), default=-1)
            d, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*rows))
            parts = [coded[a][4 * b : 4 * (b + c)] for a, b, c, _, _ in rows]
            columns = [
                pa.array([ids[i] for i in d.tolist()], pa.int64()), start, length,
                [zlib.crc32(p) for p in parts], [len(coded[i]) // 4 for i in d.tolist()], sequence + base, offset,
            ]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            if with_ids:
                ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), values))
            base += last + 1
            ids.clear()
            coded.clear()
            held = 0
            return pa.RecordBatch.from_arrays(arrays, names=names + ["ids"] * with_ids)

        for batch in batches:
            flat, sizes = enc.encode(batch.column(1))
            for doc, n, to in zip(batch.column(0).to_pylist(), sizes.tolist(), np.cumsum(sizes).tolist()):
                ids.append(doc)
                coded.append(flat[to - n : to].tobytes() + end)
                held += n + 1
                if len(coded) == GROUP or held >= GROUP_TOKENS:
                    yield flush()
        if coded:
            yield flush()

    return pack


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 1024, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES, kept_pieces: int = KEPT_PIECES,
) -> DataFrame:
    """One row per piece: its document, place in the document, sequence and
    offset there (and its ids). Every id of every document is in one piece.

    Smaller ``batch_bytes`` and ``kept_pieces`` (encoded pieces that a worker
    remembers) take less memory and more time; the rows are the same."""
    # cutting a text takes many times its bytes in a worker, so runs of long texts go in small batches
    bounded_batches(docs.sparkSession, size=batch_bytes)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        _packer(tokenizer_path, end_id, capacity, with_ids, kept_pieces), SCHEMA + (", ids array<int>" if with_ids else "")
    )
