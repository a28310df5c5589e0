"""Fill-in-the-middle transformation of documents at line boundaries.

A text's units are its lines. The UTF-8 bytes of a text are cut into blocks of
``BLOCK`` bytes; a Fenwick tree over the blocks stores how many lines end in
them and how many code points begin in them. A cut after ``k`` lines is found
by binary-lifting descent through the tree, which gives the block that holds
the cut and the code points before it, and then by looking for the line end
inside that one block. Texts are never split into lists of lines.

Draws depend on the seed and the document's id only, so a rerun or a lost task
gives the same cuts. Nothing is shuffled.

Defined results: a null or empty text is ``plain`` (0 units, empty output); so
is a text that holds one of the marks, so ``restored`` always gives the exact
text back; a null id draws like an empty one; rows that repeat an id draw the
same numbers, each on its own text; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.llm.common import bounded_batches

# Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 1024
FEED = 10


def _fenwick(counts: np.ndarray) -> np.ndarray:
    """Tree of 1-based nodes; node ``i`` sums the ``i & -i`` blocks that end at ``i``."""
    at = np.arange(len(counts) + 1)
    sums = np.concatenate(([0], np.cumsum(counts)))
    return sums - sums[at - (at & -at)]


def _descend(units: np.ndarray, chars: np.ndarray, wanted: int) -> tuple[int, int, int]:
    """The block in which unit number ``wanted`` (from 1) ends, and the units
    and code points before that block."""
    node, ended, points = 0, 0, 0
    step = 1 << ((len(units) - 1).bit_length() - 1)
    while step:
        ahead = node + step
        if ahead < len(units) and ended + units[ahead] < wanted:
            node, ended, points = ahead, ended + int(units[ahead]), points + int(chars[ahead])
        step >>= 1
    return node, ended, points


class LineIndex:
    """Finds the ends of a text's lines by number."""

    def __init__(self, raw: np.ndarray, block: int = BLOCK):
        self.raw, self.block = raw, block
        starts = np.arange(0, len(raw), block)
        # unsigned bytes of the form 10xxxxxx continue a code point
        self.feeds = np.add.reduceat(raw == FEED, starts, dtype=np.int64) if len(raw) else np.zeros(0, np.int64)
        points = np.add.reduceat((raw & 0xC0) != 0x80, starts, dtype=np.int64) if len(raw) else np.zeros(0, np.int64)
        self.units, self.chars = _fenwick(self.feeds), _fenwick(points)
        self.n_feeds, self.n_chars = int(self.feeds.sum()), int(points.sum())
        # an unended last line is a unit too
        self.n = self.n_feeds + int(len(raw) > 0 and raw[-1] != FEED)

    def after(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first ``k`` units."""
        if k <= 0:
            return 0, 0
        if k > self.n_feeds:
            return len(self.raw), self.n_chars
        node, ended, points = _descend(self.units, self.chars, k)
        start = node * self.block
        inside = self.raw[start : start + self.block]
        cut = int(np.flatnonzero(inside == FEED)[k - ended - 1]) + 1
        return start + cut, points + int(np.count_nonzero((inside[:cut] & 0xC0) != 0x80))


def _draws(seed: int, doc_id) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _transform(seed: int, rate: int, spm_rate: int, block: int):
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))

    def one(doc_id, text: bytes) -> tuple:
        index = LineIndex(np.frombuffer(text, np.uint8), block)
        h1, h2, h3, h4 = _draws(seed, doc_id)
        if not text or p in text or s in text or m in text or h3 % 100 >= rate:
            return index.n, "plain", None, None, text
        first, second = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
        (a, a_chars), (b, b_chars) = index.after(first), index.after(second)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm_rate:
            return index.n, "spm", a_chars, b_chars - a_chars, b"".join((s, suffix, p, prefix, m, middle))
        return index.n, "psm", a_chars, b_chars - a_chars, b"".join((p, prefix, s, suffix, m, middle))

    def batches(rows):
        for batch in rows:
            texts = batch.column(1).cast(pa.large_binary())
            done = [one(i, t.as_buffer().to_pybytes() if t.is_valid else b"") for i, t in zip(batch.column(0).to_pylist(), texts)]
            n, form, prefix, middle, output = zip(*done) if done else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return batches


def fill_in_middle(
    docs: DataFrame, seed: int, rate: int = 100, spm_rate: int = 50, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n`` (units), ``form`` (plain, psm or spm), ``prefix_chars,
    middle_chars`` and the ``output`` text. ``rate`` percent of the texts are
    rearranged, ``spm_rate`` percent of those with the suffix first."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(_transform(seed, rate, spm_rate, block), schema)


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from an output and its form. No part holds a mark and a
    mark cannot begin inside another, so the first one found is the right one."""

    def between(left: str, right: str) -> Column:
        start = F.instr(output, left) + len(left)
        return F.substring(output, start, F.instr(output, right) - start)

    def after(left: str) -> Column:
        return F.substring(output, F.instr(output, left) + len(left), F.length(output))

    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
