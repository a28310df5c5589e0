"""Periodic runs of words: stretches that repeat a block of words.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
the same) and at least ``max(LEAST, TIMES * q)`` words, ``TIMES`` = 4, that no
word beside it extends keeping the period.

* **Tiles.** Periods are taken by octaves ``[s/2, s)``, ``s = 2, 4, 8, ...``.
  For each octave a document is covered by overlapping tiles of ``3 s`` words
  around boundaries ``c`` that are ``s`` words apart: ``[c - s, c + 2s)``.
* **Tiles alone.** In a tile, Z-functions from the boundary give, for every
  period ``q`` of the octave, how far the words from ``c`` and from ``c + q``
  agree, forwards and backwards; where both together reach ``q``, the stretch
  they cover is a fragment of period ``q``, cut at the tile's edges. A run
  agrees over at least ``q >= s/2`` words before or after every boundary in
  it, so only tiles where a block of ``s/2`` words beside the boundary meets
  its like (64-bit block hashes, doubled from octave to octave) are solved.
* **Stitching.** Neighbouring fragments of a run overlap by at least ``q``.
  Fragments are shuffled by document and period, sorted by start and joined
  where they overlap so; a stretch found under several periods keeps the
  smallest. Only fragments are shuffled, after joining those of one task.

A document of up to ``SPAN`` words is tiled and solved in the task that reads
it. A longer one is first exploded into pieces per octave, each covered by
whole tiles, that are dealt out to all tasks.

Defined results: a null or empty text has no words and no runs; rows are told
apart by place, so repeated ids and rows keep their own runs; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqprep.llm.common import as_scan, bounded_batches, n_words, partitions_for, with_locator
from seqprep.plans.state import materialize

LEAST, TIMES = 6, 4
SPAN = 1 << 14
FRAGMENT = "_file string, _row long, period long, start long, end long"
_ODD = np.uint64(0x9E3779B97F4A7C15)  # a fixed odd multiplier


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


def z_function(s: list) -> list[int]:
    """``z[i]``: how many items from ``i`` on agree with the beginning."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    if n:
        z[0] = n
    return z


def tile_fragments(words: np.ndarray, low: int, high: int, c: int, s: int):
    """Fragments ``(period, start, end)`` of the tile around boundary ``c`` in
    ``words[low:high]``, for the periods ``s/2 .. s-1``."""
    a, b = max(low, c - s), min(high, c + 2 * s)
    ahead = words[c:b].tolist()
    # before[i] is the word i + 1 places before c + s; the stretch that ends at c begins at s
    top = min(high, c + s)
    before = words[a:top][::-1].tolist()
    short = c + s - top
    forward = z_function(ahead)
    pattern = before[s - short :]
    backward = z_function([*pattern, -1, *before])
    for q in range(s // 2, s):
        if c + q > high:
            break
        f = forward[q] if c + q < b else 0
        g = min(backward[len(pattern) + 1 + s - q - short], len(pattern))
        if f + g >= q:
            yield q, c - g, c + q + f


def _candidates(hashes: np.ndarray, half: int) -> np.ndarray:
    """Boundaries (multiples of ``2 * half``) beside which a block of ``half``
    words meets its like ``half .. 2 * half - 1`` words on."""
    rows = len(hashes) // half
    grid = hashes[: rows * half].reshape(rows, half)
    met = np.zeros(rows + 2, bool)
    met[: max(rows - 1, 0)] = (grid[1:] == grid[:-1, :1]).any(axis=1)
    # the last whole row may meet a block in the rest behind it
    if rows:
        met[rows - 1] = (hashes[rows * half :] == grid[-1, 0]).any()
    here = met[: rows + 1 : 2] | np.concatenate(([False], met[1 : rows + 1 : 2]))[: len(met[: rows + 1 : 2])]
    return np.flatnonzero(here) * 2 * half


def solve(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> dict:
    """Fragments per piece ``(piece, period) -> [[start, end], ...]`` in its own
    word numbers; ``words`` holds all pieces with a word of its own between them,
    piece ``i`` at ``starts[i]:ends[i]``, to be solved for the octaves
    ``first[i] .. last[i]`` (octave ``k`` has the periods ``2**k .. 2**(k+1) - 1``)."""
    found: dict = {}
    hashes = _mixed(words.astype(np.uint64) * _ODD + np.uint64(1))
    for octave in range(int(last.max(initial=-1)) + 1):
        half, s = 1 << octave, 2 << octave
        cuts = _candidates(hashes, half)
        owner = np.searchsorted(starts, cuts, "right") - 1
        # a boundary on the gap between two pieces has no tile
        solved = (cuts < ends[owner]) & (first[owner] <= octave) & (octave <= last[owner])
        for c, i in zip(cuts[solved].tolist(), owner[solved].tolist()):
            low = int(starts[i])
            for q, a, b in tile_fragments(words, low, int(ends[i]), c, s):
                spans = found.setdefault((i, q), [])
                if spans and a - low + q <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], b - low)
                else:
                    spans.append([a - low, b - low])
        if len(hashes) <= half:
            break
        hashes = _mixed(hashes[:-half] * _ODD + hashes[half:])
    return found


def _octaves(n: int) -> int:
    """The highest octave whose least period can repeat ``TIMES`` times in ``n`` words; -1: none."""
    return (n // TIMES).bit_length() - 1


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts in a row, and each text's number of words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, offsets = lists.flatten(), lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    # white space at an edge leaves an empty string there
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    sizes = np.diff(np.concatenate(([0], np.cumsum(real)))[offsets])
    codes = words.filter(pa.array(real)).dictionary_encode().indices.to_numpy()
    return codes.astype(np.int64), sizes


def _solve_batches(batches):
    """Rows ``_file, _row, text, base, first, last`` to fragments."""
    for batch in batches:
        file, row, text, base, first, last = batch.columns
        codes, sizes = split_words(text)
        base, first = base.to_numpy(), first.to_numpy()
        last = np.minimum(last.to_numpy(), [_octaves(int(n)) for n in sizes])
        starts = np.cumsum(sizes + 1) - sizes - 1
        words = np.empty(len(codes) + len(sizes), np.int64)
        gaps = starts + sizes
        inside = np.ones(len(words), bool)
        inside[gaps] = False
        words[inside] = codes
        words[gaps] = -2 - np.arange(len(sizes))  # each gap a word of its own
        found = solve(words, starts, starts + sizes, first, last)
        rows = [(i, q, base[i] + a, base[i] + b) for (i, q), spans in found.items() for a, b in spans]
        at, period, start, end = (np.array(x, np.int64) for x in (zip(*rows) if rows else ((),) * 4))
        at = pa.array(at)
        yield pa.RecordBatch.from_arrays(
            [file.take(at), row.take(at), pa.array(period), pa.array(start), pa.array(end)],
            names=["_file", "_row", "period", "start", "end"],
        )


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _pieces(n: int, span: int):
    """Pieces ``(first word, end, first octave, last octave)`` of a long
    document: low octaves share pieces of ``span`` words, a higher octave has
    pieces of its own, eight tiles long. Pieces overlap by two tiles, more than
    ``TIMES`` periods, so every such stretch lies whole in one of them."""
    top = _octaves(n)
    low = max(min(top, (span // 16).bit_length() - 1), 0)
    bands = [(0, low, span, 8 << low)] + [(k, k, 32 << k, 8 << k) for k in range(low + 1, top + 1)]
    for first, last, length, overlap in bands:
        a = 0
        while True:
            yield a, min(a + length, n), first, last
            if a + length >= n:
                break
            a += length - overlap


def _explode_batches(span: int):
    def batches(rows):
        for batch in rows:
            for file, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py()
                at = np.array([m.span() for m in _WORD.finditer(text)], np.int64)
                for a, b, first, last in _pieces(len(at), span):
                    yield pa.RecordBatch.from_pydict({
                        "_file": pa.array([file]), "_row": pa.array([row], pa.int64()), "text": pa.array([text[at[a, 0] : at[b - 1, 1]]]),
                        "base": pa.array([a], pa.int64()), "first": pa.array([first], pa.int32()), "last": pa.array([last], pa.int32())})

    return batches


PIECE = "_file string, _row long, text string, base long, first int, last int"


def period_fragments(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """Fragments of every row of ``_file, _row, text``."""
    # a word and the space before the next take two bytes at least
    long = (F.octet_length("text") > 2 * span) & (n_words(F.col("text")) > span)
    here = rows.filter(~long).select(
        "_file", "_row", "text", F.lit(0).cast("long").alias("base"), F.lit(0).alias("first"), F.lit(62).alias("last")
    )
    pieces = rows.filter(long).mapInArrow(_explode_batches(span), PIECE)
    dealt = pieces.repartition(partitions_for(rows), "_file", "_row", "first", "base")
    return here.mapInArrow(_solve_batches, FRAGMENT).unionByName(dealt.mapInArrow(_solve_batches, FRAGMENT))


def stitched_runs(fragments: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``_file, _row, start, period, length`` of every run."""
    key = Window.partitionBy("_file", "_row", "period").orderBy("start", "end")
    before = F.max("end").over(key.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (before.isNull() | (F.col("start") + F.col("period") > before)).cast("long")
    numbered = fragments.withColumn("_new", fresh).withColumn("_no", F.sum("_new").over(key.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("_file", "_row", "period", "_no").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    enough = whole.filter(length >= F.greatest(F.lit(least), times * F.col("period")))
    # a stretch with a smaller period has it as its whole length
    return enough.groupBy("_file", "_row", "start", "end").agg(F.min("period").alias("period")).select(
        "_file", "_row", "start", "period", (F.col("end") - F.col("start")).alias("length")
    )


def _collapse_batches(batches):
    for batch in batches:
        texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "").to_pylist()
        runs, out = batch.column(2).to_pylist(), []
        for text, found in zip(texts, runs):
            # white space of the contract is what bytes are split at
            words = text.encode().split()
            if found:
                change = np.zeros(len(words) + 1, np.int64)
                for r in found:
                    change[r["start"] + r["period"]] += 1
                    change[r["start"] + r["length"]] -= 1
                words = [w for w, inside in zip(words, np.cumsum(change)) if not inside]
            out.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(out, pa.binary()).cast(pa.string())], names=["id", "runs", "collapsed"]
        )


RUNS = "runs array<struct<start:long,period:long,length:long>>"


def collapse_runs(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, runs`` (sorted by start, then period) and the ``collapsed`` text:
    the words that no run holds after its first period, joined by one space.
    The run lists are measured and broadcast only when small; a larger table is
    joined by place, which shuffles the texts once."""
    bounded_batches(docs.sparkSession)
    scan = as_scan(docs)
    rows = with_locator(scan, [F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")])
    runs = stitched_runs(period_fragments(rows.select("_file", "_row", "text"), span))
    lists = runs.groupBy("_file", "_row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    joined = rows.join(materialize(lists).side(), ["_file", "_row"], "left").select("id", "text", "runs")
    done = joined.mapInArrow(_collapse_batches, f"id long, {RUNS}, collapsed string")
    return done.withColumn("runs", F.coalesce("runs", F.expr("array()").cast(RUNS.removeprefix("runs "))))
