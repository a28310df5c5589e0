"""Removal of long repeated byte strings from documents, by sorted suffixes.

Every byte that a string of ``length`` bytes covers which also starts anywhere
else in the corpus goes, with the first occurrence. Suffixes are sorted shard by
shard (``induce``); the work is dealt out so that equal strings meet:

1. **Anchors.** In the string of ``length`` bytes at a start, the place of the
   ``GRAM``-byte substring with the least hash (the last of equal ones) is the
   start's anchor. It depends on the string alone, so equal strings have anchors
   with equal substrings ("grams"). The starts of one anchor are neighbours:
   ``a .. b``; the bytes ``a .. b + length`` are the anchor's region. One row
   per anchor -- one in some 180 bytes -- is written.
2. **Grams that occur once** hold no repeats and are dropped. Regions of one gram
   with equal bytes are counted as copies of one, so a group of thousands of
   copies is one region with a number before any text is shuffled; where a gram
   has no other region, there is nothing to sort.
3. **Shards.** The texts of the different regions are dealt out by gram and each
   partition is one shard, its regions set apart by a byte that no text has.
   Each corpus start is in one region, so a suffix whose neighbour in suffix
   order shares ``length`` bytes, or whose region has copies, starts elsewhere
   too. Runs of such starts come out.
4. **Hot grams**, with over ``HOT`` different regions, would make one shard of any
   size. Their regions are cut into pieces of starts at places counted from the
   anchor, of widths that fall from ``WIDTHS[0]`` to 1. Pieces are named by
   128-bit hashes and counted, with counts reduced before the shuffle: one with
   an equal elsewhere repeats as a whole; where only the bytes that all its
   strings share have one, it is divided; otherwise it holds no repeats.
5. **Removal.** Runs of starts go back to all regions with those bytes, are
   collected by document, and their bytes are taken out.

Defined results: a null or empty text keeps its 0 bytes; texts shorter than
``length`` keep all; rows are told apart by place, so rows that repeat a text or
an id are separate documents whose equal strings repeat; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.llm.common import as_scan, bounded_batches, few_parts, scratch_path, text_of, with_locator, written
from seqprep.llm.induce import MEMORY, repeated
from seqprep.llm.lm import mounted
from seqprep.plans.state import materialize

GRAM = 100
HOT = 512
SHARD = 4 << 20
CHUNK = 4 << 20
BATCH_BYTES = 1 << 20
GROUPED = 64 << 10  # bytes of short texts hashed together, so that their arrays stay in a core's cache
_ODD = np.uint64(0x9E3779B97F4A7C15)  # a fixed odd multiplier
_PLACE = np.uint64((1 << 24) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """``x``, mixed in place."""
    x ^= x >> np.uint64(31)
    x *= _ODD
    x ^= x >> np.uint64(29)
    return x


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of strings put together from two parts."""
    both = left * _ODD
    both += right
    return _mixed(both)


def window_hashes(raw: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """64-bit hashes of all substrings of ``size`` bytes, put together from those
    of doubling sizes."""
    part, width = _mixed((raw.astype(np.uint64) + np.uint64(seed)) * _ODD), 1
    whole, done = None, 0
    while True:
        if size & width:
            if whole is None:
                whole = part
            else:
                n = len(part) - done
                whole = _pair(whole[:n], part[done : done + n])
            done += width
        if width * 2 > size:
            return whole[: max(len(raw) - size + 1, 0)]
        part, width = _pair(part[:-width], part[width:]), width * 2


def _least(keys: np.ndarray, window: int) -> np.ndarray:
    """Least key of every window, by windows of doubling widths."""
    width = 1
    while width * 2 <= window:
        keys, width = np.minimum(keys[:-width], keys[width:]), width * 2
    rest = window - width
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def anchors(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """``document, first start, last start, gram hash, anchor`` of every region of
    the texts at ``starts:ends`` in ``raw`` (fewer than 2**24 bytes)."""
    if len(raw) < length:
        return (np.zeros(0, np.int64),) * 5
    hashes = window_hashes(raw, GRAM)
    keys = (hashes & ~_PLACE) | (_PLACE - np.arange(len(hashes), dtype=np.uint64))
    at = (_PLACE - (_least(keys, length - GRAM + 1) & _PLACE)).astype(np.int64)
    # starts whose string lies whole in one text
    change = np.zeros(len(at) + 1, np.int64)
    long = ends - starts >= length
    np.add.at(change, starts[long], 1)
    np.add.at(change, ends[long] - length + 1, -1)
    x = np.flatnonzero(np.cumsum(change[:-1]))
    if not len(x):
        return (np.zeros(0, np.int64),) * 5
    at = at[x]
    heads = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (x[1:] != x[:-1] + 1))))
    a, b = x[heads], x[np.append(heads[1:], len(x)) - 1]
    return np.searchsorted(starts, a, "right") - 1, a, b, hashes[at[heads]].view(np.int64), at[heads]


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and their bounds."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


def _chunks(bounds: np.ndarray, length: int):
    """Groups of texts of ``GROUPED`` bytes, or of one text: ``(first byte, end,
    starts, ends, first document)``; a text of over ``CHUNK`` bytes comes in chunks
    that share ``length - 1`` bytes."""
    i, n = 0, len(bounds) - 1
    while i < n:
        if bounds[i + 1] - bounds[i] > CHUNK:
            for a in range(int(bounds[i]), max(int(bounds[i + 1]) - length + 1, int(bounds[i]) + 1), CHUNK - length + 1):
                b = min(a + CHUNK, int(bounds[i + 1]))
                yield a, b, np.array([0]), np.array([b - a]), i
            i += 1
            continue
        j = max(int(np.searchsorted(bounds, bounds[i] + min(GROUPED, CHUNK), "right")) - 1, i + 1)
        yield int(bounds[i]), int(bounds[j]), bounds[i:j] - bounds[i], bounds[i + 1 : j + 1] - bounds[i], i
        i = j


def _anchor_batches(length: int):
    def batches(rows):
        for batch in rows:
            file, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raw, bounds = _texts(batch.column(2))
            digests, found = [], []
            for low, high, starts, ends, base in _chunks(bounds, length):
                part = raw[low:high]
                # empty texts share their start with the next text
                real = ends > starts
                which = np.flatnonzero(real) + base
                doc, a, b, gram, at = anchors(part, starts[real], ends[real], length)
                view = part.tobytes()
                digests += [xxhash.xxh64_intdigest(view[s : e + length]) for s, e in zip(a.tolist(), b.tolist())]
                doc = which[doc]
                shift = low - bounds[doc]
                found.append((gram, doc, a + shift, b + shift, at + shift))
            if found:
                gram, doc, a, b, at = map(np.concatenate, zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(file[doc]), pa.array(row[doc]),
                     pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(at.astype(np.int32))],
                    names=["gram", "digest", "file", "row", "a", "b", "at"],
                )

    return batches


OCCURRENCE = "gram long, digest long, file long, row long, a int, b int, at int"
REGION = "gram long, digest long, copies long, a int, b int, at int, text binary"
RUN = "gram long, digest long, first int, last int"


def _region_batches(length: int):
    """Documents with the list of their regions to rows with the regions' bytes."""
    def batches(rows):
        for batch in rows:
            for text, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
                text = text.as_buffer().to_pybytes()
                columns = {k: [w[k] for w in wanted] for k in ("gram", "digest", "copies", "a", "b", "at")}
                columns["text"] = [text[w["a"] : w["b"] + length] for w in wanted]
                yield pa.RecordBatch.from_pydict({
                    k: pa.array(v, pa.binary() if k == "text" else pa.int32() if k in ("a", "b", "at") else pa.int64())
                    for k, v in columns.items()
                })

    return batches


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true flags."""
    change = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1) - 1


def _covered(n: int, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    change = np.zeros(n + 1, np.int8)
    change[starts] += 1
    change[starts + sizes] -= 1
    return np.cumsum(change[:-1], dtype=np.int8) > 0


def _shard_batches(length: int, memory: int, folder: str):
    """The regions of a partition, sorted as one shard, to runs of repeated starts."""
    # texts hold no byte above 0xF4: 0 ends the shard, 1 ends a region
    def batches(rows):
        parts, grams, digests, copies, owned, sizes = [], [], [], [], [], []
        for batch in rows:
            raw, bounds = _texts(batch.column(6))
            if not len(batch):
                continue
            spread = np.ones(int(bounds[-1] - bounds[0]) + len(batch), np.uint8)
            gaps = bounds[1:] - bounds[0] + np.arange(len(batch))
            inside = np.ones(len(spread), bool)
            inside[gaps] = False
            spread[inside] = raw[bounds[0] : bounds[-1]] + np.uint8(2)
            parts.append(spread)
            grams.append(batch.column(0).to_numpy())
            digests.append(batch.column(1).to_numpy())
            copies.append(batch.column(2).to_numpy())
            owned.append(batch.column(4).to_numpy() - batch.column(3).to_numpy() + 1)
            sizes.append(np.diff(bounds) + 1)
        if not parts:
            return
        text = np.concatenate([*parts, np.zeros(1, np.uint8)])
        del parts
        gram, digest, copies, owned, sizes = (np.concatenate(x) for x in (grams, digests, copies, owned, sizes))
        starts = np.cumsum(sizes) - sizes
        marks = repeated(text, length, memory, lambda: mounted(folder))
        # strings from behind a region's own starts run into the next region; the
        # starts of a region that has copies are elsewhere too
        own, many = (_covered(len(text), starts[x], owned[x]) for x in (slice(None), copies > 1))
        first, last = _runs((marks & own) | many)
        at = np.searchsorted(starts, first, "right") - 1
        for a in range(0, len(first), 100_000):
            s = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[at[s]]), pa.array(digest[at[s]]), pa.array((first[s] - starts[at[s]]).astype(np.int32)),
                 pa.array((last[s] - starts[at[s]]).astype(np.int32))], names=["gram", "digest", "first", "last"])

    return batches


def _names(raw: np.ndarray, size: int) -> list[np.ndarray]:
    """128-bit names of all substrings of ``size`` bytes, as two columns."""
    return [window_hashes(raw, size, seed).view(np.int64) for seed in (1, 12345)]


def _name_batches(length: int, width: int, wider: int):
    """Regions to pieces of ``width`` starts, counted back from the anchor so that
    equal strings have equal places. ``core`` names the bytes that all strings of
    the piece share; ``span`` the bytes of all strings of the piece's own starts
    ``low .. high``. With a ``piece`` column (a wider piece that is left), only the
    pieces in it."""
    def batches(rows):
        for batch in rows:
            raw, bounds = _texts(batch.column(6))
            raw, bounds = raw[bounds[0] : bounds[-1]], bounds - bounds[0]
            cores = _names(raw, length - width + 1)
            gram, digest, copies, a, b, at = (batch.column(k).to_numpy().astype(np.int64) for k in range(6))
            first, last = (at - b) // width, (at - a) // width
            if batch.num_columns > 7:
                piece = batch.column(7).to_numpy() * (wider // width)
                first, last = np.maximum(first, piece), np.minimum(last, piece + wider // width - 1)
            # one row per piece; no region is without one
            many = np.maximum(last - first + 1, 0)
            i = np.repeat(np.arange(len(many)), many)
            number = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + first[i]
            low, high = np.maximum(number * width, (at - b)[i]), np.minimum(number * width + width - 1, (at - a)[i])
            # the core runs from the piece's last start to the end of its first string, inside the region
            place = (at - a)[i] + bounds[:-1][i]
            core = place - number * width
            spans = np.zeros((2, len(i)), np.int64)
            for n in np.unique(high - low):
                here = np.flatnonzero(high - low == n)
                for column, names in zip(spans, _names(raw, length + int(n))):
                    column[here] = names[(place - high)[here]]
            columns = [gram[i], digest[i], copies[i], number, low, high, cores[0][core], cores[1][core], *spans]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in NAMED.split(", ")])

    return batches


NAMED = "gram long, digest long, copies long, piece long, low long, high long, core1 long, core2 long, span1 long, span2 long"
WIDTHS = (64, 16, 4, 1)


def _hot_runs(regions: DataFrame, length: int) -> DataFrame:
    """Runs of repeated starts in the regions of hot grams. A piece whose span has
    an equal repeats as a whole; one of which only the core has is divided."""
    one = ["gram", "digest", "piece"]

    def equal(named: DataFrame, by: list[str]) -> DataFrame:
        """The pieces that have an equal, and the least digest among equals."""
        shared = named.groupBy(*by).agg(F.sum("copies").alias("_all"), F.min("digest").alias("_least")).filter("_all > 1")
        return named.join(shared.hint("merge"), by)

    left, found = regions, None
    for wider, width in zip((1, *WIDTHS), WIDTHS):
        named = written(left.mapInArrow(_name_batches(length, width, wider), NAMED), "hot-names")
        whole = equal(named, ["gram", "piece", "low", "high", "span1", "span2"]).select(*one, "low", "high", "_least")
        found = whole if found is None else found.unionByName(whole)
        if width > 1:
            # one of equal pieces stays to be compared with those that share its core only
            done = whole.filter("digest <> _least").select(*one)
            rest = equal(named, ["gram", "piece", "core1", "core2"]).select(*one).join(done.hint("merge"), one, "left_anti")
            left = regions.join(rest.hint("merge"), one[:2]).select(*regions.columns, "piece")
    # places count back from the anchor
    place = regions.select("gram", "digest", (F.col("at") - F.col("a")).alias("_at"))
    return found.join(place.hint("merge"), one[:2]).select(
        "gram", "digest", (F.col("_at") - F.col("high")).cast("int").alias("first"), (F.col("_at") - F.col("low")).cast("int").alias("last")
    )


def repeated_spans(rows: DataFrame, length: int = 400, hot: int = HOT, shard: int = SHARD, memory: int = MEMORY) -> DataFrame:
    """``file, row, starts``: sorted ``(first, last)`` runs of starts, of the rows
    ``file, row, text`` that hold any."""
    spark = rows.sparkSession
    if length <= GRAM + WIDTHS[0]:
        raise ValueError(f"length must be over {GRAM + WIDTHS[0]} bytes")
    texts = rows.select("file", "row", F.col("text").cast("binary").alias("text")).filter(F.octet_length("text") >= length)
    seen = written(few_parts(texts.mapInArrow(_anchor_batches(length), OCCURRENCE), rows), "anchors")
    # these sides grow with the corpus, so they are joined by shuffle at every size
    often = seen.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("gram")
    place = F.min(F.struct("file", "row", "a", "b", "at")).alias("place")
    counted = seen.join(often.hint("merge"), "gram").groupBy("gram", "digest").agg(F.count(F.lit(1)).alias("copies"), place)
    regions = written(few_parts(counted.select("gram", "digest", "copies", "place.*"), rows), "regions")
    kinds = written(regions.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")), "kinds")
    crowds = materialize(kinds.filter(F.col("kinds") > hot).select("gram"))
    # equal regions alone under a gram have nothing to be compared with: they repeat as they are
    single = regions.join(kinds.filter("kinds = 1").hint("merge"), "gram", "left_semi")
    regions = written(regions.join(kinds.filter("kinds > 1").hint("merge"), "gram", "left_semi"), "compared")
    alike = single.select("gram", "digest", F.lit(0).alias("first"), (F.col("b") - F.col("a")).alias("last"))
    wanted = regions.groupBy("file", "row").agg(F.collect_list(F.struct("gram", "digest", "copies", "a", "b", "at")).alias("wanted"))
    carried = texts.join(wanted.hint("merge"), ["file", "row"]).select("text", "wanted").mapInArrow(_region_batches(length), REGION)
    total = regions.agg(F.sum(F.col("b") - F.col("a") + length + 1)).first()[0] or 0
    parts = max(1, -(-total // shard))
    if crowds.rows:
        carried = written(few_parts(carried, rows), "region-texts")
        calm = carried.join(crowds.side(), "gram", "left_anti")
        crowded = _hot_runs(carried.join(crowds.side(), "gram", "left_semi"), length)
    else:
        calm, crowded = carried, None
    folder = os.path.dirname(scratch_path(spark, "sort"))
    runs = calm.repartition(parts, "gram").mapInArrow(_shard_batches(length, memory, folder), RUN)
    runs = runs.unionByName(alike).unionByName(crowded) if crowded is not None else runs.unionByName(alike)
    # one row a region, so that its copies are not multiplied by its runs
    by_region = written(runs.groupBy("gram", "digest").agg(F.collect_list(F.struct("first", "last")).alias("runs")), "runs")
    # copies of a region get its runs; all of them were dropped but one
    hits = seen.join(by_region.hint("merge"), ["gram", "digest"])
    moved = F.transform("runs", lambda r: F.struct((F.col("a") + r["first"]).alias("first"), (F.col("a") + r["last"]).alias("last")))
    return hits.select("file", "row", moved.alias("runs")).groupBy("file", "row").agg(
        F.sort_array(F.flatten(F.collect_list("runs"))).alias("starts"))


@dataclass
class _Removed:
    spans: list
    kept: bytes


def _remove(text: bytes, starts: list, length: int) -> _Removed:
    """The text without the bytes that the runs of starts cover, and their spans."""
    spans: list = []
    for run in starts:
        a, b = run["first"], run["last"] + length
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    edges = [0, *(x for s in spans for x in s), len(text)]
    return _Removed(spans, b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))


def _removal_batches(length: int):
    def batches(rows):
        for batch in rows:
            done = []
            for text, starts in zip(batch.column(1), batch.column(2).to_pylist()):
                done.append(_remove(text.as_buffer().to_pybytes(), starts or [], length))
            spans = [[{"start": a, "end": b} for a, b in d.spans] for d in done]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array([d.kept for d in done], pa.binary())], names=["id", "spans", "kept"])

    return batches


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id, n_bytes, spans`` (byte ranges taken out) and the ``kept`` bytes of
    every row."""
    bounded_batches(docs.sparkSession, size=BATCH_BYTES)
    scan = as_scan(docs)
    located = with_locator(scan, [F.col(id_col).cast("long").alias("id"), text_of(F.col(text_col)).alias("text")])
    # a 64-bit hash of the file's name and the row's number take less room than the name
    rows = located.select("id", F.xxhash64("_file").alias("file"), F.col("_row").alias("row"), "text")
    starts = repeated_spans(rows, length, **options)
    joined = rows.join(starts.hint("merge"), ["file", "row"], "left").select("id", F.col("text").cast("binary").alias("text"), "starts")
    cut = joined.mapInArrow(_removal_batches(length), "id long, spans array<struct<start:int,end:int>>, kept binary")
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    done = cut.select("id", (F.octet_length("kept").cast("long") + gone).alias("n_bytes"), gone.alias("n_removed"), "spans", "kept")
    return few_parts(done, rows)
