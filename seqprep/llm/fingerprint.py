"""Document fingerprints by randomised edit embedding.

A pointer walks over the characters of a text. At every step it emits what it
stands on and moves on or stays, by a random bit that all texts share for this
step and this character. Texts a few edits apart soon walk in step again, so
their edit distance becomes a Hamming distance between emitted strings.

A fingerprint is a bit sample of the emitted string. Level 0 takes each of the
first ``SAMPLES`` steps, level ``l`` one step from each of ``SAMPLES`` equal
stretches of the next ``SAMPLES * 2**(l-1)`` steps; a sample is one of 15
symbols hashed from the ``WINDOW`` characters ahead, or 0 past the end. Two
fingerprints of any lengths share their sampled steps, and ``likeness``, the
share of steps on which they agree (each sample weighs as many steps as it
stands for, chance agreement taken off), verifies candidates that bands of
sampled symbols bring together.

Defined results: a null text is empty, its fingerprint is the empty string,
like another empty one (1) and unlike all others (0); equal texts have equal
fingerprints; rows with equal ids are ordered by text, null ids come first;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.llm.common import bounded_batches, partitions_for, written
from seqprep.llm.components import connected_components

SAMPLES = 32
WINDOW = 4
SEED = 11
STRIDE = 256  # steps between the times that ended texts are taken out
CHUNK = 4 << 20  # characters that walk at a time
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


@lru_cache(maxsize=48)
def _moves(block: int) -> np.ndarray:
    """Random bits of ``STRIDE * 8`` steps for every character code; code 0,
    the end of a text, never moves."""
    bits = np.random.Generator(np.random.Philox(key=[SEED, block])).integers(0, 2, (STRIDE * 8, 256), dtype=np.int64)
    bits[:, 0] = 0
    return bits.astype(np.uint8)


@lru_cache(maxsize=64)
def _sampled(level: int) -> dict[int, int]:
    """Sampled steps of a level and their columns."""
    if level == 0:
        return {i: i for i in range(SAMPLES)}
    stretch = 1 << (level - 1)
    r = np.random.Generator(np.random.Philox(key=[SEED + 1, level])).integers(0, stretch, SAMPLES)
    return {SAMPLES * stretch + i * stretch + int(r[i]): level * SAMPLES + i for i in range(SAMPLES)}


def codes(text: str) -> np.ndarray:
    """Character codes 1 to 255: ASCII as it is, the rest hashed above it."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    high = 128 + ((points.astype(np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(12)) % np.uint64(128)
    return np.where((points > 0) & (points < 128), points, high).astype(np.uint8)


def walk(texts: list[str]) -> np.ndarray:
    """Sampled symbols, one row per text."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    gap = np.zeros(WINDOW, np.uint8)
    flat = np.concatenate([a for i in order for a in (codes(texts[i]), gap)]) if texts else gap
    size = np.array([len(texts[i]) for i in order], np.int64)
    place = np.concatenate(([0], np.cumsum(size + WINDOW)[:-1])) if texts else np.zeros(0, np.int64)
    rows = np.array(order, np.int64)
    levels = 2 + max(int(size.max(initial=1)) * 4 // SAMPLES, 1).bit_length()
    out = np.zeros((len(texts), levels * SAMPLES), np.uint8)
    schedule = {step: column for level in range(levels) for step, column in _sampled(level).items()}
    step = 0
    while True:
        going = flat[place] != 0
        if not going.all():
            place, rows = place[going], rows[going]
        if not len(place):
            return out
        bits = _moves(step // (STRIDE * 8))
        char, move = np.empty(len(place), np.uint8), np.empty(len(place), np.uint8)
        for s in range(step, step + STRIDE):
            np.take(flat, place, out=char)
            column = schedule.get(s)
            if column is not None:
                h = char.astype(np.uint32)
                for i in range(1, WINDOW):
                    h = h * np.uint32(0x01000193) ^ flat[place + np.where(char != 0, i, 0)]
                h = (h * np.uint32(0x9E3779B1)) >> np.uint32(16)
                out[rows, column] = np.where(char != 0, 1 + h % 15, 0)
            np.take(bits[s % (STRIDE * 8)], char, out=move)
            place += move
        step += STRIDE


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """Symbols of each text, up to its last level."""
    out, at = [], 0
    while at < len(texts):
        total, to = 0, at
        while to < len(texts) and (to == at or total < CHUNK):
            total += len(texts[to])
            to += 1
        symbols = walk(texts[at:to])
        some = symbols.reshape(len(symbols), -1, SAMPLES).any(axis=2)
        levels = np.where(some.any(axis=1), some.shape[1] - some[:, ::-1].argmax(axis=1), 0)
        out += [symbols[i, : SAMPLES * n].copy() for i, n in enumerate(levels)]
        at = to
    return out


def as_text(symbols: np.ndarray) -> str:
    return HEX[symbols].tobytes().decode()


@lru_cache(maxsize=64)
def _weights(levels: int) -> np.ndarray:
    """Steps that each sample stands for."""
    return np.concatenate([np.full(SAMPLES, max(1, 1 << max(0, level - 1)), float) for level in range(levels)]) if levels else np.zeros(0)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the walked steps on which two fingerprints agree, from 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    n = max(len(a), len(b))
    weight = _weights(n // SAMPLES)
    x, y = (np.concatenate((v, np.zeros(n - len(v), np.uint8))) for v in (a, b))
    walked = weight[(x > 0) | (y > 0)].sum()
    agree = weight[(x == y) & (x > 0)].sum() / walked
    return float(max(0.0, (agree - 1 / 15) / (1 - 1 / 15)))


# ---- documents beside the next one -----------------------------------------


def in_order_with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, part, guest``, dealt out by ranges of the id and sorted by
    (part, guest, id, text): the row after the last of a part is a copy (a
    guest) of the first row of the next part, after the last part of the first.

    The texts are shuffled once; the driver gets the first id of every part."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long"))
    n = partitions_for(rows)
    # more parts than tasks even out what a task gets
    ranges = rows.select(key.alias("key")).repartitionByRange(4 * n, "key").select(F.spark_partition_id().alias("part"), "key")
    firsts = np.array(sorted(r["key"] for r in ranges.groupBy("part").agg(F.min("key").alias("key")).collect()), np.int64)

    def deal(batches):
        for batch in batches:
            ids = batch.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            part = np.searchsorted(firsts, ids, "right") - 1
            first = np.flatnonzero(firsts[part] == ids)
            parts = np.concatenate((part, (part[first] - 1) % len(firsts))).astype(np.int32)
            guest = np.arange(len(parts)) >= len(part)
            whole = pa.Table.from_batches([batch])
            whole = pa.concat_tables([whole, whole.take(pa.array(first))])
            whole = whole.append_column("part", pa.array(parts)).append_column("guest", pa.array(guest))
            yield from whole.combine_chunks().to_batches()

    dealt = rows.mapInArrow(deal, "doc_id long, text string, part int, guest boolean")
    return dealt.repartition(n, "part").sortWithinPartitions("part", "guest", "doc_id", "text")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its fingerprint, that of its edited text (the second half
    replaced by the beginning of the next document), and how like its own
    fingerprint the edited text's and the next document's are."""
    bounded_batches(docs.sparkSession)
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def rows_of(batch, last):
        """Rows of the batch behind the last row before it."""
        ids, texts, parts, guests = (c.to_pylist() for c in batch.columns)
        return ([last] if last else []) + list(zip(ids, texts, parts, guests))

    def fingerprint(batches):
        last = None
        for batch in batches:
            rows = rows_of(batch, last)
            if not rows:
                continue
            last = rows[-1]
            at = [i for i in range(len(rows) - 1) if not rows[i][3] and rows[i + 1][2] == rows[i][2]]
            edited = [rows[i][1][: len(rows[i][1]) - len(rows[i][1]) // 2] + rows[i + 1][1][: len(rows[i][1]) // 2] for i in at]
            symbols = fingerprints([r[1] for r in rows])
            other = fingerprints(edited)
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[i][0] for i in at], pa.int64()),
                pa.array([len(rows[i][1]) for i in at], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
                pa.array([as_text(symbols[i]) for i in at], pa.string()),
                pa.array([as_text(s) for s in other], pa.string()),
                pa.array([likeness(symbols[i], s) for i, s in zip(at, other)], pa.float64()),
                pa.array([likeness(symbols[i], symbols[i + 1]) for i in at], pa.float64()),
            ], names=[c.split()[0] for c in schema.split(", ")])

    return in_order_with_next(docs, id_col, text_col).mapInArrow(fingerprint, schema)


# ---- banding and verification ----------------------------------------------

BUCKET = 64  # members of a bucket that are still paired with each other
BLOCK = 256  # members of a larger bucket that meet in one cell


def _buckets(nodes: DataFrame, bands: int, rows: int) -> DataFrame:
    """``bucket, node, n, rep`` for every bucket of ``n > 1`` members, ``rep`` a
    salted one of them: the level and ``rows`` sampled symbols of the last level
    of each fingerprint or of the one before (texts around a power of two meet).

    Samples past the end of a text say nothing, so bands that hold one are left
    out above level 0: the level before the last has none. At level 0 a band of
    the first symbols is added, which no text but the empty one is past."""
    picks = np.random.Generator(np.random.Philox(key=[SEED + 2, 0])).random((bands, SAMPLES)).argsort(axis=1)[:, :rows] + 1
    picks = np.concatenate((picks, np.arange(1, rows + 1)[None]))
    top = (F.length("fp") / SAMPLES).cast("int") - 1
    level = F.explode(F.array_distinct(F.array(top, F.greatest(top - 1, F.lit(0))))).alias("level")
    part = F.substring(F.col("fp"), F.col("level") * SAMPLES + 1, F.lit(SAMPLES)).alias("part")
    at = nodes.filter("fp <> ''").select("node", "fp", level).select("node", "level", part)
    keys = F.array(*[F.struct(F.lit(b).alias("band"), F.concat(*[F.substring("part", int(i), 1) for i in picks[b]]).alias("key")) for b in range(bands + 1)])
    each = at.select("node", "level", F.explode(keys).alias("k")).filter(
        F.when(F.col("level") > 0, (F.col("k.band") < bands) & ~F.col("k.key").contains("0")).otherwise(F.col("k.key") != "0" * rows))
    # unlike keys of one hash only meet and are verified
    members = written(each.select(F.xxhash64("level", "k.band", "k.key").alias("bucket"), "node"), "bands")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("bucket", "node"), "node")).alias("low"))
    sizes = written(sizes.filter("n > 1").select("bucket", "n", F.col("low.node").alias("rep")), "sizes")
    return written(members.join(sizes, "bucket"), "met")


def _symbols(texts, width: int) -> np.ndarray:
    """Symbols of fingerprints, padded to ``width``; 0 is past the end."""
    table = np.zeros(256, np.uint8)
    table[HEX] = np.arange(16)
    return table[np.frombuffer("".join(t.ljust(width, "0") for t in texts).encode(), np.uint8)].reshape(len(texts), width)


def _likenesses(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``likeness`` of rows of symbols that are not empty."""
    weight = _weights(y.shape[-1] // SAMPLES)
    agree = ((x == y) & (x > 0)) @ weight / (((x > 0) | (y > 0)) @ weight)
    return np.maximum(0.0, (agree - 1 / 15) / (1 - 1 / 15))


def _likeness_of(a: pd.Series, b: pd.Series) -> pd.Series:
    width = max(int(a.str.len().max()), int(b.str.len().max())) if len(a) else 0
    out = [_likenesses(_symbols(a[i : i + BLOCK], width), _symbols(b[i : i + BLOCK], width)) for i in range(0, len(a), BLOCK)]
    return pd.Series(np.concatenate(out) if out else [], dtype="float64")


def _alike(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs ``a, b`` of nodes that are alike by ``least`` or more."""
    verify = F.pandas_udf(_likeness_of, "double")
    with_a = pairs.distinct().join(nodes.select(F.col("node").alias("a"), F.col("fp").alias("x")), "a")
    both = with_a.join(nodes.select(F.col("node").alias("b"), F.col("fp").alias("y")), "b")
    return both.filter(verify("x", "y") >= least).select("a", "b")


def _crossing(left: DataFrame, right: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Links ``a, b`` between members of one bucket, ``left`` and ``right`` (both
    ``bucket, node, root``), of unlike roots: every such pair is verified, in
    cells of at most about ``BLOCK`` by ``BLOCK``, and of each cell and pair of
    roots one link is returned."""
    def blocks(members, name):
        count = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
        return written(count, "blocks")

    n, m = blocks(left, "n"), blocks(right, "m")
    grid = written(n.join(m, "bucket"), "grid")

    def dealt(members, own, other, mine, theirs):
        at = members.join(grid, "bucket").join(nodes, "node")
        place = F.pmod(F.xxhash64("node"), F.col(own)).cast("int").alias(mine)
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(theirs)
        return at.select("bucket", "node", "root", "fp", place, each).select("bucket", "i", "j", F.lit(mine == "i").alias("left"), "node", "root", "fp")

    def links(cell: pd.DataFrame) -> pd.DataFrame:
        out, x, y = {}, cell[cell.left], cell[~cell.left]
        if len(x) and len(y):
            width = max(int(x.fp.str.len().max()), int(y.fp.str.len().max()))
            s, t = _symbols(x.fp, width), _symbols(y.fp, width)
            a, b, p, q = x.node.to_numpy(), y.node.to_numpy(), x.root.to_numpy(), y.root.to_numpy()
            for i in range(len(x)):
                for k in np.flatnonzero((_likenesses(s[i], t) >= least) & (q != p[i])):
                    out.setdefault((min(p[i], q[k]), max(p[i], q[k])), (min(a[i], b[k]), max(a[i], b[k])))
        return pd.DataFrame(list(out.values()), columns=["a", "b"], dtype="int64")

    cells = dealt(left, "n", "m", "i", "j").unionByName(dealt(right, "m", "n", "j", "i"))
    return cells.groupBy("bucket", "i", "j").applyInPandas(links, "a long, b long").distinct()


def _nodes(fps: DataFrame) -> DataFrame:
    return written(fps.select("fp").distinct().withColumn("node", F.monotonically_increasing_id()), "nodes")


def near_links(fps: DataFrame, least: float = 0.8, bands: int = 8, rows: int = 6) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that share a
    band and are alike by ``least`` or more. Every pair of every bucket is
    verified and every link is a row: for large groups take ``near_classes``."""
    nodes = _nodes(fps)
    members = _buckets(nodes, bands, rows).select("bucket", "node", F.col("node").alias("root"))
    links = _crossing(members, members, nodes, least)
    a, b = nodes.select(F.col("node").alias("a"), F.col("fp").alias("x")), nodes.select(F.col("node").alias("b"), F.col("fp").alias("y"))
    return links.join(a, "a").join(b, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def near_classes(fps: DataFrame, least: float = 0.8, bands: int = 8, rows: int = 6) -> DataFrame:
    """``fp, root`` for the distinct fingerprints of ``fps``: the classes that
    the links of ``near_links`` connect, without a row per link.

    Buckets of at most ``BUCKET`` members are paired up. In a larger one every
    member is verified against one of them, and after that every member outside
    the bucket's largest class against all members of other classes: a link
    between two classes has an end outside the largest, so none is lost."""
    nodes = _nodes(fps)
    met = _buckets(nodes, bands, rows)
    small = met.filter(F.col("n") <= BUCKET).select("bucket", "node")
    pairs = small.withColumnRenamed("node", "a").join(small.withColumnRenamed("node", "b"), "bucket").filter("a < b").select("a", "b")
    crowded = met.filter(F.col("n") > BUCKET)
    stars = crowded.filter("node <> rep").select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b"))
    links = written(_alike(pairs.unionByName(stars), nodes, least), "links")
    roots = written(connected_components(links), "roots")
    placed = crowded.select("bucket", "node").join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    placed = written(placed, "placed")
    sizes = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket")
    sizes = written(sizes.agg(F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("bucket", F.col("top.root").alias("top")), "sizes")
    if not sizes.isEmpty():
        split = written(placed.join(sizes, "bucket"), "split")
        found = _crossing(split.filter("root <> top").drop("top"), split.drop("top"), nodes, least)
        roots = written(connected_components(links.unionByName(written(found, "found"))), "roots")
    return nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("root"))


def with_classes(rows: DataFrame, least: float = 0.8, id_col: str = "doc_id", fp_col: str = "fingerprint") -> DataFrame:
    """``rows`` with ``class_id``, the smallest id of the row's class (null if
    all its ids are): rows whose fingerprints links of ``least`` or more connect."""
    rows = written(rows, "fps")
    classes = written(near_classes(rows.select(F.col(fp_col).alias("fp")), least), "classes")
    lows = written(rows.groupBy(F.col(fp_col).alias("fp")).agg(F.min(id_col).alias("low")), "lows")
    low = classes.join(lows, "fp")
    named = written(low.groupBy("root").agg(F.min("low").alias("class_id")), "named")
    side = written(low.select("fp", "root").join(named, "root").select(F.col("fp").alias(fp_col), "class_id"), "named")
    return rows.join(side, fp_col).select(*rows.columns, "class_id")
