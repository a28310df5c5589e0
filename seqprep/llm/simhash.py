"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word
shingles. Two fingerprints that differ in at most ``max_bits`` bits, cut into
``max_bits // 2 + 1`` segments, have one segment that differs in at most one
bit. Every segment is indexed once per bit with that bit wiped out, so such a
pair meets in an equality join on (wiped bit, rest of the segment) and is then
verified on all 64 bits.

Only distinct fingerprints are indexed, so exact and near copies with one
fingerprint cost one entry. An index bucket of more than ``BUCKET`` members is
not paired up: its members are linked through the points one bit away from
them. Two fingerprints at distance one or two share such a point (or one is
the other's), all members of a point are within two bits of each other, and a
point has at most 65 members -- exact, and linear in the members.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; fewer words than a shingle hash as one shingle; repeated rows get
the same class; null ids rank last, so they name a class only if all its ids
are null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqprep.llm.common import as_scan, bounded_batches, small_side, whole_rows, with_locator, written
from seqprep.llm.components import connected_components

SEED = 42
BITS = 64
# Bytes of a place (path, index) in a broadcast table.
PLACE_BYTES = 256
# Bucket members that are still paired with each other.
BUCKET = 32
# Bytes of an Arrow batch of texts.
BATCH_BYTES = 1 << 20


def simhash(text: bytes | None, shingle: int) -> int:
    """Fingerprint of one text (UTF-8) as an unsigned integer."""
    words = (text or b"").lower().split()  # on bytes: ASCII letters and white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    hashes = np.array([digest(line[i:j], SEED) for i, j in spans], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, max(1, len(hashes) // 65536)):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_udf(shingle: int):
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return fingerprint


def hex64(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variant_masks(max_bits: int) -> list[int]:
    """Per bit, the mask that keeps the other bits of that bit's segment."""
    segments = max_bits // 2 + 1
    cuts = [BITS * s // segments for s in range(segments + 1)]
    masks = []
    for lo, hi in zip(cuts, cuts[1:]):
        whole = ((1 << hi) - 1) ^ ((1 << lo) - 1)
        masks += [_signed(whole & ~(1 << bit)) for bit in range(lo, hi)]
    return masks


def near_links(fps: DataFrame, max_bits: int, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints ``fp`` that connect
    exactly the pairs within ``max_bits`` bits (0 to 2): every such pair is a
    link or joined by links that are within the distance themselves."""
    if not 0 <= max_bits <= 2:
        raise ValueError(f"max_bits must be 0, 1 or 2, not {max_bits}")
    masks = F.array(*[F.lit(m).cast("long") for m in variant_masks(max_bits)])
    variants = fps.select("fp", F.posexplode(F.transform(masks, lambda m: F.col("fp").bitwiseAND(m))).alias("bit", "rest"))
    sized = variants.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("bit", "rest")))
    met = written(sized.filter("n > 1"), "buckets")

    paired = met.filter(F.col("n") <= bucket).select("bit", "rest", "fp")
    pairs = (
        paired.withColumnRenamed("fp", "a").join(paired.withColumnRenamed("fp", "b"), ["bit", "rest"])
        .filter("a < b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b").distinct()
    )
    if max_bits < 2:  # a bucket then has two members at most
        return pairs
    crowded = met.filter(F.col("n") > bucket).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(BITS)])
    points = crowded.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    # at most 65 distinct fingerprints lie within one bit of a point
    balls = points.groupBy("point").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1)
    stars = balls.select(F.explode("members").alias("a"), F.array_min("members").alias("b")).filter("a <> b").distinct()
    return pairs.unionByName(stars)


def simhash_dedup(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id``, ``fp`` (signed 64 bits), ``component_id``
    (the smallest id that links lead to, its own included), ``kept`` (the one
    row of the class that stays: the smallest id, then place), ``_file, _row``."""
    bounded_batches(docs.sparkSession, size=BATCH_BYTES)
    fingerprint = fingerprint_udf(shingle)
    text = F.col(text_col).cast("string").cast("binary")
    rows = written(with_locator(as_scan(docs), [F.col(id_col).alias("id"), fingerprint(text).alias("fp")]), "fps")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "_file", "_row")
    distinct = written(rows.groupBy("fp").agg(F.min(first).alias("low")), "distinct")
    roots = connected_components(near_links(distinct.select("fp"), max_bits))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    named = written(placed.groupBy("root").agg(F.min("low").alias("first")), "roots")
    classes = written(placed.join(named, "root").select("fp", "first"), "classes")
    place = F.struct("_file", "_row") == F.struct(F.col("first._file"), F.col("first._row"))
    return rows.join(classes, "fp").select("id", "fp", F.col("first.id").alias("component_id"), place.alias("kept"), "_file", "_row")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all columns."""
    scan = as_scan(docs)
    classes = simhash_dedup(scan, shingle, max_bits, id_col, text_col)
    dropped = written(classes.filter("not kept").select("_file", "_row"), "dropped")
    side = small_side(dropped, dropped.count(), PLACE_BYTES)
    return whole_rows(scan).join(side, ["_file", "_row"], "left_anti").select("doc.*")
