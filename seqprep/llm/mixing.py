"""Mixing sources to target weights by a multivariate-hypergeometric tree.

Every source's documents are laid out in hash order as a line of words; its
target is a stretch of that line, repeated where the target exceeds the source.
The stretch is cut into blocks, so each source has an exact quota of blocks.
A splitting tree over the output shards halves the quotas level by level: a
node draws how many blocks of each source go left from the multivariate
hypergeometric distribution, so leaves hold exact shares that add up to the
quotas. A source's blocks are then permuted (a keyed Feistel network, one-to-one
for any number of blocks) and dealt to the shards as disjoint runs of those
lengths, and every shard is ordered by a hash of its pieces. A piece belongs to
the block in which it begins, so a shard's words are exact in blocks and differ
by the documents that reach over a block's end.

Native throughout: DataFrame and SQL functions only. Texts are read once for
their word counts; prefix sums go over buckets of ``BUCKET_ROWS`` documents,
then over chunks of buckets, so a source with a third of all rows is never
one window. A mix has one row per source in its plan (thousands at most).

Defined results: null texts and texts without words have size 0 and are never
taken; a null source is a source of its own, last in order; rows with equal or
null ids are ordered by size among each other and each counts; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqprep.llm.common import WORD, as_scan, n_words, partitions_for, small_side, text_of, whole_rows, with_locator, written

BUCKET_ROWS = 512
CHUNK_BITS = 10  # buckets of a chunk, as a power of two
BLOCK_WORDS = 16_384
ROW_BYTES = 256
# Rounds of the block permutation, and how often it may be applied until a block
# number is in range (each time fails for under one in sqrt(blocks) of them).
ROUNDS = 6
WALKS = 40


def _hash(*parts: Column, digits: int = 15) -> Column:
    """``digits`` hexadecimal digits of an MD5 over the parts, as long."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[float, ...]) -> DataFrame:
    """``source, weight``: the sources by code point, null last, weigh
    ``cycle`` in turn."""
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    return sources.select("source").distinct().withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (rank - 1) % len(cycle) + 1)
    )


def source_targets(sizes: DataFrame, weights: DataFrame, cap: int) -> DataFrame:
    """``sid, source, n, source_size, target``: the weights share all sizes;
    a target stops at ``cap`` times its source and the excess is shared again
    by weight. The common level (target per weight) is the largest of the
    levels that result when the sources are capped one after the other in
    order of their cap per weight."""
    named = weights.withColumnRenamed("source", "_of")
    table = sizes.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("_of")), "left").select(
        "source", "n", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight")
    )
    everyone = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weighed = F.col("weight") > 0
    most = F.lit(cap).cast("long") * F.col("source_size")
    order = [F.when(weighed, most / F.col("weight")).asc_nulls_last(), F.col("source").isNull(), F.col("source")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everyone) - F.coalesce(F.sum(most).over(before), F.lit(0))
    weight_left = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.max(F.when(F.col("weight_left") > 0, F.col("left") / F.col("weight_left"))).over(everyone)
    sid = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    return (
        table.withColumn("left", F.when(weighed, left)).withColumn("weight_left", F.when(weighed, weight_left))
        .withColumn("level", F.coalesce(level, F.lit(0.0)))
        .select(sid.alias("sid"), "source", "n", "source_size",
                F.least(most.cast("double"), F.col("level") * F.col("weight")).alias("target"))
    )


def _log_factorial(x: str) -> str:
    return (
        f"IF({x} <= 20, ln(factorial(CAST({x} AS INT))), "
        f"{x} * ln({x}) - {x} + 0.5D * ln({2 * math.pi!r}D * {x}) + 1 / (12D * {x}) - 1 / (360D * {x} * {x} * {x}))"
    )


def _hypergeometric(pop: str, hits: str, draws: str, u: str) -> str:
    """SQL for one draw: how many of ``draws`` from ``pop`` are among ``hits``,
    by inverting the distribution at ``u`` over 12 deviations around the mean
    (the rest weighs under 1e-30)."""
    v = _log_factorial
    low, high = f"greatest(0L, {draws} - ({pop} - {hits}))", f"least({hits}, {draws})"
    mean = f"(1D * {draws} * {hits} / greatest({pop}, 1L))"
    wide = f"(12D * (1 + sqrt(least({mean}, greatest(0D, {draws} - {mean}, {hits} - {mean})))))"
    bounds = (
        f"named_struct('lo', greatest({low}, CAST(floor({mean} - {wide}) AS BIGINT)), "
        f"'hi', least({high}, CAST(ceil({mean} + {wide}) AS BIGINT)))"
    )
    first = (
        f"exp({v(f'({hits})')} - {v('b.lo')} - {v(f'({hits} - b.lo)')} + {v(f'({pop} - {hits})')} - {v(f'({draws} - b.lo)')}"
        f" - {v(f'({pop} - {hits} - {draws} + b.lo)')} - {v(f'({pop})')} + {v(f'({draws})')} + {v(f'({pop} - {draws})')})"
    )
    step = f"(1D * ({hits} - k) * ({draws} - k)) / (1D * (k + 1) * ({pop} - {hits} - {draws} + k + 1))"
    return f"""element_at(transform(array({bounds}), b -> aggregate(sequence(b.lo, b.hi),
        named_struct('p', {first}, 'sum', 0D, 'pick', CAST(NULL AS BIGINT)),
        (s, k) -> named_struct('p', s.p * {step}, 'sum', s.sum + s.p,
                               'pick', coalesce(s.pick, IF(s.sum + s.p >= {u}, k, CAST(NULL AS BIGINT)))),
        s -> coalesce(s.pick, b.hi))), 1)"""


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``sid, shard, n``: the exact number of blocks of each source in each
    shard, from ``quotas`` (``sid`` from 0 without gaps, ``blocks``). Shard sizes
    differ by one block at most."""
    draw = _hypergeometric("a.pop", "x.q", "a.n", "x.u")
    left = f"""aggregate(
        transform(q, (v, i) -> named_struct('q', v, 'u', CAST(conv(substr(md5(concat_ws('|', '{seed}', lo, hi, i)), 1, 13), 16, 10) AS BIGINT) / 4503599627370496D)),
        named_struct('pop', total, 'n', room, 'out', CAST(array() AS ARRAY<BIGINT>)),
        (a, x) -> element_at(transform(array({draw}), k -> named_struct('pop', a.pop - x.q, 'n', a.n - k, 'out', concat(a.out, array(k)))), 1),
        a -> a.out)"""
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("sid", F.col("blocks").cast("long").alias("q")))).alias("s")).selectExpr(
        "transform(s, x -> x.q) AS q", "0L AS lo", f"{shards}L AS hi", "aggregate(s, 0L, (t, x) -> t + x.q) AS blocks"
    )
    for level in range(max(0, math.ceil(math.log2(shards)))):
        if level == 5:  # by now there is work for more than one task
            nodes = nodes.repartition("lo")
        sized = nodes.selectExpr("*", "(lo + hi) DIV 2 AS mid", "aggregate(q, 0L, (t, x) -> t + x) AS total").selectExpr(
            "*", f"(blocks * mid) DIV {shards} - (blocks * lo) DIV {shards} AS room"
        )
        drawn = sized.selectExpr("q", "lo", "hi", "mid", "blocks", f"IF(hi - lo > 1, {left}, q) AS l")
        halves = """explode(IF(hi - lo > 1, array(
            named_struct('q', l, 'lo', lo, 'hi', mid), named_struct('q', zip_with(q, l, (x, y) -> x - y), 'lo', mid, 'hi', hi)),
            array(named_struct('q', q, 'lo', lo, 'hi', hi)))) AS h"""
        nodes = drawn.selectExpr("blocks", halves).selectExpr("h.q AS q", "h.lo AS lo", "h.hi AS hi", "blocks")
    return nodes.selectExpr("lo AS shard", "posexplode(q) AS (sid, n)").select("sid", F.col("shard").cast("int"), "n")


def permuted(rows: DataFrame, x: str, n: str, key: str, out: str) -> DataFrame:
    """Add ``out``: the place of ``x`` in a permutation of 0 to ``n`` - 1 chosen by
    the SQL expression ``key``.

    A Feistel network on pairs (l, r) of a grid of a x b cells, a the rounded up
    root of n: the halves in turn are shifted by a hash of the other, which is
    one-to-one on the grid. Cells from n on (fewer than a) are walked through
    until a number is in range, which keeps it one-to-one below n."""
    grid = rows.withColumn("_a", F.greatest(F.lit(1), F.ceil(F.sqrt(F.col(n)))).cast("long")).withColumn("_b", F.expr(f"({n} + _a - 1) DIV _a"))
    shift = lambda half, size: f"pmod(xxhash64({key}, i, s.{half}), {size})"
    once = f"""aggregate(sequence(1, {ROUNDS}), named_struct('l', w.v DIV _b, 'r', w.v % _b),
        (s, i) -> IF(i % 2 = 1, named_struct('l', (s.l + {shift('r', '_a')}) % _a, 'r', s.r),
                                named_struct('l', s.l, 'r', (s.r + {shift('l', '_b')}) % _b)),
        s -> s.l * _b + s.r)"""
    walk = f"""aggregate(sequence(1, {WALKS}), named_struct('v', CAST({x} AS BIGINT), 'found', false),
        (w, j) -> IF(w.found, w, element_at(transform(array({once}), v -> named_struct('v', v, 'found', v < {n})), 1)),
        w -> IF(w.found, w.v, CAST(raise_error('no block number in range') AS BIGINT)))"""
    return grid.withColumn(out, F.expr(walk)).drop("_a", "_b")


def mix_sources(
    docs: DataFrame, weights: DataFrame | None = None, cycle: tuple[float, ...] = (5, 2, 1), cap: int = 3,
    shards: int | None = None, block_words: int = BLOCK_WORDS, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix as pieces of documents: one row per input row and time it is
    taken (one with ``words`` 0 if it is not), with ``id, source, size,
    source_size, target, epoch, words`` (its first ``words`` words are taken),
    ``shard``, ``order_key`` (order inside the shard), and the row's place
    ``_file, _row``. ``weights`` (``source, weight``) name the shares; without
    it the sources weigh ``cycle`` in turn."""
    shards = shards or partitions_for(docs)
    placed = with_locator(as_scan(docs), [
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"),
    ])
    rows = written(placed.withColumn("h", _hash(F.lit(seed), F.col("id"))), "sizes")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    targets = source_targets(sizes, cyclic_weights(sizes, cycle) if weights is None else weights, cap)
    # whole words: the quota of a source is its target rounded
    quota = F.floor(F.col("target") + 0.5).cast("long")
    plan = written(
        targets.withColumn("quota", quota).withColumn("blocks", F.ceil(F.col("quota") / block_words).cast("long"))
        .withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS).cast("long")), "sources",
    )
    side = small_side(plan.withColumnRenamed("source", "_source"), plan.count(), ROW_BYTES)
    lined = rows.join(side, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "bucket", F.shiftright(F.shiftright("h", 28) * F.col("buckets"), 32)  # the hash has 60 bits
    )
    placed_rows = _line_up(lined)

    epochs = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(cap - 1).cast("long")), lambda e: F.struct(
        e.alias("epoch"), (F.col("start") + e * F.col("source_size")).alias("at"),
        F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("quota") - F.col("start") - e * F.col("source_size"))).alias("words"),
    )), lambda p: p["words"] > 0)
    pieces = placed_rows.withColumn("piece", F.explode_outer(epochs)).select(
        "id", "source", "size", "source_size", "target", "sid", "_file", "_row",
        F.coalesce("piece.epoch", F.lit(0)).cast("int").alias("epoch"), F.coalesce("piece.words", F.lit(0)).cast("long").alias("words"),
        # rows that are not taken get scattered numbers that no block has
        F.when(F.col("piece.words") > 0, F.floor(F.col("piece.at") / block_words).cast("long"))
        .otherwise(F.lit(-1).cast("long") - F.pmod(F.xxhash64("_file", "_row"), F.lit(1 << 31))).alias("block"),
    )

    runs = split_quotas(plan.select("sid", "blocks"), shards, seed)
    run = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    turns = runs.withColumn("first", F.coalesce(F.sum("n").over(run), F.lit(0))).filter("n > 0").join(side.select("sid", "blocks"), "sid").select(
        "sid", "blocks", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("turn")
    )
    dealt = permuted(turns, "turn", "blocks", f"{seed}L, sid", "block").select("sid", "block", "shard")
    return pieces.join(written(dealt, "dealt"), ["sid", "block"], "left").select(
        "id", "source", "size", "source_size", "target", "epoch", "words", "shard",
        _hash(F.lit(seed), F.col("shard"), F.col("id"), F.col("epoch")).alias("order_key"), "_file", "_row",
    )


def _line_up(lined: DataFrame) -> DataFrame:
    """Add ``start``: the words before each row on its source's line."""
    chunk = F.shiftright("bucket", CHUNK_BITS).alias("chunk")
    buckets = written(lined.groupBy("sid", "bucket").agg(F.sum("size").alias("words")).select("*", chunk), "buckets")
    before = lambda *keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    total = lambda column, window: F.coalesce(F.sum(column).over(window), F.lit(0))
    chunks = buckets.groupBy("sid", "chunk").agg(F.sum("words").alias("words")).select(
        "sid", "chunk", total("words", before("sid", by="chunk")).alias("chunk_base")
    )
    bases = written(
        buckets.join(chunks, ["sid", "chunk"]).select(
            "sid", "bucket", (F.col("chunk_base") + total("words", before("sid", "chunk", by="bucket"))).alias("base")
        ), "bases",
    )
    inside = Window.partitionBy("sid", "bucket").orderBy("h", "id", "size", "_file", "_row").rowsBetween(Window.unboundedPreceding, -1)
    return lined.join(bases, ["sid", "bucket"]).withColumn("start", F.col("base") + total("size", inside))


def first_words(text: Column, n: Column) -> Column:
    """The text up to its ``n``-th word, white space kept."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), n), "")


def mixed_documents(docs: DataFrame, shards: int | None = None, **options) -> DataFrame:
    """The mix as document rows with the columns of ``docs``: a document taken
    twice is there twice, one taken in part ends at its last word taken. Rows
    of a shard stand together, in the shard's order."""
    shards = shards or partitions_for(docs)
    text_col = options.get("text_col", "text")
    scan = as_scan(docs)
    pieces = written(
        mix_sources(scan, shards=shards, **options).filter("words > 0").select("_file", "_row", "words", "size", "shard", "order_key"),
        "pieces",
    )
    taken = whole_rows(scan).join(small_side(pieces, pieces.count(), ROW_BYTES), ["_file", "_row"])
    text = F.col(f"doc.`{text_col}`").cast("string")
    cut = F.when(F.col("words") < F.col("size"), first_words(text_of(text), F.col("words").cast("int"))).otherwise(text)
    whole = taken.withColumn("doc", F.col("doc").withField(f"`{text_col}`", cut))
    return whole.repartition(shards, "shard").sortWithinPartitions("shard", "order_key").select("doc.*")
