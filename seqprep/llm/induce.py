"""External induced sorting of the suffixes of one shard, with common prefixes.

A shard is a string of small numbers that ends in a lone 0. Suffixes are of
type S (smaller than the next one) or L; a leftmost S is a star. Steps:

1. The blocks from star to star are sorted and named; the names form a string
   of at most half the length. It is sorted by recursion, or by doubling once
   it has ``base`` names or fewer. Both also tell how many names neighbouring
   stars share, from which their common prefix in symbols follows.
2. From the sorted stars the L suffixes are induced in ascending, from those
   the S suffixes in descending order. A priority queue by first symbol holds
   tuples (position, preceding symbols, common prefix with the tuple before).
   Extracting a tuple takes the next preceding symbol from it and inserts the
   suffix one place to the left; its common prefix is one more than the least
   one scanned since the last insertion under that symbol.

Tuples of one symbol come in order, so the queue keeps a file of sorted runs
per symbol; it holds ``memory`` bytes and puts the rest on disk, as do the
arrays of a long shard, which are mapped files. Tuples carry the symbols before
them, so the text is read in one sweep and not at random.

Only ``cap`` symbols matter: suffixes that agree so far may come in any order,
and no common prefix is counted beyond.
"""

from __future__ import annotations

import os
import uuid

import numpy as np

MEMORY = 96 << 20
BASE = 1 << 22
BATCH = 1 << 16


class Store:
    """Arrays in memory, or mapped files in ``folder`` once ``memory`` bytes are held."""

    def __init__(self, memory: int = MEMORY, folder=None):
        self.memory, self.folder, self.files = memory, folder, []

    def path(self) -> str:
        if self.folder is None:
            raise ValueError("a shard of this size needs a folder for its files")
        folder = self.folder() if callable(self.folder) else self.folder
        os.makedirs(folder, exist_ok=True)
        self.files.append(os.path.join(folder, f"sort-{uuid.uuid4().hex}"))
        return self.files[-1]

    def array(self, n: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= self.memory:
            return np.zeros(n, dtype)
        return np.memmap(self.path(), dtype, "w+", shape=(n,))

    def close(self) -> None:
        """Remove the files: they belong to one task and one shard."""
        for path in self.files:
            if os.path.exists(path):
                os.remove(path)


class Queue:
    """A monotone priority queue of tuples by symbol: sorted runs per symbol, in
    memory up to the store's bound and in one file beyond it."""

    def __init__(self, store: Store, dtypes: list):
        self.store, self.dtypes = store, [np.dtype(d) for d in dtypes]
        self.runs: dict[int, list] = {}
        self.held, self.file, self.size = 0, None, 0

    def push(self, symbol: int, columns: tuple) -> None:
        self.runs.setdefault(symbol, []).append(columns)
        self.held += sum(c.nbytes for c in columns)
        if self.held > self.store.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = open(self.store.path(), "w+b")
        self.file.seek(self.size)
        for runs in self.runs.values():
            for i, run in enumerate(runs):
                if isinstance(run, tuple):
                    runs[i] = [self.size, len(run[0])]
                    for c, d in zip(run, self.dtypes):
                        self.file.write(np.ascontiguousarray(c, d).data)
                        self.size += len(c) * d.itemsize
        self.file.flush()
        self.held = 0

    def _load(self, run) -> tuple:
        if isinstance(run, tuple):
            self.held -= sum(c.nbytes for c in run)
            return run
        at, n = run
        columns = []
        for d in self.dtypes:
            self.file.seek(at)
            columns.append(np.fromfile(self.file, d, n))
            at += n * d.itemsize
        return tuple(columns)

    def pop(self, symbol: int, backwards: bool = False):
        """The runs of a symbol, one after another, as batches; runs that are
        pushed meanwhile follow."""
        while runs := self.runs.get(symbol):
            taken, n = [], 0
            while runs and n < BATCH:
                taken.append(self._load(runs.pop(-1 if backwards else 0)))
                n += len(taken[-1][0])
            if backwards:
                taken.reverse()
            yield tuple(np.concatenate(c) for c in zip(*taken)) if len(taken) > 1 else taken[0]
        self.runs.pop(symbol, None)


def _types(text: np.ndarray, store: Store) -> np.ndarray:
    """``2 * symbol + 1`` for S and ``2 * symbol`` for L suffixes."""
    n = len(text)
    codes = store.array(n, np.uint16 if text.dtype == np.uint8 else np.int64)
    following, after = True, None  # type and symbol of what stands behind a batch
    for b in range(n, 0, -BATCH):
        a = max(0, b - BATCH)
        part = text[a:b].astype(np.int64)
        ahead = np.append(part[1:], part[-1] if after is None else after)
        rises = part < ahead
        # equal symbols take the type of the first unequal pair behind them
        at = np.where(part != ahead, np.arange(b - a), b - a)
        at = np.minimum.accumulate(at[::-1])[::-1]
        s = np.append(rises, following)[at]
        codes[a:b] = 2 * part + s
        following, after = bool(s[0]), part[0]
    return codes


def _stars(codes: np.ndarray) -> np.ndarray:
    found = []
    for a in range(1, len(codes), BATCH):
        b = min(a + BATCH, len(codes))
        found.append(np.flatnonzero((codes[a:b] & 1 == 1) & (codes[a - 1 : b - 1] & 1 == 0)) + a)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _packing(codes: np.ndarray) -> tuple[int, int]:
    """Bits of a code and codes of a 63-bit word."""
    bits = 9 if codes.dtype == np.uint16 else max(int(codes.max()).bit_length(), 1)
    return bits, 63 // bits


def _block_words(codes: np.ndarray, stars: np.ndarray, last: np.ndarray, skip: int) -> np.ndarray:
    """The codes of each block (``stars`` to ``last``) from number ``skip`` on, in one word."""
    bits, each = _packing(codes)
    words = np.zeros(len(stars), np.int64)
    for r in range(skip, skip + each):
        at = stars + r
        inside = at <= last
        words = (words << bits) | np.where(inside, codes[np.minimum(at, last)], 0)
    return words


def _refined(rank: np.ndarray, who: np.ndarray, keys: np.ndarray, shared: np.ndarray, value: int) -> np.ndarray:
    """Order ``who`` inside their classes by ``keys``; ``rank`` is the number of
    smaller ones. Notes ``value`` where a class parts, and returns those whose
    class still has several members."""
    old = rank[who]
    if len(keys) and keys.max() < 1 << 31 and len(rank) < 1 << 31:
        order = np.argsort((old << 32) + keys)
    else:
        order = np.lexsort((keys, old))
    who, old, keys = who[order], old[order], keys[order]
    new_class = np.concatenate(([True], old[1:] != old[:-1]))
    new_value = new_class | np.concatenate(([True], keys[1:] != keys[:-1]))
    at = np.arange(len(who))
    first = np.maximum.accumulate(np.where(new_class, at, 0))
    start = np.maximum.accumulate(np.where(new_value, at, 0))
    rank[who] = old + (start - first)
    parted = new_value & ~new_class
    shared[old[parted] + (at - first)[parted]] = value
    alone = new_value & np.concatenate((new_value[1:], [True]))
    return who[~alone]


def _names(codes: np.ndarray, stars: np.ndarray) -> np.ndarray:
    """Rank of every block among all blocks: the number of smaller ones."""
    last = np.append(stars[1:], stars[-1])
    each = _packing(codes)[1]
    words = _block_words(codes, stars, last, 0)
    order = np.argsort(words, kind="stable")
    ordered = words[order]
    fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(len(stars), np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(stars)), 0))
    skip = each
    while len(who := np.flatnonzero(last - stars + 1 > skip)):
        _refined(rank, who, _block_words(codes, stars[who], last[who], skip), np.zeros(len(stars), np.int64), 0)
        skip += each
    return rank


def _doubled(rank: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of a string of ranks by their first ``most`` names,
    and how many names neighbours share at least."""
    m = len(rank)
    rank = rank.copy()
    counts = np.bincount(rank, minlength=m)
    shared = np.zeros(m, np.int64)
    who = np.flatnonzero(counts[rank] > 1)
    h = 1
    while len(who) and h < most:
        behind = np.where(who + h < m, rank[np.minimum(who + h, m - 1)], -1)
        who = _refined(rank, who, behind, shared, h)
        h *= 2
    order = np.argsort(rank, kind="stable")
    ties = rank[order]
    shared[1:][ties[1:] == ties[:-1]] = most
    return order, shared


def _extended(text: np.ndarray, p: np.ndarray, q: np.ndarray, known: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of the suffixes ``p`` and ``q``, which agree over ``known`` symbols."""
    out = np.minimum(known, cap)
    left = np.flatnonzero(out < cap)
    n = len(text)
    if text.dtype == np.uint8:
        padded = text if isinstance(text, np.memmap) else np.ascontiguousarray(text)
        wide = np.ndarray((max(n - 7, 0),), "<u8", padded, 0, (1,))
    while len(left):
        a, b = p[left] + out[left], q[left] + out[left]
        if text.dtype == np.uint8 and n >= 8:
            # words near the end begin early enough and are shifted
            sa, sb = np.minimum(a, n - 8), np.minimum(b, n - 8)
            x = (wide[sa] >> (8 * (a - sa)).astype(np.uint64)) ^ (wide[sb] >> (8 * (b - sb)).astype(np.uint64))
            # the lowest set bit is a power of two: its number is a float's exponent
            low = x & (~x + np.uint64(1))
            same = np.where(x == 0, 8, ((low.astype(np.float64).view(np.int64) >> 52) - 1023) >> 3)
            step = 8
        else:
            same, step = (text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)]).astype(np.int64), 1
        out[left] += same
        left = left[(same == step) & (out[left] < cap)]
    return np.minimum(out, cap)


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values[low..high]`` for every pair, level by level of a sparse table."""
    out = np.zeros(len(low), values.dtype)
    span = high - low + 1
    if not len(low):
        return out
    level = np.frexp(span.astype(np.float64))[1] - 1
    table = values
    for j in range(int(level.max()) + 1):
        if j:
            half = 1 << (j - 1)
            table = np.minimum(table[:-half], table[half:])
        here = np.flatnonzero(level == j)
        if len(here):
            out[here] = np.minimum(table[low[here]], table[high[here] - (1 << j) + 1])
    return out


class _Induction:
    """One pass over the buckets: L suffixes upwards or S suffixes downwards."""

    def __init__(self, codes: np.ndarray, cap: int, kind: int, symbols: int, store: Store, place):
        self.codes, self.cap, self.kind = codes, cap, kind
        self.bits, self.each = _packing(codes)
        self.mask = (1 << self.bits) - 1
        self.queue = Queue(store, [place, np.int64, np.int32])
        # least common prefix since the last insertion, by symbol, and the bucket it was in
        self.least = np.zeros(symbols, np.int32)
        self.seen = np.full(symbols, -1, np.int64)
        self.touched = np.zeros(0, np.int64)
        self.bucket = -1

    def preceding(self, pos: np.ndarray) -> np.ndarray:
        """The codes before each position, nearest lowest, in one word."""
        words = np.zeros(len(pos), np.int64)
        for r in range(self.each, 0, -1):
            at = pos.astype(np.int64) - r
            words = (words << self.bits) | np.where(at >= 0, self.codes[np.maximum(at, 0)], 0)
        return words

    def enter(self, bucket: int) -> None:
        self.bucket, self.touched = bucket, np.zeros(0, np.int64)

    def scan(self, pos: np.ndarray, words: np.ndarray, prefix: np.ndarray) -> None:
        """Insert the suffixes to the left of scanned ones that have the pass's type."""
        spent = np.flatnonzero((words == 0) & (pos > 0))
        if len(spent):
            words = words.copy()
            words[spent] = self.preceding(pos[spent])
        code = words & self.mask
        x = np.flatnonzero((code != 0) & (code & 1 == self.kind))
        total = prefix.min()
        if len(x):
            symbol = code[x] >> 1
            order = np.argsort(symbol.astype(np.uint8) if len(self.least) <= 256 else symbol, kind="stable")
            x, symbol = x[order], symbol[order]
            first = np.concatenate(([True], symbol[1:] != symbol[:-1]))
            values = np.empty(len(x), np.int32)
            rest = np.flatnonzero(~first)
            values[rest] = _range_min(prefix, x[rest - 1] + 1, x[rest]) + 1
            heads = np.flatnonzero(first)
            chars = symbol[heads]
            upto = np.minimum.accumulate(prefix)[x[heads]]
            before = np.where(self.seen[chars] == self.bucket, np.minimum(self.least[chars], upto), 0) + 1
            values[heads] = np.where(self.seen[chars] < 0, 0, before)
            values = np.minimum(values, self.cap)
            columns = (pos[x] - 1, words[x] >> self.bits, values)
            bounds = np.append(heads, len(x)).tolist()
            for c, a, b in zip(chars.tolist(), bounds, bounds[1:]):
                self.queue.push(c, tuple(col[a:b] for col in columns))
        if len(self.touched):
            self.least[self.touched] = np.minimum(self.least[self.touched], total)
        if len(x):
            tail = np.append(np.minimum.accumulate(prefix[::-1])[::-1], self.cap)
            ends = x[np.append(heads[1:], len(x)) - 1]
            self.least[chars] = tail[ends + 1]
            self.seen[chars] = self.bucket
            self.touched = np.union1d(self.touched, chars) if len(self.touched) else chars


def _common(text: np.ndarray, p: int, q: int, cap: int) -> int:
    one = np.array([p], np.int64), np.array([q], np.int64)
    return int(_extended(text, *one, np.zeros(1, np.int64), cap)[0])


def sorted_suffixes(text: np.ndarray, cap: int, store: Store, base: int = BASE):
    """Batches ``(positions, common prefixes)`` that together hold all suffixes
    but the last in their order within ``cap`` symbols, from the largest down:
    the value beside a suffix is that with the one before it in this order
    (the next larger one)."""
    n = len(text)
    place = np.int32 if n < 1 << 31 else np.int64
    codes = _types(text, store)
    stars = _stars(codes)
    symbols = int(text.max()) + 1
    if len(stars) <= 1:
        order, shared = np.arange(len(stars)), np.zeros(len(stars), np.int64)
    else:
        rank = _names(codes, stars)
        # a block has two symbols at least
        most = -(-cap // 2)
        if len(stars) <= base or len(stars) < 8:
            order, shared = _doubled(rank, most)
        else:
            order, shared = _recursed(rank, most, store, base)
    sorted_stars = stars[order]
    prefix = np.zeros(len(stars), np.int32)
    if len(stars) > 1:
        # shared names are shared blocks; what follows them is compared
        i = order[1:]
        known = stars[np.minimum(i + shared[1:], len(stars) - 1)] - stars[i]
        prefix[1:] = _extended(text, sorted_stars[:-1], sorted_stars[1:], known, cap)
    del shared, order
    up = _Induction(codes, cap, 0, symbols, store, place)
    words = up.preceding(sorted_stars)
    firsts = text[sorted_stars]
    present = np.flatnonzero(np.bincount(text, minlength=symbols)) if symbols <= 1 << 16 else np.unique(text)
    bounds = np.searchsorted(firsts, present, "left"), np.searchsorted(firsts, present, "right")
    kept = Queue(store, [place, np.int64, np.int32])
    edge: dict[int, int] = {}
    for c, a, b in zip(present.tolist(), *bounds):
        up.enter(c)
        last = -1
        for batch in up.queue.pop(c):
            kept.push(c, batch)
            up.scan(*batch)
            last = int(batch[0][-1])
        if last >= 0:
            edge[c] = last
        if b > a:
            value = prefix[a:b].copy()
            value[0] = _common(text, last, int(sorted_stars[a]), cap) if last >= 0 else 0
            up.scan(sorted_stars[a:b].astype(place), words[a:b], value)
    down = _Induction(codes, cap, 1, symbols, store, place)
    for c in present[::-1].tolist():
        down.enter(c)
        last = -1
        for batch in down.queue.pop(c):
            yield batch[0], batch[2]
            down.scan(*batch)
            last = int(batch[0][-1])
        link = _common(text, edge[c], last, cap) if last >= 0 and c in edge else 0
        for pos, ahead, prefix in kept.pop(c, backwards=True):
            # downwards the value stands beside the smaller of two neighbours
            value = np.append(link, prefix[:0:-1]).astype(np.int32)
            pos, ahead = pos[::-1], ahead[::-1]
            yield pos, value
            down.scan(pos, ahead, value)
            link = int(prefix[0])


def _recursed(rank: np.ndarray, most: int, store: Store, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Order and shared names of the string of names by induced sorting of it."""
    m = len(rank)
    names = store.array(m + 1, np.int64)
    present = np.unique(rank)
    names[:m] = np.searchsorted(present, rank) + 1
    order, shared = np.empty(m, np.int64), np.zeros(m, np.int64)
    at = m
    for pos, prefix in sorted_suffixes(names, most, store, base):
        for_here = pos.astype(np.int64)
        order[at - len(pos) : at] = for_here[::-1]
        # beside the larger of two neighbours: one place up
        up = np.arange(at, at - len(pos), -1)
        inside = up < m
        shared[up[inside]] = prefix[inside]
        at -= len(pos)
    return order, shared


def repeated(text: np.ndarray, length: int, memory: int = MEMORY, folder=None, base: int = BASE) -> np.ndarray:
    """Whether the ``length`` symbols from each position on also begin elsewhere."""
    store = Store(memory, folder)
    try:
        marks = store.array(len(text), np.bool_)
        before = -1
        for pos, prefix in sorted_suffixes(text, length, store, base):
            same = prefix >= length
            marks[pos[same]] = True
            marks[pos[:-1][same[1:]]] = True
            if same[0]:
                marks[before] = True
            before = int(pos[-1])
        return np.array(marks)
    finally:
        store.close()
