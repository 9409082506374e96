"""Periodic runs of words: dyadic blocks look for themselves in neighbouring windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetmart.llm.common import fresh, map_batches, mixed, text_slices, words

_QUERIES = 1 << 16
_CELLS = 1 << 20


class RangeSuccessor:
    """Wavelet tree over an array of places: the places of a range by rank and by bound.

    One bitmap a bit, from the highest down, with a count before every 64 bits; each level
    holds the values in stable order of the bits above it.
    """

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.maps, self.counts, self.zeros = [], [], []
        for b in reversed(range(self.bits)):
            ones = ((values >> b) & 1).astype(bool)
            size = 8 * (len(values) // 64 + 1)
            packed = np.zeros(size, dtype=np.uint8)
            raw = np.packbits(ones, bitorder="little")
            packed[: len(raw)] = raw
            bitmap = packed.view(np.uint64)
            counts = np.zeros(len(bitmap), dtype=np.int32)
            np.cumsum(np.bitwise_count(bitmap[:-1]), out=counts[1:])
            self.maps.append(bitmap)
            self.counts.append(counts)
            self.zeros.append(len(values) - int(ones.sum()))
            values = np.concatenate([values[~ones], values[ones]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.maps[level][word] & below)

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each range [lo, hi) are below its bound."""
        lo, hi = lo.copy(), hi.copy()
        found = np.zeros(len(lo), dtype=np.int64)
        over = bound >= (1 << self.bits)
        for level, b in enumerate(reversed(range(self.bits))):
            low1, high1 = self._ones(level, lo), self._ones(level, hi)
            one = ((bound >> b) & 1).astype(bool)
            low0, high0 = lo - low1, hi - high1
            found += np.where(one, high0 - low0, 0)
            lo = np.where(one, self.zeros[level] + low1, low0)
            hi = np.where(one, self.zeros[level] + high1, high0)
        return np.where(over, -1, found)

    def ranked(self, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of each range [lo, hi) with ``rank`` smaller ones before it."""
        lo, hi, rank = lo.copy(), hi.copy(), rank.copy()
        value = np.zeros(len(lo), dtype=np.int64)
        for level, b in enumerate(reversed(range(self.bits))):
            low1, high1 = self._ones(level, lo), self._ones(level, hi)
            low0, high0 = lo - low1, hi - high1
            zeros = high0 - low0
            one = rank >= zeros
            rank -= np.where(one, zeros, 0)
            lo = np.where(one, self.zeros[level] + low1, low0)
            hi = np.where(one, self.zeros[level] + high1, high0)
            value |= one.astype(np.int64) << b
        return value


def dyadic_groups(
    keys: np.ndarray, longest: int
) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Symbols, suffix array, and by level k the ranges of the blocks that occur again.

    Prefix doubling sorts the suffixes by their first 2**k symbols, only those not yet
    alone, up to blocks of ``longest`` symbols: below that the order decides nothing. A
    level lists (block start, range from, range to) for each block that starts at a
    multiple of 2**k and occurs elsewhere too.
    """
    n = len(keys)
    order = np.argsort(keys)
    new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    heads = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    rank = np.empty(n, dtype=np.int64)
    rank[order] = heads[group]
    symbols = np.empty(n, dtype=np.int64)
    symbols[order] = group
    size = np.zeros(n + 1, dtype=np.int64)
    size[heads] = np.diff(np.append(heads, n))
    levels, width = [], 1
    while width <= longest:
        starts = np.arange(0, n, width)
        starts = starts[size[rank[starts]] > 1]
        if not len(starts):
            break
        levels.append((starts, rank[starts], rank[starts] + size[rank[starts]]))
        if 2 * width > longest:
            break
        slots = np.flatnonzero(size[rank[order]] > 1)
        who = order[slots]
        after = np.where(who + width < n, rank[np.minimum(who + width, n - 1)] + 1, 0)
        key = rank[who] * (n + 1) + after
        by = np.argsort(key)
        who, key = who[by], key[by]
        order[slots] = who
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        counts = np.diff(np.append(first, len(who)))
        rank[who] = np.repeat(slots[first], counts)
        size[slots[first]] = counts
        width *= 2
    return symbols, order, levels


def _agree(s: np.ndarray, i: np.ndarray, j: np.ndarray, step: int = 1, most: int = 1 << 62) -> np.ndarray:
    """How many symbols are equal from places i and j on (i < j), forwards or backwards.

    It may go beyond ``most`` before it stops.
    """
    total = np.zeros(len(i), dtype=np.int64)
    active, width = np.arange(len(i)), 8
    while len(active):
        going = []
        for part in range(0, len(active), max(1, _CELLS // width)):
            who = active[part : part + max(1, _CELLS // width)]
            reach = (total[who, None] + np.arange(width)) * step
            a, b = i[who, None] + reach, j[who, None] + reach
            inside = (a >= 0) & (b < len(s))
            same = inside & (s[np.where(inside, a, 0)] == s[np.where(inside, b, 0)])
            more = np.where(same.all(axis=1), width, same.argmin(axis=1))
            total[who] += more
            going.append(who[(more == width) & (total[who] < most)])
        active, width = np.concatenate(going), min(2 * width, 1 << 16)
    return total


def _candidates(
    s: np.ndarray, tree: RangeSuccessor, p: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """(block start, period) of the blocks that recur within [width, 2 * width) places.

    The recurrences of a block in that window are one progression. With up to two, each is
    a candidate. Three or more with difference d lie in one stretch of period d, and so
    does the block: a longer period must carry the end of the block's stretch to the end of
    theirs, which leaves one candidate.
    """
    size = hi - lo
    below = tree.below(lo, hi, p + width)
    some = np.flatnonzero((below >= 0) & (below < size))
    p, lo, hi, size, below = p[some], lo[some], hi[some], size[some], below[some]

    def nth(k: int, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        who = who[below[who] + k < size[who]]
        at = tree.ranked(lo[who], hi[who], below[who] + k)
        near = at < p[who] + 2 * width
        return who[near], at[near]

    one, at1 = nth(0, np.arange(len(p)))
    two, at2 = nth(1, one)
    three, _ = nth(2, two)
    many = np.zeros(len(p), dtype=bool)
    many[three] = True
    first = np.zeros(len(p), dtype=np.int64)
    first[one] = at1
    second = np.zeros(len(p), dtype=np.int64)
    second[two] = at2
    single, pair = one[~many[one]], two[~many[two]]
    gap = second[three] - first[three]
    here = p[three] + gap + _agree(s, p[three], p[three] + gap, most=3 * width)
    there = first[three] + gap + _agree(s, first[three], first[three] + gap, most=3 * width)
    period = there - here
    fits = (
        (period >= width) & (period < 2 * width) & ((period - first[three] + p[three]) % gap == 0)
    )
    starts = np.concatenate([p[single], p[pair], p[three][fits]])
    periods = np.concatenate([first[single] - p[single], second[pair] - p[pair], period[fits]])
    return starts, periods


def _prime_factors(q: int) -> list[int]:
    found, f = [], 2
    while f * f <= q:
        if q % f == 0:
            found.append(f)
            while q % f == 0:
                q //= f
        f += 1
    return found + [q] * (q > 1)


def _smallest(s: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether no divisor of its period is a period of a stretch (of two periods at least)."""
    good = np.ones(len(start), dtype=bool)
    for q in np.unique(period):
        for f in _prime_factors(int(q)):
            who = np.flatnonzero((period == q) & good)
            d = int(q) // f
            # Enough to agree over one period, as the stretch repeats itself after it.
            good[who[_agree(s, start[who], start[who] + d, most=int(q)) >= q]] = False
    return good


def runs(keys: np.ndarray, longest: int, min_length: int = 6, exponent: int = 4) -> np.ndarray:
    """All runs (start, length, period) of a sequence of symbols, by start, then period.

    A run is a stretch with smallest period q, of at least ``min_length`` and ``exponent`` * q
    symbols (4 or more), which no neighbouring symbol extends. ``longest`` bounds the length
    of stretches. A run of period q in [w, 2w), w a power of two, holds an aligned block of w
    symbols with 3 * q symbols of the run after its start, and so do the aligned blocks that
    follow it up to there. Each recurs q further on; so those that share a period are joined
    to stretches, which are extended and tested.
    """
    if exponent < 4:
        raise ValueError(f"exponent must be 4 or more, got {exponent}")
    if len(keys) < min_length:
        return np.zeros((0, 3), dtype=np.int64)
    s, order, levels = dyadic_groups(keys, longest // exponent)
    tree = RangeSuccessor(order) if levels else None
    found = []
    for k, (starts, lo, hi) in enumerate(levels):
        width = 1 << k
        parts = [
            _candidates(s, tree, *(x[at : at + _QUERIES] for x in (starts, lo, hi)), width)
            for at in range(0, len(starts), _QUERIES)
        ]
        p = np.concatenate([x for x, _ in parts])
        q = np.concatenate([x for _, x in parts])
        if not len(p):
            continue
        by = np.lexsort((p, q))
        p, q = p[by], q[by]
        end = p + q + width
        # Stretches that share a whole period are one; ends grow with the starts of a period.
        new = np.concatenate([[True], (q[1:] != q[:-1]) | (p[1:] > end[:-1] - q[1:])])
        heads = np.flatnonzero(new)
        p, q, end = p[heads], q[heads], end[np.append(heads[1:], len(end)) - 1]
        end += _agree(s, end - q, end)
        p -= _agree(s, p - 1, p + q - 1, step=-1)
        long = end - p >= np.maximum(min_length, exponent * q)
        p, q, end = p[long], q[long], end[long]
        good = _smallest(s, p, q)
        found.append(np.stack([p, end - p, q], axis=1)[good])
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    return np.unique(np.concatenate(found), axis=0)


def _ordered(found: np.ndarray) -> np.ndarray:
    return found[np.lexsort((found[:, 2], found[:, 0]))]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapse(column: pa.Array, min_length: int, exponent: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Words, runs and collapsed text of each row."""
    data, starts, ends, hashes, first = words(column)
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    # Words of different rows are different symbols: no block recurs in another row.
    keys = mixed(hashes ^ mixed(row.astype(np.uint64) + np.uint64(1)))
    found = _ordered(runs(keys, int(counts.max(initial=0)), min_length, exponent))
    where = row[found[:, 0]] if len(found) else np.zeros(0, dtype=np.int64)

    edge = np.zeros(len(keys) + 1, dtype=np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    # A kept word takes the white space byte after it along, unless it is its row's last.
    last = np.append(row[kept][1:] != row[kept][:-1], True) if len(kept) else np.zeros(0, bool)
    mask = np.zeros(len(data) + 2, dtype=np.int32)
    mask[starts[kept]] += 1
    mask[ends[kept] + ~last] -= 1  # places differ, as ends do
    text = data[np.cumsum(mask[: len(data)]) > 0].copy()
    text[(text == 0x20) | ((text >= 0x09) & (text <= 0x0D))] = 0x20
    sizes = np.bincount(row[kept], (ends[kept] - starts[kept]) + ~last, minlength=len(counts))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    collapsed = pa.StringArray.from_buffers(
        len(counts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(text.tobytes())
    )
    places = np.searchsorted(where, np.arange(len(counts) + 1)).astype(np.int32)
    begin = first[where] if len(where) else np.zeros(0, dtype=np.int64)
    values = [pa.array(found[:, c] - (begin if c == 0 else 0), pa.int64()) for c in range(3)]
    listed = pa.ListArray.from_arrays(
        pa.array(places), pa.StructArray.from_arrays(values, fields=list(_RUN))
    )
    return pa.array(counts, pa.int64()), listed, collapsed


def periodic_runs(
    docs: DataFrame, text: str = "text", *, min_length: int = 6, exponent: int = 4
) -> DataFrame:
    """``docs`` plus n_words, the periodic runs of words, and the text without repeats.

    Adds _n_words long, _runs array of (start, length, period) by start, then period, and
    _collapsed string (with more underscores where ``docs`` has such a column). Words are
    ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of words with smallest period
    q and at least ``min_length`` and ``exponent`` * q words, which no neighbouring word
    extends; ``exponent`` is 4 or more. _collapsed joins by one space the words that no run
    contains after its first q words.

    One row out for every row in, repeated rows included: no row moves. A null text has no
    words, no runs and an empty _collapsed. Texts are handled whole: about 1 MB of them at a
    time or one longer text, with memory in proportion to it. Words are compared by 64-bit
    hashes.
    """
    names = fresh(docs, "n_words", "runs", "collapsed")
    run_type = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    added = (T.LongType(), T.ArrayType(run_type), T.StringType())
    schema = T.StructType(
        docs.schema.fields + [T.StructField(n, t) for n, t in zip(names, added, strict=True)]
    )

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text):
                made = _collapse(part.column(text), min_length, exponent)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *made], names=[*part.schema.names, *names]
                )

    return map_batches(docs, run, schema)
