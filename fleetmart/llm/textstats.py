"""Counts and hashed byte n-grams of text columns, a whole batch at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from fleetmart.llm.common import mixed, words

SYMBOLS = "#*$%&|<>"
_GAPS = " \t\n\x0b\x0c\r"


def _marked(chars: str | bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars.encode("ascii") if isinstance(chars, str) else chars)] = True
    return out


_SYMBOL, _UPPER = _marked(SYMBOLS), _marked(bytes(range(65, 91)))
_HEAD = ~_marked(bytes(range(0x80, 0xC0)))  # the first byte of a character


@dataclass
class Stats:
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    n_upper: np.ndarray
    n_bytes: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated(hashes: np.ndarray, first: np.ndarray, n: int = 3) -> np.ndarray:
    """Words of each row in windows of n words that the row holds twice or more."""
    counts = np.diff(first)
    grams = np.maximum(counts - n + 1, 0)
    total = int(grams.sum())
    if not total:
        return np.zeros(len(counts), dtype=np.int64)
    row = np.repeat(np.arange(len(counts)), grams)
    at = np.arange(total) - np.repeat(np.cumsum(grams) - grams, grams) + first[:-1][row]
    value = mixed(row.astype(np.uint64) + np.uint64(1))
    for k in range(n):
        value = mixed(value * np.uint64(31) + hashes[at + k])
    order = np.argsort(value)
    ranked = value[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(total, dtype=bool)
    twice[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    found = at[twice]
    np.add.at(edge, found, 1)
    np.add.at(edge, found + n, -1)
    return _per_row(np.cumsum(edge[:-1]) > 0, first)


def stats(column: pa.Array) -> Stats:
    """Counts per row; a null text counts as empty."""
    column = column.cast(pa.large_string())
    data, starts, ends, hashes, first = words(column)
    texts = column.to_pylist()
    sizes = [len(t.encode("utf-8")) if t is not None else 0 for t in texts]
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)
    heads = np.concatenate([[0], np.cumsum(_HEAD[data], dtype=np.int64)])
    chars = np.concatenate([[0], np.cumsum(heads[ends] - heads[starts])])
    repeats = []
    for text in texts:
        lines = [x for x in text.split("\n") if x.strip(_GAPS)] if text else []
        repeats.append(len(lines) - len(set(lines)))
    return Stats(
        n_words=np.diff(first),
        word_chars=chars[first[1:]] - chars[first[:-1]],
        n_symbols=_per_row(_SYMBOL[data], offsets),
        n_dup_lines=np.asarray(repeats, dtype=np.int64),
        n_repeat_words=_repeated(hashes, first),
        n_upper=_per_row(_UPPER[data], offsets),
        n_bytes=np.diff(offsets),
        data=data,
        offsets=offsets,
    )


def byte_grams(
    data: np.ndarray, offsets: np.ndarray, n: int, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte n-grams (n up to 4), and where each row's begin.

    A row of fewer than n bytes has none.
    """
    if len(data) < n:
        return np.zeros(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
    wide = data.astype(np.uint32)
    value = wide[: len(data) - n + 1].copy()
    for k in range(1, n):
        value |= wide[k : len(data) - n + 1 + k] << np.uint32(8 * k)
    value = (value * np.uint32(0x9E3779B1)) ^ (value >> np.uint32(15))
    value = (value * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)
    whole = np.ones(len(value), dtype=bool)  # not across the border of two rows
    for k in range(1, n):
        borders = offsets[1:-1] - k
        whole[borders[(borders >= 0) & (borders < len(value))]] = False
    counts = np.maximum(np.diff(offsets) - n + 1, 0)
    return value[whole].astype(np.int64), np.concatenate([[0], np.cumsum(counts)])


def mean_of(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Mean per row, 0 for a row without values; sums don't depend on the batch."""
    n = np.diff(begins)
    out = np.zeros(len(n), dtype=np.float64)
    some = np.flatnonzero(n)
    if len(some):
        out[some] = np.add.reduceat(values, begins[:-1][some]) / n[some]
    return out
