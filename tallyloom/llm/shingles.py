"""Hashes of words and word shingles of whole texts, a block of rows at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WORDS = 5
BLOCK_BYTES = 1 << 19
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_UNBASE = _U(pow(int(_BASE), -1, 1 << 64))
_STEP = _U(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[str, np.ndarray] = {}


def _table(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _TABLES.get(name)
    if have is None or len(have) < n:
        made = _powers(base, max(n, BLOCK_BYTES + 1))
        if n > 4 * BLOCK_BYTES:  # one very long text: not kept
            return made
        _TABLES[name] = have = made
    return have


@dataclass
class Words:
    """Words of a block: their hash, and the row each belongs to; ordered by place."""

    hashes: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def words_of(raw: np.ndarray, bounds: np.ndarray, lower: bool = True) -> Words:
    """Words divided by ASCII white space; `lower` folds A-Z. Words never run across rows."""
    n = len(raw)
    solid = np.zeros(n + 1, bool)
    np.logical_not(_SPACE[raw], out=solid[:n])
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:]
    starts = np.flatnonzero(begins)
    stops = np.zeros(n + 1, bool)
    stops[1:] = solid[:-1] & (~solid[1:] | edge[1:])
    ends = np.flatnonzero(stops)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER if lower else _BYTE)[raw] * _table("up", _BASE, n)[:n], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * _table("down", _UNBASE, n + 1)[starts])
    return Words(hashes, np.searchsorted(bounds, starts, "right") - 1, starts, ends)


def shingles_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) pairs, distinct and sorted: five consecutive words, or all words of a shorter text."""
    words = words_of(raw, bounds)
    h, rows = words.hashes, words.rows
    steps = _powers(_STEP, WORDS)
    parts_r, parts_s = [], []
    if len(h) >= WORDS:
        last = len(h) - WORDS + 1
        whole = rows[:last] == rows[WORDS - 1:]
        total = np.zeros(last, np.uint64)
        for k in range(WORDS):
            total += h[k:k + last] * steps[k]
        parts_r.append(rows[:last][whole])
        parts_s.append(mixed(total[whole]))
    counts = np.bincount(rows, minlength=len(bounds) - 1)
    firsts = np.cumsum(counts) - counts
    for n in range(1, WORDS):
        short = np.flatnonzero(counts == n)
        total = np.full(len(short), n, np.uint64)
        for k in range(n):
            total += h[firsts[short] + k] * steps[k]
        parts_r.append(short)
        parts_s.append(mixed(total))
    r, s = np.concatenate(parts_r), np.concatenate(parts_s)
    order = np.lexsort((s, r))
    r, s = r[order], s[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
    return r[new], s[new]
