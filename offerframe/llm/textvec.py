"""Words, characters and their hashes for a whole slice of texts at once.

Every function works on the bytes of many texts laid end to end plus the
start of each text, so a task spends its time in numpy, not in a loop over
words.  Hashes are 64-bit: a polynomial over per-byte random values (taken
from prefix sums, so a word's length does not matter) and a final mixing.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def byte_set(members: bytes, inverse: bool = False) -> np.ndarray:
    """256 flags, one per byte value."""
    out = np.zeros(256, bool)
    out[list(members)] = True
    return ~out if inverse else out


NOT_SPACE = byte_set(SPACES, inverse=True)
# [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing: digits, a-z, and all of a multi-byte character.
ALNUM = byte_set(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        one = np.ones(1, U64)
        _POWERS[:] = [np.cumprod(np.concatenate([one, np.full(size - 1, b, U64)])) for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit hashes (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, members: np.ndarray = NOT_SPACE):
    """Start and end byte of every word (maximal run of member bytes inside one
    text), and for each text the number of its first word (n + 1 entries)."""
    n = len(data)
    inside = members[data]
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    edge = offsets[offsets < n]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edge[edge > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class ByteHash:
    """Hash of any byte range of one slice, from one pass over its bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, self.inverse = _powers(n + 1)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(_byte_values()[data] * power[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(U64))


_STEPS = [U64(pow(0xD1342543DE82EF95, k + 1, 1 << 64)) for k in range(16)]


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int):
    """Hashes of all `width`-word windows, text after text.

    A text with fewer words (but one at least) has its whole sequence as its
    only window.  Returns the hashes and each text's first window (n + 1).
    """
    counts = np.diff(first)
    windows = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(windows)])
    out = np.empty(begin[-1], U64)
    if len(words) >= width:
        run = np.zeros(len(words) - width + 1, U64)
        for k in range(width):
            run += words[k:len(words) - width + 1 + k] * _STEPS[k]
        full = np.flatnonzero(counts >= width)
        if len(full):
            lens = windows[full]
            where = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
            out[where + np.repeat(begin[full], lens)] = run[where + np.repeat(first[full], lens)]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        part = words[first[i]:first[i + 1]]
        short = len(part)
        for k, w in enumerate(part):
            short += (int(w) ^ 0xA5A5A5A5A5A5A5A5) * int(_STEPS[8 + k])
        out[begin[i]] = U64(short & 0xFFFFFFFFFFFFFFFF)
    return mix(out), begin


def characters(data: np.ndarray, offsets: np.ndarray):
    """One 32-bit code per character (its UTF-8 bytes) and each text's first character."""
    if len(data) == 0:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[at].astype(np.uint32)
    width = np.diff(np.append(at, len(data)))
    for k in (1, 2, 3):
        more = np.flatnonzero(width > k)
        code[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return code, np.searchsorted(at, offsets)


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each text's values (0 for a text without any)."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]
