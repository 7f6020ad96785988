"""Words and word n-grams of Arrow string columns as numpy arrays of 64-bit hashes.

A column is hashed in blocks that end between words, so the memory in use is bounded by
the block size (or by one word, where that is longer). A hash depends on the word's bytes
alone, so equal words get equal hashes on every executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20            # bytes hashed at a time


def _byte_table(separators, lower: bool) -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0] = 0xFF              # 0 marks separators; U+0000 stands as a byte that UTF-8 never has
    if lower:
        t[65:91] += 32
    t[list(separators)] = 0
    return t


_PLAIN = [0x20, *range(0x09, 0x0E)]
SPACED = _byte_table(_PLAIN, True)           # words [^\x20\x09-\x0D]+, A-Z lowered
SPACED_CASED = _byte_table(_PLAIN, False)
ALNUM = _byte_table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61),
                     *range(0x7B, 0x80)], True)   # letters, digits and all non-ASCII

_RNG = np.random.default_rng(20240)
_BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTES[0] = 0
_STEP, _GRAM_STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(step: int, n: int, inverse: bool = False) -> np.ndarray:
    """step**0 .. step**(n-1) modulo 2**64, or their inverses."""
    key = (step, inverse)
    have = _powers.get(key)
    if have is None or len(have) < n:
        base = pow(step, -1, 1 << 64) if inverse else step
        a = np.full(max(n, 1024), base, dtype=np.uint64)
        a[0] = 1
        _powers[key] = have = np.cumprod(a, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def column_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the row offsets into them; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks != 1 else col.chunk(0)
    col = col.fill_null("")
    big = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64 if big else np.int32)
    off = off[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


class Words:
    """Hash, start and end byte of each word; words of row i are ``row[i]:row[i+1]``."""

    def __init__(self, col, table: np.ndarray = SPACED, prefixes: tuple[int, ...] = ()):
        raw, off = column_bytes(col)
        self.raw, self.off = raw, off
        parts, heads = [], []
        pos, end = 0, len(raw)
        while pos < end:
            stop = self._cut(raw, off, table, pos, end)
            s, e, h, p = self._block(raw, off, table, pos, stop, prefixes)
            parts.append((s, e, h))
            heads.append(p)
            pos = stop
        if parts:
            self.start, self.end, self.hash = (np.concatenate(x) for x in zip(*parts))
            self.prefix = [np.concatenate([p[i] for p in heads]) for i in range(len(prefixes))]
        else:
            self.start = self.end = np.empty(0, np.int64)
            self.hash = np.empty(0, np.uint64)
            self.prefix = [np.empty(0, np.uint64) for _ in prefixes]
        self.row = np.searchsorted(self.start, off)

    @staticmethod
    def _cut(raw, off, table, pos, end):
        """End of the block that starts at ``pos``: between rows or at a separator."""
        if end - pos <= BLOCK:
            return end
        last = off[np.searchsorted(off, pos + BLOCK, "right") - 1]
        if last > pos:
            return int(last)
        gap = np.flatnonzero(table[raw[pos:pos + BLOCK]] == 0)
        if len(gap):
            return pos + int(gap[-1]) + 1
        row_end = int(off[np.searchsorted(off, pos, "right")])
        while pos + BLOCK < row_end:
            pos += BLOCK
            gap = np.flatnonzero(table[raw[pos:min(pos + BLOCK, row_end)]] == 0)
            if len(gap):
                return pos + int(gap[0]) + 1
        return row_end

    @staticmethod
    def _block(raw, off, table, pos, stop, prefixes):
        b = table[raw[pos:stop]]
        inside = b != 0
        edge = np.empty(len(b) + 1, dtype=bool)          # a word may not run over a row's start
        edge[0], edge[-1] = True, True
        np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
        lo, hi = np.searchsorted(off, [pos, stop])
        rows = off[lo:hi] - pos
        edge[rows[(rows >= 0) & (rows < len(b))]] = True
        at = np.flatnonzero(edge)
        keep = inside[at[:-1]]
        s, e = at[:-1][keep], at[1:][keep]
        sums = np.empty(len(b) + 1, dtype=np.uint64)
        sums[0] = 0
        v = _BYTES[b]
        v *= _power(_STEP, len(b))
        np.cumsum(v, out=sums[1:])
        back = _power(_STEP, len(b), True)[s]
        first = sums[s]
        h = mix((sums[e] - first) * back)
        p = [mix((sums[np.minimum(s + n, e)] - first) * back ^ np.uint64(n * 0x51ED2701))
             for n in prefixes]
        return s + pos, e + pos, h, p


def grams(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of the n words from each position on (positions 0 .. len(h) - n)."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    if n == 1:
        return mix(h ^ np.uint64(salt + 1))
    sums = np.empty(len(h) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(h * _power(_GRAM_STEP, len(h)), out=sums[1:])
    g = (sums[n:] - sums[:-n]) * _power(_GRAM_STEP, len(h), True)[:len(h) - n + 1]
    return mix(g ^ np.uint64((salt + n) * 0x2545F4914F6CDD1D & (1 << 64) - 1))


def row_slices(off: np.ndarray, limit: int = 8 << 20):
    """Ranges of rows of about ``limit`` bytes each (one row at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
