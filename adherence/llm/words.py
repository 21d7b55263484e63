"""Words, word hashes and shingle hashes of whole Arrow text columns, in numpy.

A text is never cut: hashes are taken over windows of words of a few MB, so that memory beside the
column itself is a few dozen bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_WINDOW = 1 << 21
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words that are separated by white space only, and of words of letters and digits.
SPACED = ~_SPACE
ALNUM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def _powers(x: int) -> np.ndarray:
    out = np.ones(_WINDOW, U)
    n = 1
    while n < _WINDOW:
        out[n:2 * n] = out[:n] * U(pow(x, n, 1 << 64))
        n *= 2
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal inputs only give equal outputs."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class _Tables:
    """Built once in each worker: powers of the base and a random value for each byte (A-Z as a-z)."""

    def __init__(self):
        self.up, self.down = _powers(_BASE), _powers(_BASE_INV)
        byte = np.arange(256)
        byte[65:91] += 32
        self.byte = mix((byte.astype(U) + U(1)) * U(0xD6E8FEB86659FD93))


_tables: _Tables | None = None


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (one more than rows) of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    a = pc.fill_null(col.cast(pa.large_string()), "")
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = a.buffers()
    off = np.frombuffer(offsets, np.int64)[a.offset:a.offset + len(a) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(col, limit: int = 1 << 22):
    """(first row, end row) of consecutive slices of about ``limit`` bytes, one row at least."""
    n = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64))
    at = 0
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(n, (n[at - 1] if at else 0) + limit, "right")))
        yield at, end
        at = end


class Words:
    """The words of a text column: starts, ends (byte offsets), hashes, and ``first[i]:first[i + 1]``
    the words of row i."""

    def __init__(self, col, word_bytes: np.ndarray = SPACED):
        global _tables
        if _tables is None:
            _tables = _Tables()
        self.raw, self.offsets = column_bytes(col)
        raw, off = self.raw, self.offsets
        inside = word_bytes[raw]
        begins, finishes = inside.copy(), inside.copy()
        if len(raw):
            begins[1:] &= ~inside[:-1]
            finishes[:-1] &= ~inside[1:]
            edge = off[(off > 0) & (off < len(raw))]  # a word ends with its row
            begins[edge] = inside[edge]
            finishes[edge - 1] = inside[edge - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, off)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        t, out, at = _tables, np.empty(len(self.starts), U), 0
        while at < len(out):
            base = self.starts[at]
            end = max(at + 1, int(np.searchsorted(self.ends, base + _WINDOW, "right")))
            if self.ends[at] - base > _WINDOW:  # one word beyond the window: by blocks
                out[at] = self._long(base, self.ends[at])
                at += 1
                continue
            region = t.byte[self.raw[base:self.ends[end - 1]]]
            region *= t.up[:len(region)]
            sums = np.concatenate(([U(0)], np.cumsum(region, dtype=U)))
            s, e = self.starts[at:end] - base, self.ends[at:end] - base
            out[at:end] = (sums[e] - sums[s]) * t.down[s]
            at = end
        return mix(out)

    def _long(self, start: int, end: int) -> int:
        t, total, scale = _tables, 0, 1
        for at in range(start, end, _WINDOW):
            block = t.byte[self.raw[at:min(end, at + _WINDOW)]]
            total += int((block * t.up[:len(block)]).sum(dtype=U)) * scale
            scale = scale * pow(_BASE, _WINDOW, 1 << 64) % (1 << 64)
        return U(total % (1 << 64))

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, keep: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of every run of ``max(keep) + 1`` words inside one row, hashed over the
        words at the kept places."""
        span, n = max(keep) + 1, len(self.hashes)
        if n < span:
            return np.zeros(0, np.int64), np.zeros(0, U)
        rows = self.rows()
        pos = np.flatnonzero(rows[span - 1:] == rows[:n - span + 1])
        total = np.zeros(n - span + 1, U)
        for k in keep:
            total += self.hashes[k:n - span + 1 + k] * U(pow(0xC2B2AE3D27D4EB4F, 2 * k + 1, 1 << 64))
        return pos, mix(total[pos])


def shingle_sets(w: Words, k: int) -> list[np.ndarray]:
    """Of each row, the sorted distinct hashes of its ``k``-word shingles; with fewer words the whole
    sequence is one shingle; without words the set is empty."""
    pos, hashes = w.grams(list(range(k)))
    bounds = np.searchsorted(pos, w.first)
    out = []
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if b > a:
            out.append(np.unique(hashes[a:b]))
        else:
            own = w.hashes[w.first[i]:w.first[i + 1]]
            n = U(len(own))
            total = sum((int(h) * pow(0xC2B2AE3D27D4EB4F, 2 * j + 1, 1 << 64) for j, h in enumerate(own)), int(n) * 0x165667B19E3779F9)
            out.append(mix(np.array([total % (1 << 64)], U)) if len(own) else np.zeros(0, U))
    return out
