"""Word shingles of whole texts, computed on the UTF-8 bytes of a batch.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D`` after A-Z is
lower-cased; a document's set holds the distinct hashes of its five-word
shingles, or one hash of the whole sequence when it has one to four words.
A null or wordless text has the empty set. All work is numpy over blocks of
whole documents, so memory is bounded by the block size or the longest text.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
#: text hashed at once; the working arrays take about 50 times as much
BLOCK_BYTES = 1 << 18
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))
_STEP = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                  0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=_U)
_SHORT = np.arange(WORDS, dtype=_U) * _U(0x8EBC6AF09C88C6E3)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (in a copy)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class _Powers:
    """Powers of the polynomial base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                a = np.full(n, base, _U)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` (uint8) whose documents begin at
    ``starts`` (ascending, first 0), and the number of words of each."""
    n = len(data)
    if n == 0:
        return np.empty(0, _U), np.zeros(len(starts), np.int64)
    low = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    inside = ~((low == 32) | ((low >= 9) & (low <= 13)))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = starts[(starts < n)]
    first[edge] = inside[edge]
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.empty(0, _U), np.zeros(len(starts), np.int64)
    up, down = _POWERS.get(n + 1)
    low = low.astype(_U)
    low += _U(1)
    low *= inside
    low *= up[:n]
    total = np.empty(n + 1, _U)
    total[0] = 0
    np.cumsum(low, out=total[1:])
    # between two begins only bytes of the first word add to the sum
    ends = np.append(begin[1:], n)
    h = (total[ends] - total[begin]) * down[begin]
    which = np.searchsorted(begin, np.append(starts, n))
    return mix(h), np.diff(which)


def shingle_hashes(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes (repeats kept) and their number per document."""
    per = np.where(counts >= WORDS, counts - WORDS + 1, (counts > 0).astype(np.int64))
    at = np.concatenate(([0], np.cumsum(counts)))
    out_at = np.concatenate(([0], np.cumsum(per)))
    out = np.empty(int(out_at[-1]), _U)
    if len(words) >= WORDS:
        m = len(words) - WORDS + 1
        five = words[:m] * _STEP[0]
        for k in range(1, WORDS):
            five += words[k:k + m] * _STEP[k]
        full = np.flatnonzero(counts >= WORDS)
        # positions of the shingles that lie inside one document
        pos = np.arange(int(per[full].sum())) + np.repeat(
            at[full] - np.concatenate(([0], np.cumsum(per[full])))[:-1], per[full])
        dst = np.arange(len(pos)) + np.repeat(
            out_at[full] - np.concatenate(([0], np.cumsum(per[full])))[:-1], per[full])
        out[dst] = five[pos]
    for d in np.flatnonzero((counts > 0) & (counts < WORDS)):
        w = words[at[d]:at[d + 1]]
        out[out_at[d]] = (w * _STEP[:len(w)]).sum(dtype=_U) ^ _SHORT[len(w)]
    return mix(out), per


def blocks(column, limit: int = BLOCK_BYTES):
    """Yield (first row, data uint8, starts) for runs of whole documents of an
    Arrow string column; null texts count as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offs[row]:offs[end]], offs[row:end] - offs[row]
        row = end


def sets(column):
    """Yield, row by row, the sorted distinct shingle hashes of each text."""
    for _, data, starts in blocks(column):
        s, per = shingle_hashes(*word_hashes(data, starts))
        at = np.concatenate(([0], np.cumsum(per)))
        for d in range(len(starts)):
            yield np.unique(s[at[d]:at[d + 1]])
