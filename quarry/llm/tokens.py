"""Vectorised word hashing of Arrow text batches, for use inside Spark tasks.

A word's hash is a polynomial over per-byte random values, taken from one running sum
over the bytes, then mixed; no Python loop runs over words.  Texts are handled in pieces
of about two megabytes, so memory does not depend on the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 21
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2D          # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_fold = np.arange(256)
_fold[65:91] += 32
BYTE_LOWER = BYTE[_fold]            # A-Z counted as a-z
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self):
        self.pow = self.inv = np.ones(0, dtype=np.uint64)

    def upto(self, n: int):
        if self.pow.size < n:
            inverse = pow(_BASE, -1, 1 << 64)
            size = max(n, PIECE + 1)
            for name, base in (("pow", _BASE), ("inv", inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.pow, self.inv


POWERS = _Powers()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return flat, offsets


def _cut(data: np.ndarray, offsets: np.ndarray, pos: int, end: int) -> int:
    """Where the piece from ``pos`` ends: at a row's end if there is one near, else after a blank."""
    stop = min(pos + PIECE, end)
    if stop == end:
        return end
    row_end = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
    if row_end > pos:
        return row_end
    row_end = int(offsets[np.searchsorted(offsets, pos, "right")])
    while stop < row_end:
        blank = np.flatnonzero(~IS_WORD[data[pos:stop]])
        if blank.size:
            return pos + int(blank[-1]) + 1
        stop = min(stop + PIECE, row_end)
    return row_end


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False,
                spans: bool = False):
    """Hashes of all words in order, and where each row's words begin (rows + 1 values).

    With ``spans`` also the byte positions where words start and end.
    """
    byte = BYTE_LOWER if lower else BYTE
    hashes, starts_all, ends_all = [], [], []
    pos, end = int(offsets[0]), int(offsets[-1])
    while pos < end:
        stop = _cut(data, offsets, pos, end)
        seg = data[pos:stop]
        inside = IS_WORD[seg]
        first = np.searchsorted(offsets, pos, "left")
        last = np.searchsorted(offsets, stop, "left")
        edges = offsets[first:last] - pos          # rows that begin in this piece
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        start[edges] = inside[edges]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:]
        before = edges[edges > 0] - 1
        finish[before] = inside[before]
        s, e = np.flatnonzero(start), np.flatnonzero(finish) + 1
        power, inverse = POWERS.upto(seg.size + 1)
        total = np.zeros(seg.size + 1, dtype=np.uint64)
        np.cumsum(byte[seg] * power[: seg.size], out=total[1:])
        hashes.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)))
        starts_all.append(s + pos)
        ends_all.append(e + pos)
        pos = stop
    empty = np.zeros(0, dtype=np.int64)
    begin = np.concatenate(starts_all) if starts_all else empty
    h = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    rows = np.searchsorted(begin, offsets, "left")
    if spans:
        return h, rows, begin, (np.concatenate(ends_all) if ends_all else empty)
    return h, rows


_SLOT = mix(np.arange(1000, 1064, dtype=np.uint64)) | np.uint64(1)


def gram_hashes(h: np.ndarray, offsets_in_gram) -> np.ndarray:
    """Hash of the words at the given offsets from each position; the last span-1 positions are cut off."""
    span = max(offsets_in_gram) + 1
    n = max(0, h.size - span + 1)
    out = np.zeros(n, dtype=np.uint64)
    for slot, d in enumerate(offsets_in_gram):
        out += h[d: d + n] * _SLOT[slot]
    return mix(out)


# fixed value: ASCII marks that count as blanks where only letters and digits matter
MARKS = np.zeros(256, dtype=bool)
MARKS[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


def bare_word_hashes(column: pa.Array):
    """As ``word_hashes``, in lower case and with marks counted as blanks."""
    data, offsets = buffers(column)
    data = data.copy()
    data[MARKS[data]] = 32
    return word_hashes(data, offsets, lower=True)


def pieces(batch: pa.RecordBatch, n_bytes: int = 4 << 20):
    """The batch in slices of whole rows of about ``n_bytes`` of text."""
    offsets = buffers(batch.column("text"))[1]
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + n_bytes, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi
