"""CRC-32 of many substrings of one byte stream from its running CRCs.

The register of a CRC is linear over GF(2): with R(p) the register after p bytes, the substring
[s, e) alone gives R(e) xor R(s) shifted by e - s zero bytes, since what lies before s cancels.
"""

from __future__ import annotations

import zlib

import numpy as np

POLY = 0xEDB88320                   # fixed value: the reflected CRC-32 polynomial
ONES = np.uint32(0xFFFFFFFF)
STRIDE = 256                        # bytes whose registers run side by side


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLY), t >> 1).astype(np.uint32)
    return t


STEP = _byte_table()


def _zero_byte(x: np.ndarray) -> np.ndarray:
    return STEP[x & np.uint32(255)] ^ (x >> np.uint32(8))


def _short_shifts() -> np.ndarray:
    """[length, byte of the register, its value], flat: the register after ``length`` zero bytes."""
    out = np.empty((STRIDE, 4, 256), dtype=np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, STRIDE):
        out[n] = _zero_byte(out[n - 1])
    return out.ravel()


SHORT = _short_shifts()


def _apply(flat: np.ndarray, at, x: np.ndarray) -> np.ndarray:
    """The shift whose table starts at ``at`` of ``flat``, on every register of ``x``."""
    low = np.uint32(255)
    return (flat[at + (x & low)] ^ flat[at + 256 + ((x >> np.uint32(8)) & low)]
            ^ flat[at + 512 + ((x >> np.uint32(16)) & low)] ^ flat[at + 768 + (x >> np.uint32(24))])


def _long_shifts() -> list[np.ndarray]:
    """Tables of STRIDE, 2 * STRIDE, 4 * STRIDE... zero bytes, each the one before it twice."""
    one = _zero_byte(SHORT[-1024:])
    out = [one]
    for _ in range(32):
        out.append(_apply(out[-1], 0, out[-1]))
    return out


LONG = _long_shifts()


def shift(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers ``x`` after ``n`` zero bytes each."""
    out = _apply(SHORT, (n % STRIDE) * 1024, x)
    rest, k = n // STRIDE, 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        out[odd] = _apply(LONG[k], 0, out[odd])
        rest, k = rest >> 1, k + 1
    return out


def registers(stream: np.ndarray, at: np.ndarray) -> np.ndarray:
    """R(p) for each p of ``at``: the register, zero at first, after the first p bytes of ``stream``.

    Strides of the stream run side by side from zero; the register at a stride's begin comes from
    one running CRC over the strides, and both are added up where ``at`` asks.
    """
    n = -(-stream.size // STRIDE) + 1
    padded = np.zeros(n * STRIDE, dtype=np.uint8)
    padded[: stream.size] = stream
    columns = np.ascontiguousarray(padded.reshape(n, STRIDE).T).astype(np.uint32)
    local = np.zeros((STRIDE + 1, n), dtype=np.uint32)
    for j in range(STRIDE):
        local[j + 1] = _zero_byte(local[j] ^ columns[j])
    begins, v, view = np.empty(n, dtype=np.uint32), int(ONES), memoryview(padded)
    for k in range(n):
        begins[k] = v
        v = zlib.crc32(view[k * STRIDE: (k + 1) * STRIDE], v)
    begins ^= ONES
    block, inside = at // STRIDE, at % STRIDE
    return shift(begins[block], inside) ^ local[inside, block]


def substring_crc(r_start: np.ndarray, r_end: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC-32 of substrings of length ``n`` from the registers at their start and end."""
    return r_end ^ shift(r_start ^ ONES, n) ^ ONES
