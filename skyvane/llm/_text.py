"""Vectorised word segmentation and hashing over Arrow string columns.

Everything works on the UTF-8 bytes of a batch with numpy, in blocks of about
``BLOCK`` bytes that end at a document end or at white space, so memory is
bounded whatever the size of a document. Words are maximal runs of bytes
outside a separator class; ASCII separators never occur inside a multi-byte
UTF-8 sequence, so byte runs equal character runs.
"""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
U64 = np.uint64

# [\x20\x09-\x0D]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
# everything but ASCII letters and digits and non-ASCII bytes
NON_WORD = np.ones(256, bool)
NON_WORD[48:58] = NON_WORD[65:91] = NON_WORD[97:123] = NON_WORD[128:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = np.full(n, base, U64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=U64)


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = powers(_BASE, n), powers(_INV, n)
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def lean_memory() -> None:
    """Once per worker: freed blocks of a megabyte or more go back to the system at once. Workers outlive their
    tasks, and what the C library and Arrow keep for reuse adds up over a pipeline's stages."""
    if sys.__dict__.get("_lean_memory"):
        return
    sys.__dict__["_lean_memory"] = True
    pa.set_memory_pool(pa.system_memory_pool())
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:                            # glibc: M_MMAP_THRESHOLD, M_TRIM_THRESHOLD
        mallopt(-3, 1 << 20)
        mallopt(-1, 1 << 20)


def buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    lean_memory()
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def blocks(data: np.ndarray, off: np.ndarray, sep: np.ndarray, size: int = BLOCK):
    """Cut points so that no word (run outside ``sep``) is cut. Yields byte ranges."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + size)
        while hi < n:
            k = np.searchsorted(off, hi, "right") - 1      # last document end at or before hi
            if off[k] > lo and off[k] > hi - (size >> 1):
                hi = int(off[k])
                break
            gap = np.flatnonzero(sep[data[max(lo, hi - 4096):hi]])
            if len(gap):
                hi = max(lo, hi - 4096) + int(gap[-1]) + 1
                break
            hi = min(n, hi + size)
        yield lo, hi
        lo = hi


def spans(data: np.ndarray, off: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in one block; ``off`` are document starts
    inside the block (a word never runs over one)."""
    word = ~sep[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    end = word.copy()
    end[:-1] &= ~word[1:]
    inner = off[(off > 0) & (off < len(data))]
    start[inner] |= word[inner]
    end[inner - 1] |= word[inner - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the Latin-1 letters (two bytes, C3 80-9E but for the sign C3 97)."""
    out = LOWER[data]
    if len(data) > 1:
        up = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][up] += np.uint8(32)
    return out


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``hash_at`` reads the hash of any span."""
    up, _ = _POWERS.get(len(data) + 1)
    c = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=c[1:])
    return c


def hash_at(c: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, independent of its place."""
    _, down = _POWERS.get(len(c))
    return mix((c[e] - c[s]) * down[s] + (e - s).astype(U64))


def span_hash(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    return hash_at(prefix_sums(data), s, e)


class Words:
    """Hashes of all words of a batch, in order; ``first[d]:first[d+1]`` are document d's."""

    def __init__(self, data: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE, lower: bool = False,
                 keep_spans: bool = False) -> None:
        hs, ss, es = [], [], []
        for lo, hi in blocks(data, off, sep):
            part = data[lo:hi]
            k0, k1 = np.searchsorted(off, lo, "right"), np.searchsorted(off, hi, "left")
            s, e = spans(part, off[k0:k1] - lo, sep)
            hs.append(span_hash(LOWER[part] if lower else part, s, e))
            ss.append(s + lo)
            if keep_spans:
                es.append(e + lo)
        self.hash = np.concatenate(hs) if hs else np.zeros(0, U64)
        self.start = np.concatenate(ss) if ss else np.zeros(0, np.int64)
        self.end = np.concatenate(es) if es else np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, off, "left")

    def __len__(self) -> int:
        return len(self.hash)


def ngram_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of h[i:i+n] for every i (positions whose window leaves ``h`` are left out)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = np.zeros(m, U64)
    for j in range(n):
        out *= U64(_BASE)
        out += h[j:j + m]
    return mix(out + U64(n))


def doc_groups(off: np.ndarray, size: int = BLOCK):
    """Ranges of consecutive documents of about ``size`` bytes (one long document stands alone)."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
