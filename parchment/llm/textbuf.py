"""Vectorised views of Arrow string columns: whole batches of texts as one UTF-8 buffer.

Every function works on ``(buf, off)``: all texts' bytes, one after the other, and the offsets of
their ends, so numpy sees a batch of documents as one array and no Python code runs per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1_000_000

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
#: Random 64-bit value of each byte, so that hashes are not sums of small numbers.
BYTE_CODE = _rng.integers(1, 2**64 - 1, 256, dtype=U64)
BASE = U64(0x9E3779B97F4A7C15)
BASE_INV = U64(pow(int(BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}

#: Bytes of words: ASCII letters and digits, and all bytes of characters outside ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[128:] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    WORD_BYTE[_a:_b] = True


def chunks(col: pa.Array, max_bytes: int = CHUNK_BYTES, lower: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, buf, off) of consecutive rows with at most max_bytes (or one row); null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    n, i = len(col), 0
    if not n:
        return
    wide = np.int64 if pa.types.is_large_string(col.type) else np.int32
    off, data = _buffers(col, wide)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
        if lower:  # only what is in hand is copied
            o, d = _buffers(pc.utf8_lower(col.slice(i, j - i)), wide)
        else:
            o, d = off[i : j + 1], data
        yield i, d[o[0] : o[-1]], o.astype(np.int64) - int(o[0])
        i = j
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers live on after a stage, and others need it then."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def _buffers(col: pa.Array, wide: type) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array."""
    _, b_off, b_data = col.buffers()
    off = np.frombuffer(b_off, wide)[col.offset : col.offset + len(col) + 1]
    return off, np.frombuffer(b_data, np.uint8) if b_data is not None else np.zeros(0, np.uint8)


def powers(base: str, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = 1 << max(16, (n - 1).bit_length())
        got = np.full(size, BASE if base == "up" else BASE_INV, U64)
        got[0] = 1
        got = np.cumprod(got, dtype=U64)
        _powers[base] = got
    return got[:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """P with P[e]-P[s] the polynomial of bytes s..e-1, still scaled by BASE**s."""
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum(BYTE_CODE[buf] * powers("up", len(buf)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    return mix((prefix[end] - prefix[start]) * powers("down", len(prefix))[start])


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of every word; no word crosses two texts."""
    m = WORD_BYTE[buf]
    before = np.empty_like(m)
    before[:1] = False
    before[1:] = m[:-1]
    cut = off[:-1][off[:-1] < len(buf)]
    fresh = np.zeros(len(buf), bool)
    fresh[cut] = True
    start = np.flatnonzero(m & (~before | fresh))
    after = np.empty_like(m)
    after[-1:] = False
    after[:-1] = m[1:]
    last = np.zeros(len(buf), bool)
    last[cut[cut > 0] - 1] = True
    last[-1:] = True
    end = np.flatnonzero(m & (~after | last)) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Indices at which a run of equal values begins in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
