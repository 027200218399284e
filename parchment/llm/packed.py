"""Named numpy arrays as one compressed value, so that millions of small records cross a shuffle in few rows."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa


def _planes(v: np.ndarray) -> bytes:
    """An array's bytes by place: first bytes of all numbers, then second ones, so that like bytes lie together."""
    v = np.ascontiguousarray(v)
    return v.view(np.uint8).reshape(-1, v.itemsize).T.tobytes() if v.itemsize > 1 else v.tobytes()


def dump(**arrays: np.ndarray) -> bytes:
    head = json.dumps([[k, v.dtype.str, len(v)] for k, v in arrays.items()]).encode()
    raw = struct.pack("<I", len(head)) + head + b"".join(map(_planes, arrays.values()))
    return struct.pack("<Q", len(raw)) + pa.compress(raw, "zstd", asbytes=True)


def load(blob: bytes) -> dict[str, np.ndarray]:
    (size,) = struct.unpack_from("<Q", blob)
    raw = pa.decompress(blob[8:], size, "zstd", asbytes=True)
    (n,) = struct.unpack_from("<I", raw)
    out, at = {}, 4 + n
    for k, kind, length in json.loads(raw[4 : 4 + n]):
        wide = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, length * wide, at).reshape(wide, length)
        out[k] = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
        at += length * wide
    return out


def joined(blobs: Iterable[bytes], like: dict[str, str]) -> dict[str, np.ndarray]:
    """All blobs' arrays, one after the other; like has the types of empty ones."""
    parts = [load(b) for b in blobs]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, t) for k, t in like.items()}


def dealt(bucket: np.ndarray, **arrays: np.ndarray) -> pa.RecordBatch:
    """(bucket, blob) rows: one for each bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    which, at = np.unique(bucket[order], return_index=True)
    ends = np.append(at[1:], len(order))[: len(at)]
    blobs = [dump(**{k: v[order[a:b]] for k, v in arrays.items()}) for a, b in zip(at, ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])


BLOBS = "bucket int, blob binary"
