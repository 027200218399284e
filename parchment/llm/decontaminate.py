"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

A CGK walk reads a string with random steps: it emits the byte it stands on, and then stays or moves on by a random
bit that depends on the step and the byte; 2 * size steps read the string, and zeros follow its end.  Strings at
a small edit distance fall into step again after each edit, so their embeddings are at a small Hamming
distance.  A bit sample keeps SAMPLED emitted bytes at random places of the whole embedding as a key.

1. Where windows begin.  An item is cut into two pieces more than edits are allowed, so a match has two of them
   unchanged, at most as far out of line as edits are allowed.  Pieces are looked up at every byte of the texts, whatever
   the script.  Two pieces of an item size that stand so open a window of that size where the item would begin.
   This loses nothing: it says where to look, not what is there.
2. Windows meet items.  Every window is embedded whole by each of WALKS walks, each walk has SETS bit samples, and a
   window and an item of its size that agree in one of the WALKS * SETS keys are candidates.
3. Candidates are verified by bit-parallel edit distance over the window and a margin; a match is at most EDITS of the
   item's bytes away.

At distance 0 recall is 1: equal windows have equal embeddings.  Measured recall at EDITS, by kind of item, is in the README.

Items are the query set: they are read in blocks of bounded size.  One block is sent to all workers; where there are
more, documents pass once for each block, and results of a block are written before the next one is sent.

Texts are compared as UTF-8 bytes without ASCII case.  Edge cases: null and empty texts match nothing; null or
empty items match nothing; an item of one character matches only a text that equals it.  Equal items are
all reported, with their ids (null too).  Repeated rows give repeated results.  Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.llm.common import cut, fresh
from parchment.llm.textbuf import BYTE_CODE, U64, chunks, mix, prefix_hash, span_hash

EDITS = 0.1
WALKS, SETS, SAMPLED = 16, 12, 3
#: Steps after which a walk's random bits are used again.
PERIOD = 1021
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 8 << 20
#: Emitted bytes, and piece hits, that are held at once.
EMBEDDED_AT_ONCE, HITS_AT_ONCE = 32 << 20, 2_000_000
MATCHES = "array<struct<item_id:bigint,start:bigint,end:bigint,distance:int>>"
_FILTER_BITS = 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.Generator(np.random.PCG64(977))
#: Whether a walk moves on, by step, walk and byte.
_MOVES = _random.integers(0, 2, (PERIOD, WALKS * 256), dtype=np.uint8)
#: Where a bit sample looks, as a share of the embedding, by walk, set and sample.
_LOOKS = _random.random((WALKS, SETS, SAMPLED))


def allowed(size: int) -> int:
    """Edits that a match of an item of so many bytes may have."""
    return int(EDITS * size)


def cuts(size: int) -> tuple[int, range]:
    """(length, places) of an item's pieces: two more than edits are allowed, or the whole item where none is."""
    n = allowed(size) + 2 if allowed(size) else 1
    return size // n, range(0, size // n * n, size // n)


def keys(buf: np.ndarray, start: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """WALKS * SETS keys of each window: bytes start to end of buf, followed by zeros up to its size."""
    out = np.empty((len(start), WALKS, SETS), U64)
    order, done = np.argsort(size, kind="stable"), 0
    while done < len(order):
        # windows of like sizes together, so many that their embeddings fit
        last = np.searchsorted(2 * WALKS * size[order[done:]] * np.arange(1, len(order) - done + 1), EMBEDDED_AT_ONCE, "right")
        part = order[done : done + max(int(last), 1)]
        out[part] = _keys(buf, start[part], end[part], size[part])
        done += len(part)
    return out.reshape(len(start), -1)


def _keys(buf: np.ndarray, start: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    n, steps = len(start), 2 * int(size.max())
    padded = np.concatenate((buf, np.zeros(1, np.uint8)))
    at, stop = np.repeat(start, WALKS), np.repeat(end, WALKS)
    lane = np.tile(np.arange(WALKS) * 256, n)
    emitted = np.empty((steps, n * WALKS), np.uint8)
    for j in range(steps):
        b = padded[np.minimum(at, len(buf))]
        b[at >= stop] = 0
        emitted[j] = b
        at += _MOVES[j % PERIOD][lane + b]
    looks = (_LOOKS[None] * (2 * size)[:, None, None, None]).astype(np.int64)  # windows, walks, sets, samples
    seen = BYTE_CODE[emitted[looks, (np.arange(n)[:, None] * WALKS + np.arange(WALKS))[:, :, None, None]]]
    key = np.broadcast_to(size.astype(U64)[:, None, None], looks.shape[:3]) * U64(WALKS * SETS) + np.arange(WALKS * SETS, dtype=U64).reshape(WALKS, SETS)
    for k in range(SAMPLED):
        key = mix(key ^ seen[..., k])
    return key


class Pieces:
    """Unchanged pieces of one length, looked up at every byte of a chunk."""

    def __init__(self, length: int, found: list[tuple[bytes, int, int]]):
        self.length = length
        found = sorted(set(found))  # (piece, size of its item, place in it): equal pieces of many items are one
        buf = np.frombuffer(b"".join(g for g, _, _ in found), np.uint8)
        at = np.arange(len(found)) * length
        key = span_hash(prefix_hash(buf), at, at + length)
        order = np.argsort(key, kind="stable")
        self.key, self.size, self.place = key[order], np.array([x for _, x, _ in found])[order], np.array([x for _, _, x in found])[order]
        self.some = np.zeros(1 << _FILTER_BITS, bool)
        self.some[(key >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def hits(self, prefix: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray]:
        """(text index, size, where the item would begin, place of the piece) of occurrences, some at a time."""
        at = np.arange(max(len(prefix) - self.length, 0))
        key = span_hash(prefix, at, at + self.length)
        at = np.flatnonzero(self.some[(key >> U64(64 - _FILTER_BITS)).astype(np.int64)])
        key = key[at]
        low, high = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        doc = np.searchsorted(off, at, "right") - 1
        good = np.flatnonzero((high > low) & (at + self.length <= off[doc + 1]))
        at, low, doc, n = at[good], low[good], doc[good], (high - low)[good]
        total = np.cumsum(n)
        a = 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(total, total[a] + HITS_AT_ONCE, "right")))
            m = n[a:b]
            k = np.repeat(low[a:b], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            p, d = np.repeat(at[a:b], m), np.repeat(doc[a:b], m)
            yield np.stack((d, self.size[k], p - off[d] - self.place[k], p))
            a = b


def in_line(hits: np.ndarray, most: int) -> np.ndarray:
    """Of hits in a row of texts, windows (text index, size, begin) where two pieces stand as a match's would."""
    d, size, begin, at = hits
    order = np.lexsort((begin, size, d))
    d, size, begin, at = d[order], size[order], begin[order], at[order]
    edits = (EDITS * size).astype(np.int64)
    close = (d[1:] == d[:-1]) & (size[1:] == size[:-1]) & (begin[1:] - begin[:-1] <= edits[1:])
    keep = edits == 0
    keep[1:] |= close
    keep[:-1] |= close
    if len(at):  # the partner may be among the hits before or after these
        keep |= (at < at.min() + most) | (at > at.max() - most)
    return np.unique(np.stack((d, size, begin))[:, keep], axis=1)


class Items:
    """Pieces and keys of one block of items."""

    def __init__(self, ids: list[int | None], texts: list[bytes]):
        self.ids = ids
        self.texts = [_LOWER[np.frombuffer(x, np.uint8)].tobytes() for x in texts]
        self.single: dict[bytes, list[int]] = {}
        pieces: dict[int, list[tuple[bytes, int, int]]] = {}
        for k, x in enumerate(self.texts):
            if len(x.decode()) == 1:
                self.single.setdefault(x, []).append(k)
                continue
            length, places = cuts(len(x))
            pieces.setdefault(length, []).extend((x[p : p + length], len(x), p) for p in places)
        self.pieces = [Pieces(*x) for x in sorted(pieces.items())]
        self.longest = max(map(len, self.texts), default=0)
        size = np.array([len(x) for x in self.texts], np.int64)
        end = np.cumsum(size)
        key = keys(np.frombuffer(b"".join(self.texts), np.uint8), end - size, end, size).ravel()
        order = np.argsort(key, kind="stable")
        self.key, self.item = key[order], (order // (WALKS * SETS)).astype(np.int32)

    def __len__(self) -> int:
        return len(self.ids)

    def candidates(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of every two that agree in a key, once."""
        key = keys(buf, start, end, size).ravel()
        low, high = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        n = high - low
        k = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        window = np.repeat(np.arange(len(key)) // (WALKS * SETS), n)
        both = np.unique(window * len(self) + self.item[k])
        return both // len(self), both % len(self)


def edit_search(pattern: bytes, text: bytes, anchored: bool = False) -> tuple[int, int]:
    """(least edit distance of pattern to a substring of text, where that substring ends); anchored: to a prefix."""
    m, full = len(pattern), (1 << len(pattern)) - 1
    places: dict[int, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    up, down, score, best, end = full, 0, m, m, 0
    top = 1 << (m - 1)
    for j, c in enumerate(text):
        eq = places.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq
        eq |= down
        plus, minus = down | ~(across | up), up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 | anchored, minus << 1
        up, down = (minus | ~(eq | plus)) & full, plus & eq & full
        if score < best:
            best, end = score, j + 1
    return best, end


def verify(item: bytes, text: bytes, guess: int) -> tuple[int, int, int] | None:
    """(start, end, distance) of the item in text near guess, if near enough."""
    m = len(item)
    if guess >= 0 and text[guess : guess + m] == item:
        return guess, guess + m, 0
    most = allowed(m)
    low = max(guess - most, 0)
    part = text[low : guess + m + most]
    length, places = cuts(m)
    held = (p for p in places if item[p : p + length] in part)
    if next(held, None) is None or (most and next(held, None) is None):  # a match has two of its pieces unchanged
        return None
    distance, end = edit_search(item, part)
    if distance > most:
        return None
    _, size = edit_search(item[::-1], part[:end][::-1], True)
    start = low + end - size
    if distance and start != guess:  # the margin may have cut a better match off
        better = verify(item, text, start)
        if better and better[2] < distance:
            return better
    return start, low + end, distance


def find(items: Items, buf: np.ndarray, off: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
    """(item, start, end, distance) of the matches by text index; at most one where matches of an item overlap."""
    buf = _LOWER[buf]
    prefix = prefix_hash(buf)
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    windows = [in_line(h, 2 * items.longest) for p in items.pieces for h in p.hits(prefix, off)]
    del prefix
    d, size, begin = np.unique(np.concatenate(windows, axis=1), axis=1) if windows else np.zeros((3, 0), np.int64)
    if len(d):
        start = off[d] + np.maximum(begin, 0)
        # windows that begin before their text are as long as what lies in it
        window, item = items.candidates(buf, start, np.minimum(off[d] + begin + size, off[d + 1]), size)
        d, begin = d[window], begin[window]
        order = np.lexsort((begin, item, d))
        text, last, until = b"", (-1, -1), -1
        for d_, i_, g_ in zip(d[order].tolist(), item[order].tolist(), begin[order].tolist(), strict=True):
            if last != (d_, i_):
                if last[0] != d_:
                    text = buf[off[d_] : off[d_ + 1]].tobytes()
                last, until = (d_, i_), -1
            if g_ < until:  # inside the last match
                continue
            if got := verify(items.texts[i_], text, g_):
                until = got[1]
                rows = found.setdefault(d_, [])
                if not any(r[0] == i_ and r[1] < got[1] and got[0] < r[2] for r in rows):
                    rows.append((i_, *got))
    if items.single:
        sizes = np.diff(off)
        for d_ in np.flatnonzero((sizes <= 4) & (sizes > 0)).tolist():
            for i_ in items.single.get(buf[off[d_] : off[d_ + 1]].tobytes(), ()):
                found.setdefault(d_, []).append((i_, 0, int(sizes[d_]), 0))
    return found


def matcher(sent):
    """Arrow function text -> MATCHES for one block of items, which was sent."""
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("distance", pa.int32())]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = sent.value
        for texts in batches:
            out: list[list] = [[] for _ in range(len(texts))]
            for first, buf, off in chunks(texts):
                for d, rows in find(items, buf, off).items():
                    out[first + d] = [{"item_id": items.ids[i], "start": s, "end": e, "distance": n} for i, s, e, n in sorted(rows, key=lambda r: (r[1], r[0]))]
            yield pa.array(out, kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Items]:
    """The benchmark's items in blocks; the driver holds one block at a time."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(F.col(key).cast("long"), F.col(text)).where(F.length(text) > 0).toLocalIterator():
        data = r[1].encode()
        if ids and (len(ids) >= BLOCK_ITEMS or size + len(data) > BLOCK_BYTES):
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r[0])
        texts.append(data)
        size += len(data)
    if ids:
        yield Items(ids, texts)


def _passes(docs: DataFrame, benchmark: DataFrame, text: str, after) -> DataFrame:
    """docs after each block's pass: after(docs, its matches) one by one, written if another pass follows."""
    spark, queue = docs.sparkSession, blocks(benchmark)
    block = next(queue, None)
    while block is not None:
        following = next(queue, None)
        sent = spark.sparkContext.broadcast(block)  # BLOCK_ITEMS and BLOCK_BYTES bound it
        docs = after(docs, F.arrow_udf(matcher(sent), MATCHES)(F.col(text)))
        if following is not None:
            docs = cut(docs, "matched")
            sent.destroy()
        block = following
    return docs


def with_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "matches") -> DataFrame:
    """docs with out: the benchmark passages in each text (MATCHES, offsets in bytes)."""
    kept = [F.col(c) for c in docs.columns if c.lower() != out.lower()]
    tmp = fresh(docs, "__matches")
    rows = docs.withColumn(tmp, F.array().cast(MATCHES))
    rows = _passes(rows, benchmark, text, lambda d, found: d.withColumn(tmp, F.concat(F.col(tmp), found)))
    return rows.select(*kept, F.col(tmp).alias(out))


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, start, end, distance): one row for each passage found."""
    rows = with_matches(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("t")), benchmark, "t").drop("t")
    return rows.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.start", "m.end", "m.distance")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """docs without those that hold a benchmark passage."""
    return _passes(docs, benchmark, text, lambda d, found: d.where(F.size(found) == 0))
