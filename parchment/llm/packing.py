"""Lexical retrieval packing: windows of related documents, with no padding.

Documents are dealt to shards of bounded size by what they say.  CLUSTERS centroids, fitted on a bounded sample, name a
document's subject; within a subject documents are ordered by their heaviest term among those that another document
has, and cut into shards by bytes at sampled splitters.  So related documents and copies meet in a shard, and a group
too large for one is split.  This steers where documents meet, never what is packed; it is integer arithmetic, so a
task that runs again deals as before.

A shard builds a BM25 inverted index of its documents; the statistics that BM25 weighs terms with (document
frequencies, mean length) are of all documents.  A seed document opens a window; the index returns its best unused
neighbours over all of its terms, which fill the window greedily, the last one being cut at the window's end and opening
the next window with its rest.  Without a neighbour that shares a term, the next unused document follows.  The rest of
a shard's last window is cut into sequences whose lengths are powers of two, which need no padding, so no shard pads.

Terms are words without case, hashed into 2**18 slots.  Neighbours come from the seed's shard only; the README has what
share of the whole corpus's best ones that is.

Edge cases.  A null or empty text is the single end id.  A null id is kept; its row sorts first.  Rows that
repeat an id are separate documents; ties in score go to the earlier row by id, then by text.  An empty table
gives no pieces.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import tasks_for
from parchment.llm.textbuf import U64, chunks, mix, prefix_hash, run_starts, span_hash, words
from parchment.llm.tokens import Encoder

WINDOW = 2048
END_ID = 1
SLOTS_LOG2 = 18
SLICE = 1 << 14
SHARD_BYTES = 8 << 20
#: Neighbours that are found at first; a window takes few, and more are ranked when it asks.
FIRST = 16
#: Terms of more than an eighth of a shard's documents that are kept as rows of weights, and weights in all of them.
COMMON, COMMON_WEIGHTS = 256, 4 << 20
#: Bytes of text that are encoded at once; more share more pieces.
ENCODED_AT_ONCE = 2_000_000
#: Subjects, dimensions of the vectors that they are told by, and documents that their centroids are fitted on.
CLUSTERS, DIMENSIONS, FIT_ROWS = 64, 512, 4096
#: Documents whose place in the order is collected for splitters, and ranges that splitters cut at most.
SPLIT_ROWS, RANGES = 25_000, 4096
#: Bits of an order key below the subject: heaviest term, hash of the row, and a salt that splits equal rows.
HASH_BITS, SALT_BITS = 28, 10
K1, B = 1.2, 0.75
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Sequence ids of a shard are shard * SHARD_IDS and up.
SHARD_IDS = 1 << 32


def term_counts(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, slot, occurrences) of every distinct term, sorted by text and slot; words of each text."""
    start, end, doc = words(buf, off)
    slot = span_hash(prefix_hash(buf), start, end) >> U64(64 - SLOTS_LOG2)
    keys = np.sort((doc.astype(U64) << U64(SLOTS_LOG2)) | slot)
    at = run_starts(keys)
    count = np.diff(np.append(at, len(keys)))
    keys = keys[at].astype(np.int64)
    return keys >> SLOTS_LOG2, keys & ((1 << SLOTS_LOG2) - 1), count, np.bincount(doc, minlength=len(off) - 1)


def statistics(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int, int, int]:
    """(document frequency by slot, documents, words, bytes) over all documents.

    Each task sums its own documents; sums meet in slices, so nothing grows with the number of documents.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, totals = np.zeros(1 << SLOTS_LOG2, np.int64), np.zeros(3, np.int64)
        for batch in batches:
            for _, buf, off in chunks(batch.column(0), lower=True):
                _, slot, _, n_words = term_counts(buf, off)
                df += np.bincount(slot, minlength=len(df))
                totals += (len(off) - 1, int(n_words.sum()), len(buf))
        if totals[0]:
            parts = [*df.reshape(-1, SLICE), np.concatenate((totals, np.zeros(SLICE - 3, np.int64)))]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], ["part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got[part] = got.get(part, 0) + np.frombuffer(sums, np.int64)
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int32()), pa.array([x.tobytes() for x in got.values()], pa.binary())], ["part", "sums"])

    kind = "part int, sums binary"
    n = (1 << SLOTS_LOG2) // SLICE + 1
    sums = docs.select(text).mapInArrow(count, kind).repartition(n, "part").mapInArrow(add, kind)
    df, totals = np.zeros(1 << SLOTS_LOG2, np.int64), np.zeros(3, np.int64)
    for r in sums.collect():  # n rows of SLICE numbers
        if r["part"] == n - 1:
            totals = np.frombuffer(r["sums"], np.int64)[:3]
        else:
            df[r["part"] * SLICE : (r["part"] + 1) * SLICE] = np.frombuffer(r["sums"], np.int64)
    return df, *(int(x) for x in totals)


class Index:
    """BM25 over one shard: postings by slot, and by document for exact scores."""

    def __init__(self, doc: np.ndarray, slot: np.ndarray, count: np.ndarray, length: np.ndarray, idf: np.ndarray, mean: float):
        self.n = len(length)
        local = np.bincount(slot, minlength=1 << SLOTS_LOG2)
        shared = local[slot] > 1  # a term of one document finds nobody
        doc, slot, count = doc[shared], slot[shared], count[shared].astype(np.float32)
        norm = (K1 * (1 - B + B * length / max(mean, 1e-9))).astype(np.float32)
        weight = idf[slot] * count * np.float32(K1 + 1) / (count + norm[doc])
        del count, shared
        # as given, by document and slot
        self.slot, self.own_at = slot.astype(np.int32), np.searchsorted(doc, np.arange(self.n + 1))
        # terms that many documents have are rows of weights, the others lists
        common = np.flatnonzero(local > self.n // 8)
        common = common[np.argsort(-local[common], kind="stable")][: min(COMMON, COMMON_WEIGHTS // max(self.n, 1))]
        self.common = np.full(1 << SLOTS_LOG2, -1, np.int32)
        self.common[common] = np.arange(len(common))
        here = self.common[slot] >= 0
        self.rows = np.zeros((len(common), self.n), np.float32)
        self.rows[self.common[slot[here]], doc[here]] = weight[here]
        doc, slot, weight = doc[~here], slot[~here], weight[~here]
        order = np.argsort(slot, kind="stable")
        self.doc, self.weight = doc[order].astype(np.int64), weight[order].astype(float)  # as sums want them
        self.at = np.concatenate(([0], np.cumsum(np.bincount(slot, minlength=1 << SLOTS_LOG2))))

    def scores(self, seed: int) -> np.ndarray:
        """Every document's score over all of the seed's terms, added in one order, so that equal documents tie."""
        terms = self.slot[self.own_at[seed] : self.own_at[seed + 1]]
        common = self.common[terms]
        terms = terms[common < 0]
        low, n = self.at[terms], self.at[terms + 1] - self.at[terms]
        k = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.doc[k], self.weight[k], self.n) + self.rows[common[common >= 0]].sum(axis=0)

    def compact(self, unused: np.ndarray) -> None:
        """Drop postings of used documents, which nothing asks for again."""
        keep = unused[self.doc]
        self.at = np.concatenate(([0], np.cumsum(keep)))[self.at]
        self.doc, self.weight = self.doc[keep], self.weight[keep]

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents by falling score; few are asked for, so more than FIRST are ranked only when it is so."""
        score = self.scores(seed)
        score *= unused
        some, own = None, score
        while True:
            n = len(own)
            least = np.partition(own, n - FIRST)[n - FIRST] if n > FIRST else 0
            best = np.flatnonzero(own >= least) if least > 0 else np.flatnonzero(own)
            found = best[np.argsort(-own[best], kind="stable")]
            yield from (found if some is None else some[found]).tolist()
            if least <= 0:
                return
            rest = np.flatnonzero((own < least) & (own > 0))
            some, own = rest if some is None else some[rest], own[rest]


class Order:
    """The order in which documents are dealt to shards."""

    def __init__(self, idf: np.ndarray, mean: float, df: np.ndarray, most: int):
        self.idf, self.mean = idf, mean
        self.shared = (df > 1) & (df <= max(most, 2))  # terms that bring few enough documents together
        self.centroids = np.zeros((1, DIMENSIONS))

    def _weighed(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text index, slot, weight in whole numbers) of a chunk's terms."""
        doc, slot, count, length = term_counts(buf, off)
        weight = self.idf[slot] * count * (K1 + 1) / (count + K1 * (1 - B + B * length[doc] / max(self.mean, 1e-9)))
        return doc, slot, np.rint(16 * weight).astype(np.int64)

    def _vectors(self, doc: np.ndarray, slot: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        h = mix(slot.astype(U64) + U64(1))
        sign = 1 - 2 * ((h >> U64(40)) & U64(1)).astype(np.int64)
        return np.bincount(doc * DIMENSIONS + (h % U64(DIMENSIONS)).astype(np.int64), sign * weight, n * DIMENSIONS).reshape(n, DIMENSIONS)

    def vectors(self, texts: pa.Array) -> np.ndarray:
        return np.concatenate([self._vectors(*self._weighed(buf, off), len(off) - 1) for _, buf, off in chunks(texts, lower=True)] or [np.zeros((0, DIMENSIONS))])

    def fit(self, vectors: np.ndarray, rounds: int = 8) -> None:
        """Centroids by spherical k-means, begun at evenly spaced rows; in whole numbers, so dot products are exact."""
        some = vectors[np.abs(vectors).sum(1) > 0]
        if not len(some):
            return
        some = some / np.linalg.norm(some, axis=1, keepdims=True)
        found = some[np.linspace(0, len(some) - 1, min(CLUSTERS, len(some))).astype(int)]
        for _ in range(rounds):
            own = (some @ found.T).argmax(1)
            sums = np.stack([some[own == i].sum(0) if (own == i).any() else found[i] for i in range(len(found))])
            found = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        chain, rest = [0], set(range(1, len(found)))
        while rest:  # like subjects follow one another, as shards may hold several
            near = max(rest, key=lambda i: (float(found[i] @ found[chain[-1]]), -i))
            rest.remove(near)
            chain.append(near)
        self.centroids = np.rint(1000 * found[chain])

    def keys(self, texts: pa.Array, row: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Order key of every text."""
        out = []
        for first, buf, off in chunks(texts, lower=True):
            n = len(off) - 1
            doc, slot, weight = self._weighed(buf, off)
            subject = (self._vectors(doc, slot, weight, n) @ self.centroids.T).argmax(1)
            term = np.zeros(n, np.int64)
            best = np.where(self.shared[slot], weight, -1) * (1 << SLOTS_LOG2) + slot
            some = run_starts(doc)
            term[doc[some]] = np.maximum.reduceat(best, some) & ((1 << SLOTS_LOG2) - 1) if len(some) else 0
            own = slice(first, first + n)
            route = subject.astype(np.int64) << SLOTS_LOG2 | term
            out.append((route << HASH_BITS | row[own] & ((1 << HASH_BITS) - 1)) << SALT_BITS | salt[own])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def splitters(keys: np.ndarray, sizes: np.ndarray, parts: int) -> np.ndarray:
    """parts - 1 keys that cut a sample of documents into shares of like size."""
    order = np.argsort(keys, kind="stable")
    upto = np.cumsum(sizes[order])
    at = np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts) if len(order) else np.zeros(0, np.int64)
    return keys[order][np.minimum(at, len(order) - 1)]


def shard_of(keys: np.ndarray, cuts: np.ndarray, each: int) -> np.ndarray:
    """Shard of every key: its range, and its route's share of it; a route with a cut inside is shared out by row."""
    at = np.searchsorted(cuts, keys, "right")
    if each == 1:
        return at
    route = keys >> (HASH_BITS + SALT_BITS)
    ends = np.concatenate(([-1], cuts >> (HASH_BITS + SALT_BITS), [-1]))
    large = (route == ends[at]) | (route == ends[at + 1])
    return at * each + (mix(np.where(large, keys, route).astype(U64)) % U64(each)).astype(np.int64)


def plan(lengths: np.ndarray, index: Index, window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece."""
    unused = np.ones(len(lengths), bool)
    sequence, offset, following = 0, 0, 0
    last: list[tuple[int, int, int]] = []  # pieces of the open window
    left, compacted = len(lengths), len(lengths)
    queue: Iterator[int] = iter(())
    while True:
        current = next((x for x in queue if unused[x]), -1)
        if current < 0:
            while following < len(lengths) and not unused[following]:
                following += 1
            if following == len(lengths):
                break
            current = following
        unused[current] = False
        left -= 1
        at, size = 0, int(lengths[current])
        opened = offset == 0
        while at < size:
            n = min(size - at, window - offset)
            last.append((current, at, n))
            at, offset = at + n, offset + n
            if offset == window:
                o = 0
                for d, s, k in last:
                    yield d, s, k, sequence, o
                    o += k
                last, offset, sequence = [], 0, sequence + 1
                opened = True
        if opened and offset:  # it began this window, whole or with its rest
            if left < 0.85 * compacted:
                index.compact(unused)
                compacted = left
            queue = index.neighbours(current, unused)
        elif not offset:
            queue = iter(())
    # what is left of the last window, in powers of two
    bit = window >> 1
    while last:
        while bit > offset:
            bit >>= 1
        o = 0
        while o < bit:
            d, s, k = last[0]
            n = min(k, bit - o)
            yield d, s, n, sequence, o
            o += n
            last[0] = (d, s + n, k - n)
            if n == k:
                last.pop(0)
        offset, sequence = offset - bit, sequence + 1


def pack_shard(table: pa.Table, idf: np.ndarray, mean: float, json_path: str, rank_path: str) -> pa.Table:
    """One shard's documents (doc_id, text, shard) -> its pieces."""
    order = pc.sort_indices(table.select(["doc_id", "text"]), [("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")
    texts, ids = table.column("text").take(order).combine_chunks(), table.column("doc_id").take(order).combine_chunks()
    shard = table.column("shard")[0].as_py()
    del table
    encoder = _encoder(json_path, rank_path)
    parts, sizes = [], []
    for _, buf, off in chunks(texts, ENCODED_AT_ONCE):
        got, ends = encoder.encode(buf, off)
        n = np.diff(ends)
        out = np.full(len(got) + len(n), END_ID, "<u4")
        out[np.arange(len(got)) + np.repeat(np.arange(len(n)), n)] = got
        parts.append(out)
        sizes.append(n + 1)
    flat, sizes = np.concatenate(parts), np.concatenate(sizes)
    del parts
    terms = []
    for first, buf, off in chunks(texts, lower=True):
        d, s, c, n = term_counts(buf, off)
        terms.append(((d + first).astype(np.int32), s.astype(np.int32), c.astype(np.int32), n))
    del texts
    index = Index(*(np.concatenate(x) for x in zip(*terms, strict=True)), idf, mean)
    del terms
    cols = np.array(list(plan(sizes, index)), np.int64).reshape(-1, 5)
    where = (np.cumsum(sizes) - sizes)[cols[:, 0]] + cols[:, 1]
    view = memoryview(flat).cast("B")
    crc = np.fromiter((zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(where.tolist(), (where + cols[:, 2]).tolist(), strict=True)), np.int64, len(cols))
    return pa.table({"doc_id": ids.take(pa.array(cols[:, 0])), "start": cols[:, 1], "length": cols[:, 2], "ids_crc32": crc, "doc_tokens": sizes[cols[:, 0]].astype(np.int64), "sequence_id": shard * SHARD_IDS + cols[:, 3], "offset": cols[:, 4]})


def dealt(rows: DataFrame, df: np.ndarray, idf: np.ndarray, mean: float, n_docs: int, shards: int) -> tuple[DataFrame, int]:
    """rows (doc_id, text) with the shard of each, and how many shards there are."""
    if shards == 1:
        return rows.withColumn("shard", F.lit(0)), 1
    order = Order(idf, mean, df, -(-n_docs // shards))
    h = F.xxhash64("doc_id", "text")
    few = lambda n: rows.where(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(1 << 30)) < int(min(1.2 * n / n_docs, 1) * (1 << 30)))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.astype("<i4").tobytes() for x in order.vectors(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["h", "v"])

    # at most FIT_ROWS vectors
    got = few(FIT_ROWS).select(h.alias("h"), "text").mapInArrow(vectors, "h long, v binary").limit(FIT_ROWS).toArrow().sort_by("h").column("v").to_pylist()
    order.fit(np.frombuffer(b"".join(got), "<i4").reshape(-1, DIMENSIONS).astype(float))

    def key(texts: pa.Array, row: pa.Array, salt: pa.Array) -> pa.Array:
        return pa.array(order.keys(texts, row.to_numpy(), salt.to_numpy()))

    key.__annotations__ = {"texts": pa.Array, "row": pa.Array, "salt": pa.Array, "return": pa.Array}
    salt = F.pmod(F.xxhash64("i"), F.lit(1 << SALT_BITS))

    def keyed(some: DataFrame, function, name: str, kind: str) -> DataFrame:
        numbered = some.select("doc_id", "text", h.alias("h"), F.monotonically_increasing_id().alias("i"))
        return numbered.select("doc_id", "text", F.arrow_udf(function, kind)("text", "h", salt).alias(name))

    # at most SPLIT_ROWS pairs of numbers
    sample = keyed(few(SPLIT_ROWS), key, "key", "long").select("key", (F.octet_length("text") + 64).alias("size")).limit(SPLIT_ROWS).toArrow()
    ranges = min(shards, RANGES)
    each = -(-shards // ranges)
    cuts = splitters(sample.column("key").to_numpy(), sample.column("size").to_numpy(), ranges)

    def shard(texts: pa.Array, row: pa.Array, salt: pa.Array) -> pa.Array:
        return pa.array(shard_of(order.keys(texts, row.to_numpy(), salt.to_numpy()), cuts, each).astype(np.int32))

    shard.__annotations__ = key.__annotations__
    return keyed(rows, shard, "shard", "int"), ranges * each


def pack(docs: DataFrame, json_path: str, rank_path: str, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every piece of every document; columns PIECES."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    df, n_docs, n_words, n_bytes = statistics(rows)
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5)).astype(np.float32)
    mean = n_words / max(n_docs, 1)
    sent = docs.sparkSession.sparkContext.broadcast((idf, mean))  # 2**SLOTS_LOG2 numbers

    def run(table: pa.Table) -> pa.Table:
        return pack_shard(table, *sent.value, json_path, rank_path)

    placed, shards = dealt(rows, df, idf, mean, n_docs, tasks_for(n_bytes + 64 * n_docs, shard_bytes))
    return placed.repartitionById(shards, "shard").groupBy("shard").applyInArrow(run, PIECES)


_encoders: dict[tuple[str, str], Encoder] = {}


def _encoder(json_path: str, rank_path: str) -> Encoder:
    """One encoder a worker: its pieces serve the next shards too."""
    if (json_path, rank_path) not in _encoders:
        _encoders[json_path, rank_path] = Encoder(json_path, rank_path)
    return _encoders[json_path, rank_path]
