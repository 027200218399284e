"""Near-duplicate classes by ProbMinHash over weighted shingles.

A text is a weighted set of five-word shingles, a shingle's weight being how often it occurs.  ProbMinHash
gives each shingle a Poisson process whose rate is its weight; every arrival falls on one of COMPONENTS
signature components, and the earliest arrival on a component names it.  Arrivals are made in order of time
and stop as soon as every component has one, so long texts cost little more than reading them.  The share of
equal components estimates the probability Jaccard similarity; bands of the signature propose pairs, and the
exact similarity of the two texts confirms them.

Links.  Equal texts are one vertex from the start, whatever their ids.  In a band's bucket no pairs are
emitted.  First every member is compared with the bucket's first vertex.  Buckets whose members then are in one
component are done.  Of the others, those too large for a task are compared with a member of another component, for
some rounds.  In what is left, members of different components are compared block by block inside tasks,
each block keeping track of what it has joined, and only links that join two components come out.  So every two
texts that share a band are either in one component or compared, exactly.

Words are runs of letters, digits and characters outside ASCII, without case.

Edge cases.  A text of one to four words is one shingle; a null, empty or wordless text is in a class only with
equal texts (null counts as empty).  Rows with a null id are returned with a null class and take no part.  Rows
that repeat an id with different texts fall in the class of their own text.  The class id is the least id of the
class, so ties and partitioning don't matter.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import cut, discard
from parchment.llm.components import components
from parchment.llm.textbuf import U64, chunks, mix, prefix_hash, run_starts, span_hash, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 26, 5
COMPONENTS = BANDS * ROWS
SIGNED_AT_ONCE = 1000
#: Bytes of text of one bucket's members that a task compares with as many others, or with the least id.
BLOCK_BYTES = 4 << 20
#: What a row weighs besides its text, so that short texts don't crowd a task.
ROW_BYTES = 2048
#: Linear rounds over buckets of more than a block, before what is left is compared pair by pair.
ROUNDS = 3
_GOLD = U64(0x9E3779B97F4A7C15)
_ID_BITS = 16


def shingles(buf: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle, weight) of every distinct shingle; sorted by text."""
    start, end, doc = words(buf, off)
    n_docs = len(off) - 1
    h = span_hash(prefix_hash(buf), start, end)
    n = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(n) - n
    acc = np.zeros(max(len(h) - size + 1, 0), U64)
    for k in range(size):
        acc = acc * U64(0xD6E8FEB86659FD93) + h[k : k + len(acc)]
    whole = doc[size - 1 :] == doc[: len(acc)] if len(acc) else np.zeros(0, bool)
    owners, values = [doc[: len(acc)][whole]], [mix(acc[whole])]
    short = np.flatnonzero((n > 0) & (n < size))
    part = np.full(len(short), U64(size), U64)
    for k in range(size - 1):
        has = n[short] > k
        part[has] = part[has] * U64(0xD6E8FEB86659FD93) + h[first[short[has]] + k] + U64(k)
    owners.append(short)
    values.append(mix(part))
    bits = max(1, int(n_docs).bit_length())
    keys = np.sort((np.concatenate(owners).astype(U64) << U64(64 - bits)) | (np.concatenate(values) >> U64(bits)))
    at = run_starts(keys)
    weight = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    # the top bits depend on the chunk's size; 40 bits don't
    return (keys >> U64(64 - bits)).astype(np.int64), (keys << U64(bits)) >> U64(24), weight


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, size: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(signature of each text as uint16, whether it has one)."""
    out = np.zeros((n_docs, size), np.uint16)
    total = np.bincount(doc, weight, n_docs)
    seed = mix(element * _GOLD + U64(0xA0761D6478BD642F))
    name = seed >> U64(64 - _ID_BITS)
    limit = size * (np.log(size) + 4) / np.maximum(total, 1)
    live, scale = np.ones(len(doc), bool), 1.0
    while live.any():
        rows = np.flatnonzero(live)
        x, bound, j, keys = np.zeros(len(rows)), limit[doc[rows]] * scale, 0, []
        while len(rows):  # the next arrival of every element that may still come in time
            j += 1
            r = mix(seed[rows] + U64(j * 0xE7037ED1A0B428DB & (2**64 - 1)))
            x = x - np.log(((r >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[rows]
            near = x < bound
            rows, x, bound, r = rows[near], x[near], bound[near], r[near]
            slot = ((mix(r ^ U64(0x8EBC6AF09C88C6E3)) >> U64(32)) * U64(size)) >> U64(32)
            when = (x / bound * (1 << 24)).astype(U64)
            keys.append(((doc[rows].astype(U64) * U64(size) + slot) << U64(24 + _ID_BITS)) | (when << U64(_ID_BITS)) | name[rows])
        keys = np.sort(np.concatenate(keys))
        place = (keys >> U64(24 + _ID_BITS)).astype(np.int64)
        at = run_starts(place)
        filled = np.bincount(place[at] // size, minlength=n_docs) == size
        got = at[filled[place[at] // size]]
        out.reshape(-1)[place[got]] = (keys[got] & U64((1 << _ID_BITS) - 1)).astype(np.uint16)
        live &= ~filled[doc]
        scale *= 2
    return out, total > 0


def bands(sig: np.ndarray, n_bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    acc = np.broadcast_to(mix(np.arange(1, n_bands + 1, dtype=U64) * _GOLD), (len(sig), n_bands)).copy()
    parts = sig.reshape(len(sig), n_bands, rows).astype(U64)
    for k in range(rows):
        acc = mix(acc ^ (parts[:, :, k] + U64(k + 1) * U64(0x1D8E4E27C47D124F)))
    return acc.view(np.int64)


def _band_keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """text -> keys of its bands; none for a text without words."""
    for texts in batches:
        keys, has = [], []
        for _, buf, off in chunks(texts, lower=True):
            for i in range(0, len(off) - 1, SIGNED_AT_ONCE):  # a signature's work is by text, however short it is
                part = off[i : i + SIGNED_AT_ONCE + 1]
                sig, ok = signatures(*shingles(buf[part[0] : part[-1]], part - part[0]), len(part) - 1)
                keys.append(bands(sig))
                has.append(ok)
        ok = np.concatenate(has) if has else np.zeros(0, bool)
        ends = np.concatenate(([0], np.cumsum(np.where(ok, BANDS, 0)))).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)[ok].reshape(-1) if keys else np.zeros(0, np.int64)))


def _packed_sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """text -> its shingles at five bytes each, and their weights where one isn't 1."""
    for texts in batches:
        sets, weights = [], []
        for _, buf, off in chunks(texts, lower=True):
            doc, element, weight = shingles(buf, off)
            at = np.searchsorted(doc, np.arange(len(off)))
            raw = np.ascontiguousarray(element.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                sets.append(raw[a:b].tobytes())
                weights.append(None if (weight[a:b] == 1).all() else weight[a:b].astype("<u4").tobytes())
        yield pa.StructArray.from_arrays([pa.array(sets, pa.binary()), pa.array(weights, pa.binary())], ["elements", "weights"])


for _f in (_band_keys, _packed_sets):
    _f.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


def probability_jaccard(wa: np.ndarray, wb: np.ndarray) -> float:
    """Exact J_P of two weight vectors over the union of their elements."""
    both = (wa > 0) & (wb > 0)
    if not both.any():
        return 0.0
    pairs, n = np.unique(wa.astype(np.int64) * (1 << 31) + wb, return_counts=True)
    a, b = (pairs >> 31).astype(float), (pairs & ((1 << 31) - 1)).astype(float)
    sa, sb = a[:, None], b[:, None]
    own = (a > 0) & (b > 0)
    worst = np.maximum(sa / a[None, own], sb / b[None, own]) * n[:, None]
    return float((n[own] / worst.sum(0)).sum())


class Sets:
    """Weighted sets of one task, compared exactly and one with all at a time."""

    def __init__(self, elements: list[bytes], weights: list[bytes | None]):
        raw = np.frombuffer(b"".join(elements), np.uint8).reshape(-1, 5)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :5] = raw
        n = np.array([len(x) // 5 for x in elements], np.int64)
        self.begin = np.cumsum(n) - n
        self.end = self.begin + n
        known, self.code = np.unique(wide.view("<u8").ravel(), return_inverse=True)
        self.look = np.zeros(len(known), np.float64)
        self.weight = np.ones(len(raw), np.float64)
        self.plain = np.array([w is None for w in weights], bool)
        for i in np.flatnonzero(~self.plain):
            self.weight[self.begin[i] : self.end[i]] = np.frombuffer(weights[i], "<u4")
        self.total = np.add.reduceat(self.weight, self.begin)

    def similarity(self, i: int, least: float) -> np.ndarray:
        """J_P of set i and each set; exact where it reaches least."""
        own = slice(self.begin[i], self.end[i])
        self.look[self.code[own]] = self.weight[own]
        theirs = self.look[self.code]
        self.look[self.code[own]] = 0
        shared = theirs > 0
        both = np.add.reduceat(np.where(shared, self.weight, 0), self.begin)
        if self.plain[i]:
            out = both / (self.total[i] + self.total - both)
            odd = ~self.plain
        else:
            out, odd = np.zeros(len(self.total)), np.ones(len(self.total), bool)
        # a shared element adds at most its share of either set's weight
        most = np.minimum(np.add.reduceat(theirs, self.begin) / self.total[i], both / self.total)
        for k in np.flatnonzero(odd & (most >= least)):
            them = slice(self.begin[k], self.end[k])
            union, inv = np.unique(np.concatenate((self.code[own], self.code[them])), return_inverse=True)
            wa, wb = np.zeros(len(union), np.int64), np.zeros(len(union), np.int64)
            n = own.stop - own.start
            wa[inv[:n]], wb[inv[n:]] = self.weight[own], self.weight[them]
            out[k] = probability_jaccard(wa, wb)
        out[odd & (most < least)] = 0
        return out


def _links(a: np.ndarray, b: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _star(threshold: float):
    """Some members of a bucket and its least id -> links with that."""

    def run(table: pa.Table) -> pa.Table:
        ids, hubs = table.column("v").to_numpy(), table.column("hub").to_numpy()
        near = Sets(table.column("elements").to_pylist(), table.column("weights").to_pylist())
        at = np.flatnonzero(ids == hubs)
        if not len(at):
            return _links([], [])
        other = ids[(near.similarity(int(at[0]), threshold) >= threshold) & (ids != hubs)]
        return _links(np.full(len(other), hubs[0]), other)

    return run


def _cross(threshold: float):
    """Two blocks of a bucket (or one) -> links that join components which nothing joined yet."""

    def run(table: pa.Table) -> pa.Table:
        ids, root, block = (table.column(c).to_numpy().copy() for c in ("v", "comp", "block"))
        if len(ids) < 2 or (root == root[0]).all():
            return _links([], [])
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        near, out = Sets(table.column("elements").to_pylist(), table.column("weights").to_pylist()), []
        names, sizes = np.unique(root, return_counts=True)
        # of two components one isn't the largest, so its members meet all others
        for i in np.flatnonzero(root != names[sizes.argmax()]):
            there = np.ones(len(ids), bool) if x == y else block != block[i]
            if not (there & (root != root[i])).any():
                continue
            found = np.flatnonzero(there & (near.similarity(int(i), threshold) >= threshold))
            for k in found:
                if root[k] != root[i]:
                    out.append((ids[i], ids[k]))
                    root[root == root[k]] = root[i]
        return _links([a for a, _ in out], [b for _, b in out])

    return run


def _starred(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """pairs (hub, v, size) -> links between hubs and members; a star is dealt to as many tasks as it fills."""
    share = pairs.groupBy("hub").agg(F.ceil(F.sum("size") / BLOCK_BYTES).cast("int").alias("shares"))
    hubs = share.select("hub", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.col("hub").alias("v"))
    dealt = pairs.join(share, "hub").select("hub", F.pmod(F.xxhash64("v"), F.col("shares")).cast("int").alias("share"), "v").union(hubs)
    return cut(dealt.join(sets, "v").groupBy("hub", "share").applyInArrow(_star(threshold), "a long, b long"), "links")


def _open_buckets(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members with their components, buckets that aren't one component); a bucket of two has been compared."""
    found = members.join(labels.withColumnRenamed("id", "v"), "v", "left").select("band", "v", "size", F.coalesce("comp", "v").alias("comp"))
    sums = found.groupBy("band").agg(F.count("v").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"), F.ceil(F.sum("size") / BLOCK_BYTES).cast("int").alias("blocks"))
    return found, sums.where("low <> high and n > 2").select("band", "high", "blocks")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, rep_id, class_id) of every row: the least id with an equal text, and the least id of the class."""
    return classified(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), threshold).select("doc_id", "rep_id", "class_id")


def classified(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """rows (doc_id, text) -> (doc_id, h, rep_id, class_id, first): h is the text's digest, and first tells the
    text that stands for the class: the least digest among those of the class's least id."""
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = rows.where("doc_id is not null")
    digest = F.unhex(F.md5("text")).alias("h")
    # equal texts are one vertex; each task sends one row of a text.  Its number is made once, as the table is written
    signed = own.select("doc_id", digest, (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"), F.arrow_udf(_band_keys, "array<long>")("text").alias("bands"))
    reps = signed.groupBy("h").agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    reps = cut(reps.withColumn("v", F.monotonically_increasing_id()), "reps")
    keys = reps.select("v", "size", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.min("v").alias("hub"), F.max("v").alias("last")).where("hub <> last").select("band", "hub")
    members = cut(keys.join(shared, "band"), "members")
    # the texts that may be compared, once; the other texts are read no more
    wanted = reps.join(members.select("v").distinct(), "v", "left_semi").select("v", F.col("rep").alias("doc_id"), "h")
    sets = own.select("doc_id", "text", digest).join(wanted, ["doc_id", "h"]).select("v", F.arrow_udf(_packed_sets, "elements binary, weights binary")("text").alias("s"))
    sets = cut(sets.select("v", "s.*").where(F.length("elements") > 0).dropDuplicates(["v"]), "sets")

    links = _starred(members.where("v <> hub").select("hub", "v", "size").distinct(), sets, threshold)
    labels = components(links)
    for _ in range(ROUNDS):  # buckets of more than a block meet a member of another component before they meet themselves
        found, still = _open_buckets(members, labels)
        large = still.where("blocks > 1")
        if large.isEmpty():
            break
        parts = found.join(large, "band")
        hubs = parts.where("comp = high").groupBy("band").agg(F.min("v").alias("hub"))
        more = _starred(parts.where("comp <> high").join(hubs, "band").select("hub", "v", "size").distinct(), sets, threshold)
        if more.isEmpty():
            break
        links, labels = links.union(more), components(links.union(more))
    found, split = _open_buckets(members, labels)
    parts = found.join(split, "band").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    parts = parts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("band", "v", "comp", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    more = cut(parts.join(sets, "v").groupBy("band", "x", "y").applyInArrow(_cross(threshold), "a long, b long").distinct(), "links")
    if not more.isEmpty():
        labels = components(links.union(more))
    discard(members, sets, more)
    # a class is named by its texts' least id, and stands for itself by the least digest of that id
    named = reps.select("h", "rep", "v").join(labels.withColumnRenamed("id", "v"), "v", "left").select("h", "rep", F.coalesce("comp", "v").alias("comp"))
    least = named.groupBy("comp").agg(F.min(F.struct("rep", "h")).alias("least"))
    classed = named.join(least, "comp").select("h", F.col("rep").alias("rep_id"), F.col("least.rep").alias("class_id"), (F.col("least.h") == F.col("h")).alias("first"))
    out = own.select("doc_id", digest).join(classed, "h")
    null = F.lit(None).cast("long")
    return out.select("doc_id", "h", "rep_id", "class_id", "first").unionByName(rows.where("doc_id is null").select("doc_id", digest, null.alias("rep_id"), null.alias("class_id"), F.lit(True).alias("first")))
