"""Exact k-means over integer vectors with Hamerly's bounds.

A kept vector has exactly DIMENSIONS components, none null or non-finite; each becomes the integer floor(256 x).
Between rounds a vector's row keeps its cluster, an upper bound of the distance to its own centroid and one lower bound
of the distance to every other.  When centroids move, the upper bound grows by its centroid's drift and the lower
shrinks by the largest drift of the others.  While the upper bound stays below the lower one, or below half
the way from the vector's centroid to the next centroid, nothing can have changed and no distance is computed.  Of the rest
the upper bound is made exact first, and only vectors that are still ambiguous are scanned: all squared distances in
integers, the smallest number winning ties.  Bounds are rounded outwards and compared strictly, so rounding and ties can only
cause a scan.

A centroid's exact sum is carried from round to round; only vectors that changed their cluster are subtracted and added.  Sums
are reduced in the task and then by Spark as decimals; the driver sees one row a cluster.  Each round's rows are a written
table, and the one before is deleted.

Edge cases.  Components beyond LIMIT in size count as LIMIT, so that squared distances fit 64 bits.  Rows that repeat an id
or a vector are vectors of their own; a null id is a vector with a null id and starts no centroid while others can.  Fewer
vectors than clusters make fewer clusters, an empty table none.  Of equal seed hashes (one id twice) the lesser vector
comes first.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import cut, discard
from parchment.llm.textbuf import run_starts

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 40, 5, 256
#: Largest size of an integer component: 64 squares of twice this fit 63 bits.
LIMIT = 1 << 27
#: What sums of squares may reach so that double precision holds them exactly.
EXACT = 1 << 53
#: Relative slack of bounds, above any rounding of a square root and of a few sums.
SLACK = 1e-12
STATE = "vec_id long, q array<int>, cluster int, upper double, lower double, moved boolean, was int"


def usable(x: Column, size: int) -> Column:
    """Whether a vector has so many components, none null or non-finite."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return F.coalesce((F.size(x) == size) & ~F.exists(x, bad), F.lit(False))


def integers(vectors: DataFrame, size: int = DIMENSIONS) -> DataFrame:
    """(vec_id, q) of the kept vectors."""
    whole = lambda v: F.greatest(F.least(F.floor(v.cast("double") * SCALE), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int")
    x = F.col("embedding")
    return vectors.where(usable(x, size)).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, whole).alias("q"))


def seeds(kept: DataFrame, clusters: int = CLUSTERS) -> np.ndarray:
    """The first centroids: vectors of the smallest hashes of their ids."""
    named = kept.select("q", F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256).alias("h"))
    rows = named.orderBy(F.asc_nulls_last("h"), "q").limit(clusters).collect()  # a bounded top-k
    return np.array([r["q"] for r in rows], np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """All squared distances of integer rows, exactly."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    kind = np.float64 if 4 * x.shape[1] * most * most < EXACT else np.int64
    a, b = x.astype(kind), c.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)


def own_squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of each row to the row of c beside it."""
    d = x.astype(np.int64) - c
    return np.einsum("ij,ij->i", d, d)


def scan(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, upper, lower) from all distances."""
    d = squared(x, c)
    best = d.argmin(1)
    upper = np.sqrt(d[np.arange(len(d)), best].astype(float)) * (1 + SLACK)
    lower = np.sqrt(np.partition(d, 1, 1)[:, 1].astype(float)) * (1 - SLACK) if len(c) > 1 else np.full(len(d), np.inf)
    return best.astype(np.int32), upper, lower


class Moves:
    """What a round's assignment needs besides vectors: the centroids, and how far each went since the bounds held."""

    def __init__(self, now: np.ndarray, before: np.ndarray):
        self.now = now
        self.drift = np.sqrt(own_squared(now, before).astype(float)) * (1 + SLACK)
        k = len(now)
        order = np.argsort(self.drift)
        self.others = np.full(k, self.drift[order[-1]])  # the largest drift of the other centroids
        self.others[order[-1]] = self.drift[order[-2]] if k > 1 else 0.0
        between = np.sqrt(squared(now, now).astype(float))
        np.fill_diagonal(between, np.inf)
        self.half = between.min(1) / 2 * (1 - SLACK)


def reassign(x: np.ndarray, a: np.ndarray, upper: np.ndarray, lower: np.ndarray, moves: Moves) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, upper, lower, how many vectors were scanned) after the centroids moved."""
    upper = (upper + moves.drift[a]) * (1 + SLACK)
    lower = np.where(np.isinf(lower), lower, lower - moves.others[a] - SLACK * np.abs(lower))
    a, safe = a.copy(), np.maximum(lower, moves.half[a])
    open_ = np.flatnonzero(upper >= safe)
    upper[open_] = np.sqrt(own_squared(x[open_], moves.now[a[open_]]).astype(float)) * (1 + SLACK)
    open_ = open_[upper[open_] >= safe[open_]]
    if len(open_):
        a[open_], upper[open_], lower[open_] = scan(x[open_], moves.now)
    return a, upper, lower, len(open_)


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1)


def _first(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            a, upper, lower = scan(_matrix(b.column("q")), centroids)
            fresh, none = pa.array(np.ones(len(a), bool)), pa.array(np.full(len(a), -1, np.int32))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("q"), pa.array(a), pa.array(upper), pa.array(lower), fresh, none], names=["vec_id", "q", "cluster", "upper", "lower", "moved", "was"])


def _next(batches: Iterator[pa.RecordBatch], moves: Moves) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            was = b.column("cluster").to_numpy()
            a, upper, lower, _ = reassign(_matrix(b.column("q")), was, *(b.column(c).to_numpy() for c in ("upper", "lower")), moves)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("q"), pa.array(a), pa.array(upper), pa.array(lower), pa.array(a != was), pa.array(was)], names=["vec_id", "q", "cluster", "upper", "lower", "moved", "was"])


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cluster, place, by how much its sum there changed), the count after the components; from each batch once."""
    for b in batches:
        if not b.num_rows:
            continue
        x, to, was = _matrix(b.column("q")).astype(np.int64), b.column("cluster").to_numpy(), b.column("was").to_numpy()
        left = was >= 0
        for keys, rows, sign in ((to, x, 1), (was[left], x[left], -1)):
            if len(keys):
                order = np.argsort(keys, kind="stable")
                at = run_starts(keys[order])
                sums, n = np.add.reduceat(rows[order], at, axis=0), np.diff(np.append(at, len(keys)))
                table = np.column_stack((sums, n)) * sign  # the count is the last place
                hit, size = keys[order][at].astype(np.int32), table.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(hit, size)), pa.array(np.tile(np.arange(size, dtype=np.int32), len(hit))), pa.array(table.reshape(-1))], names=["cluster", "i", "s"])


def _add_changes(state: DataFrame, sums: list[list[int]]) -> None:
    """Bring exact sums, each followed by its count, up to the state's assignment, in place."""
    parts = state.where("moved").select("q", "cluster", "was").mapInArrow(_changes, "cluster int, i int, s long")
    for r in parts.groupBy("cluster", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # clusters x places
        sums[r["cluster"]][r["i"]] += int(r["s"])


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = DIMENSIONS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector, final centroids); both exact."""
    out = "vec_id long, cluster int, distance long"
    kept = integers(vectors, size)
    now = seeds(kept, clusters)
    if not len(now):
        return vectors.sparkSession.createDataFrame([], out), now
    state = cut(kept.mapInArrow(partial(_first, centroids=now), STATE), "hamerly")
    sums = [[0] * (size + 1) for _ in now]
    for k in range(rounds):
        _add_changes(state, sums)
        before, now = now, np.array([[s // n for s in sum_] if n else kept for (*sum_, n), kept in zip(sums, now.tolist(), strict=True)], np.int64)
        moves, held = Moves(now, before), state
        if k + 1 < rounds:
            state = cut(held.mapInArrow(partial(_next, moves=moves), STATE), "hamerly")
            discard(held)

    if not rounds:
        moves = Moves(now, now)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _next(batches, moves):
            a = b.column("cluster")
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), a, pa.array(own_squared(_matrix(b.column("q")), now[a.to_numpy()]))], names=["vec_id", "cluster", "distance"])

    found = cut(state.mapInArrow(last, out), "clusters")
    discard(state)
    return found, now


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows, with their cluster's and the whole inertia and the digest of their centroid."""
    total = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a row a cluster
    name = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    most = (1 << 63) - 1  # what a long holds
    rows = [(c, min(s, most), name(c)) for c, s in total.items()]
    each = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string")
    return found.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(min(sum(total.values()), most)).cast("long").alias("inertia"), "centroid_sha256")


def clusters(vectors: DataFrame, count: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: its cluster, its squared distance, and what the clustering amounts to."""
    return with_inertia(*clustered(vectors.select("vec_id", "embedding"), count, rounds))
