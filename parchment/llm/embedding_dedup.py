"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them, one kept of each group.

Equal vectors are one vertex with a weight, so thousands of copies cost one comparison.  Unit vectors get their nearest
centroid as home cell; a vector also visits lower-numbered cells whose border with its home is near.  Every pair is
compared in at most one cell, the lower of the two homes, so that links are counted once.  Cells are cut into blocks, and a
task multiplies two blocks; it returns a vertex's number of links there and a star for each local component, never
pairs.  Components of the stars are found by hooking and contraction.

How far visits go.  Of two unit vectors at the least angle that links, one can lie beyond the border by the sine of that
angle at most; visiting within that distance loses nothing.  In many dimensions the difference of two vectors hardly
ever points straight at a border: its part in one direction has a deviation of sine / sqrt(d), d being the dimensions that the data really
fill (the participation ratio of a sample's covariance).  Visits go as far as REACH such deviations, or the sine if that
is less, which it is for data of few dimensions.  exact=True always takes the sine.  The tests measure recall.

Cells hold some CELL_ROWS vectors each, MOST_CELLS at most; they are fitted on FIT_ROWS vectors a cell of a sample (by hash), which the
driver collects: MOST_CELLS * FIT_ROWS vectors at most.  Fitting decides where work is done, not what is a link.

Cosines are those of double precision; values near the threshold are taken again from the vectors as given.  Vectors of
unequal length don't link.

Edge cases.  Vectors that are null, empty or zero, or hold null or non-finite components, have no links and are their own
component.  Rows that repeat an id are vectors of their own.  A null id takes part; the least id of a component ignores
it, and it is never kept.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import cut, discard
from parchment.llm.components import components

THRESHOLD = 0.9
#: Vertices a cell, cells at most, and rows of the sample a cell.
CELL_ROWS, MOST_CELLS, FIT_ROWS, FIT_ROUNDS = 2048, 1024, 64, 5
REACH = 4.0
#: Rows of a block; a task holds two, and a matrix of their products.
BLOCK_ROWS = 2048
#: Products so near the threshold are taken again.
NEAR = 1e-9


class Cells:
    """Centroids of one length of vectors, and how far visits go."""

    def __init__(self, sample: np.ndarray, count: int, threshold: float, exact: bool):
        x = sample / np.linalg.norm(sample, axis=1)[:, None]
        self.centroids = x[:count].copy()
        for _ in range(FIT_ROUNDS if count > 1 else 0):
            near = (x @ self.centroids.T).argmax(1)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, near, x)
            size = np.linalg.norm(sums, axis=1)
            self.centroids[size > 0] = sums[size > 0] / size[size > 0, None]
        sine = math.sqrt(max(0.0, 1 - threshold * threshold))
        spread = np.linalg.eigvalsh(np.cov(x.T)) if len(x) > 1 and x.shape[1] > 1 else np.ones(1)
        filled = spread.sum() ** 2 / max((spread**2).sum(), 1e-300)
        self.reach = sine if exact else min(sine, REACH * sine / math.sqrt(max(filled, 1.0)))
        self.centroids = np.unique(np.round(self.centroids, 9), axis=0)
        self.apart = np.stack([np.maximum(np.linalg.norm(self.centroids - c, axis=1), 1e-9) for c in self.centroids])

    def visits(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(home cell of each unit vector, which lower cells it visits, as a matrix)."""
        p = unit @ self.centroids.T
        home = p.argmax(1)
        beyond = (p[np.arange(len(p)), home][:, None] - p) / self.apart[home]
        return home, (beyond <= self.reach + 1e-9) & (np.arange(p.shape[1]) < home[:, None])


def _route(batches: Iterator[pa.RecordBatch], cells: dict[int, Cells]) -> Iterator[pa.RecordBatch]:
    """(vid, copies, x, dim, cells): the home cell first, then those visited."""
    for b in batches:
        if not b.num_rows:
            continue
        col = b.column("x")
        dims = np.diff(col.offsets.to_numpy()).astype(np.int32)
        routes = np.empty(b.num_rows, object)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            if int(dim) not in cells:  # few vectors of this length: one cell
                for i in at:
                    routes[i] = [0]
                continue
            x = col.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
            home, more = cells[int(dim)].visits(unit(x))
            for i, h, m in zip(at.tolist(), home.tolist(), more, strict=True):
                routes[i] = [h, *np.flatnonzero(m).tolist()]
        yield pa.RecordBatch.from_arrays([b.column("vid"), b.column("copies"), col, pa.array(dims), pa.array(routes.tolist(), pa.list_(pa.int32()))], names=["vid", "copies", "x", "dim", "cells"])


def unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaling first keeps squares from overflow and underflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of x and y have a cosine of threshold or more."""
    g = unit(x) @ unit(y).T
    out = g >= threshold
    for i, j in zip(*np.nonzero(np.abs(g - threshold) < NEAR), strict=True):
        a, b = x[i].astype(np.float64), y[j].astype(np.float64)
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        out[i, j] = math.sumprod(a, b) / math.sqrt(math.sumprod(a, a) * math.sumprod(b, b)) >= threshold
    return out


def stars(adjacent: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, least vertex of its component) of the links between two lists of vertices."""
    left, right = np.full(len(first), -1), np.full(len(second), -1)
    names = []
    for seed in np.flatnonzero(adjacent.any(1)):
        if left[seed] >= 0:
            continue
        k, rows = len(names), np.array([seed])
        members = []
        while len(rows):
            left[rows] = k
            members.append(first[rows].min())
            columns = np.flatnonzero(adjacent[rows].any(0) & (right < 0))
            right[columns] = k
            if len(columns):
                members.append(second[columns].min())
            rows = np.flatnonzero(adjacent[:, columns].any(1) & (left < 0))
        names.append(min(members))
    names = np.array(names, np.int64)
    i, j = np.flatnonzero(left >= 0), np.flatnonzero(right >= 0)
    return np.concatenate((first[i], second[j])), np.concatenate((names[left[i]], names[right[j]]))


def _compare(batch: pa.Table, threshold: float) -> pa.Table:
    """(vid, links, star) of one pair of blocks: the first block's rows have side 0, the second's 1; one block alone has 0."""
    side, vid, copies = (batch.column(c).to_numpy() for c in ("side", "vid", "copies"))
    x = batch.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(side), -1)
    own, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = batch.column("kind")[0].as_py() == 0
    if alone:
        other = own
    a = linked(x[own], x[other], threshold) if len(own) and len(other) else np.zeros((len(own), len(other)), bool)
    if alone:
        np.fill_diagonal(a, False)
    vertex, star = stars(a, vid[own], vid[other])
    n = a @ copies[other] if alone else np.concatenate((a @ copies[other], copies[own] @ a))
    name = vid[own] if alone else np.concatenate((vid[own], vid[other]))
    hit = n > 0
    by, at = np.unique(vertex, return_index=True)
    of = star[at][np.searchsorted(by, name[hit])] if hit.any() else np.zeros(0, np.int64)
    return pa.table({"vid": pa.array(name[hit]), "links": pa.array(n[hit].astype(np.int64)), "star": pa.array(of.astype(np.int64))})


def vertices(vectors: DataFrame) -> DataFrame:
    """(vid, copies, least, x): distinct usable vectors, numbered."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    good = F.coalesce(~F.exists("x", bad) & F.exists("x", lambda v: v != 0), F.lit(False))
    each = vectors.where(good).groupBy("x").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    return cut(each.select(F.monotonically_increasing_id().alias("vid"), "copies", "least", "x"), "vertices")


def cells_of(each: DataFrame, threshold: float, exact: bool) -> dict[int, Cells]:
    """Cells of every length that has more vectors than one cell holds."""
    found = {}
    counts = each.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_ROWS).collect()
    for r in counts:
        count = min(MOST_CELLS, -(-r["n"] // CELL_ROWS))
        share = min(1.0, 1.2 * count * FIT_ROWS / r["n"])
        bucket = F.pmod(F.xxhash64("x"), F.lit(1 << 20))
        sample = each.where((F.size("x") == r["dim"]) & (bucket < int(share * (1 << 20)) + 1)).select("x").limit(2 * count * FIT_ROWS).toArrow()
        x = sample.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(sample), -1)
        order = np.lexsort(x.T)  # whatever order the rows came in
        x = x[np.random.default_rng(0).permutation(order)]
        found[r["dim"]] = Cells(unit(x), min(count, len(x)), threshold, exact)
    return found


def links(each: DataFrame, threshold: float = THRESHOLD, exact: bool = False) -> DataFrame:
    """(vid, links, star), a row for each vertex and task that found links of it."""
    kind = each.schema["x"].dataType.simpleString()
    cells = cells_of(each, threshold, exact)
    routed = cut(each.select("vid", "copies", "x").mapInArrow(partial(_route, cells=cells), f"vid long, copies long, x {kind}, dim int, cells array<int>"), "routed")
    role = F.posexplode("cells").alias("place", "cell")
    sizes = routed.select("dim", role).groupBy("dim", "cell").agg(F.sum((F.col("place") == 0).cast("long")).alias("homes"), F.sum((F.col("place") > 0).cast("long")).alias("guests"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK_ROWS).cast("int")
    sizes = sizes.select("dim", "cell", blocks("homes").alias("hb"), blocks("guests").alias("gb")).where("hb > 0")
    if sum(c.centroids.shape[0] for c in cells.values()) <= MOST_CELLS * 16:  # else lengths are many, and the join may shuffle
        sizes = F.broadcast(sizes)
    at = lambda n: F.pmod(F.xxhash64("vid"), F.greatest(F.col(n), F.lit(1))).cast("int")
    struct = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    own, guest = F.col("own"), F.col("guest")
    span = lambda lo, hi: F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    zero, one = F.lit(0), F.lit(1)
    home = F.concat(
        F.array(struct(0, own, own, 0)),
        F.transform(span(own + 1, F.col("hb") - one), lambda j: struct(1, own, j, 0)),
        F.transform(span(zero, own - one), lambda i: struct(1, i, own, 1)),
        F.transform(span(zero, F.col("gb") - one), lambda j: struct(2, own, j, 0)),
    )
    visit = F.transform(span(zero, F.col("hb") - one), lambda i: struct(2, i, guest, 1))
    dealt = routed.select("vid", "copies", "x", "dim", role).join(sizes, ["dim", "cell"]).withColumn("own", at("hb")).withColumn("guest", at("gb"))
    tasks = dealt.select("vid", "copies", "x", "dim", "cell", F.explode(F.when(F.col("place") == 0, home).otherwise(visit)).alias("t")).select("vid", "copies", "x", "dim", "cell", "t.*")

    def compared(blocks: pa.Table) -> pa.Table:
        return _compare(blocks, threshold)

    found = tasks.groupBy("dim", "cell", "kind", "i", "j").applyInArrow(compared, "vid long, links long, star long")
    out = cut(found, "found")
    discard(routed)
    return out


def grouped(vectors: DataFrame, threshold: float = THRESHOLD, exact: bool = False) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept)."""
    rows = vectors.select("vec_id", F.col("embedding").alias("x"))
    each = vertices(rows)
    found = links(each, threshold, exact)
    labels = components(cut(found.where("star <> vid").select(F.col("vid").alias("a"), F.col("star").alias("b")).distinct(), "stars"))
    counts = found.groupBy("vid").agg(F.sum("links").alias("links"))
    named = each.join(labels.withColumnRenamed("id", "vid"), "vid", "left").withColumn("comp", F.coalesce("comp", "vid"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    # one row a vertex; a component's vertices may be many, so its least id comes by a join that can be split
    known = cut(named.select("vid", "x", "copies", "comp").join(least, "comp").join(counts, "vid", "left").select("x", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "known")
    own = F.coalesce("component_id", "vec_id")
    found_rows = rows.join(known, "x", "left")
    return found_rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
