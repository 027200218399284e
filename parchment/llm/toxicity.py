"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its words, pairs of neighbouring words, and pairs that skip one word, each hashed
into 2**20 slots and counted once.  FTRL-proximal gives every slot its own learning rate, and its L1 term
leaves most weights at exactly 0, so what is sent to the executors is a short list of (slot, weight).

Edge cases.  Null, empty and wordless texts get the bias's score.  Texts of one word have only that
word.  With no labelled rows, or labels of one class, the score is a constant.  Repeated and tied rows are
deterministic: training order is by hash of doc_id, then doc_id.  Extra columns pass through; a column
that already has an output's name is replaced by the output.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.llm.textbuf import U64, chunks, mix, prefix_hash, run_starts, span_hash, words

SLOTS_LOG2 = 20
#: Bounds of the training sample: so many labelled documents at most, those with the least hash of doc_id, as long as their
#: texts together have so many bytes at most.
SAMPLE_ROWS, SAMPLE_BYTES = 16_000, 128 << 20
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 3.0, 1e-4, 8


def slots(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, slot) of every feature occurrence, repeats included."""
    start, end, doc = words(buf, off)
    h = span_hash(prefix_hash(buf), start, end)
    near, far = doc[1:] == doc[:-1], doc[2:] == doc[:-2]
    pair = mix(h[:-1] * U64(3) + (h[1:] ^ U64(0x5851F42D4C957F2D)))[near]
    skip = mix(h[:-2] * U64(5) + (h[2:] ^ U64(0x14057B7EF767814F)))[far]
    shift = U64(64 - SLOTS_LOG2)
    return np.concatenate((doc, doc[1:][near], doc[2:][far])), (np.concatenate((h, pair, skip)) >> shift).astype(np.int64)


def _distinct(doc: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(doc * (1 << SLOTS_LOG2) + slot)
    keys = keys[run_starts(keys)]
    return keys >> SLOTS_LOG2, keys & ((1 << SLOTS_LOG2) - 1)


def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Arrow function text -> array of its distinct slots."""
    for texts in batches:
        parts, sizes = [], []
        for _, buf, off in chunks(texts, lower=True):
            doc, slot = _distinct(*slots(buf, off))
            parts.append(slot.astype(np.int32))
            sizes.append(np.bincount(doc, minlength=len(off) - 1))
        ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes)) if sizes else [])).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32)))


features.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


def ftrl(rows: list[tuple[np.ndarray, float]], epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights that aren't 0, bias) after so many passes; the bias is neither shrunk nor hashed."""
    size = 1 << SLOTS_LOG2
    z, n = np.zeros(size), np.zeros(size)
    positive = sum(y for _, y in rows)
    rate = min(max(positive / len(rows), 1e-3), 1 - 1e-3) if rows else 0.01
    bias, bias_n = float(np.log(rate / (1 - rate))), 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        w = (np.abs(own) - l1) * -np.sign(own) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(own) <= l1] = 0
        return w

    for _ in range(epochs):
        for at, y in rows:
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = p - y
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
            bias_n += g * g
            bias -= alpha / (beta + np.sqrt(bias_n)) * g
    at = np.flatnonzero(np.abs(z) > l1)
    return at, weights(at), bias


def train_joined(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id", max_rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> tuple[np.ndarray, np.ndarray, float]:
    """Learn from documents that labels (key, label) covers, max_rows and max_bytes at most; updates are sequential, so they run in one task.

    A document with several labels counts with the largest; labels of no document are ignored; equal rows count once.
    """
    ids = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(F.col(label).cast("double")).alias("y"))
    ids = ids.orderBy(F.xxhash64("k"), "k").limit(max_rows)
    texts = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    order = [F.xxhash64("k"), F.col("k"), F.col("h")]
    rows = texts.join(F.broadcast(ids), "k").select("k", "h", "y", F.octet_length("t").alias("size")).distinct().orderBy(*order).limit(max_rows)
    # max_rows narrow rows in one task
    chosen = rows.withColumn("upto", F.sum("size").over(Window.orderBy(*order))).where(F.col("upto") <= max_bytes).select("k", "h", "y")
    sample = texts.join(F.broadcast(chosen), ["k", "h"]).dropDuplicates(["k", "h"])
    ready = sample.select("k", "y", F.arrow_udf(features, "array<int>")("t").alias("x")).repartition(1)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            x = b.column(2)
            values, ends = x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()
            keys, ys = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows += [(keys[i], values[ends[i] : ends[i + 1]].copy(), ys[i]) for i in range(len(b))]
        rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0])))
        at, w, bias = ftrl([(x, y) for _, x, y in rows])
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()), pa.array([bias, *w.tolist()], pa.float64())], ["slot", "w"])

    got = ready.mapInArrow(fit, "slot int, w double").toArrow()  # at most 2**20 + 1 rows, in practice some thousands
    at, w = got.column("slot").to_numpy(), got.column("w").to_numpy()
    if not len(at):
        return np.zeros(0, np.int32), np.zeros(0), 0.0
    return at[at >= 0], w[at >= 0], float(w[at < 0][0])


def scorer(spark, model: tuple[np.ndarray, np.ndarray, float]):
    """Arrow function text -> score."""
    at, w, bias = model
    sent = spark.sparkContext.broadcast((at, w))  # L1 keeps it small; 2**20 slots bound it

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dense = np.zeros(1 << SLOTS_LOG2, np.float64)
        dense[sent.value[0]] = sent.value[1]
        live = dense != 0
        for texts in batches:
            out = np.empty(len(texts))
            for first, buf, off in chunks(texts, lower=True):
                doc, slot = slots(buf, off)
                keep = live[slot]
                doc, slot = _distinct(doc[keep], slot[keep])
                total = np.bincount(doc, dense[slot], len(off) - 1) + bias
                out[first : first + len(off) - 1] = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.array(out)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text", out: str = "score") -> DataFrame:
    """docs with the probability of label 1 added."""
    kept = [F.col(c) for c in docs.columns if c.lower() != out.lower()]
    return docs.select(*kept, F.arrow_udf(scorer(docs.sparkSession, model), "double")(F.col(text)).alias(out))
