"""Collocations: phrases that are frequent and hold together, from vertical positional inverted lists.

Documents are read in segments.  A segment is stored vertically, one row a language: its words, and for each word the sorted
positions at which it occurs.  Positions skip one between pieces and between documents, so that position p + 1 is the next word
of the same piece or nobody's.  The length of a list is an exact frequency, and so is the sum over segments.

Phrases grow a word at a time.  The occurrences of a phrase of k words, as start positions, are joined with the postings of
adjacent words: both are sorted by position, so all the lists of a segment merge in one pass.  Only phrases that can be frequent are
extended: f of a phrase is at most f of its parts, so words and pairs below the least frequency are left out.  What is frequent over
all segments is told to the tasks by a Bloom filter of bounded size; it may let an infrequent phrase through, whose
extensions are counted for nothing, and never holds back a frequent one, so counts are exact whatever its size.  Phrases are
told apart by their text, never by a hash.

Scores are exact: decimals of 38 digits hold 10^6 a^2 for counts up to 10^14.

Edge cases.  A null text is empty; a null language is `und`.  Letters A-Z count as a-z and nothing else is folded.  Every byte
but the separators belongs to a word (a no-break space too).  A word longer than any segment stays whole, as texts are never
cut.  Rows that repeat an id or a text count each time.  Ties are broken by count and phrase, in byte order.  An empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.llm.common import WIDE, cut, discard
from parchment.llm.textbuf import U64, chunks, give_back, mix, prefix_hash, run_starts, span_hash

LONGEST, LEAST, COVERED, TOP = 3, 10, 50, 2000
SCALE = 1_000_000
NO_LANG = "und"
#: Bytes of text of a segment; a longer text is a segment of its own.
SEGMENT_BYTES = 3 << 20
#: Rows that a task hands over at once.
ROWS_AT_ONCE = 1 << 16
#: Bits of the filter for each phrase, bits at least and at most (16 MB), and bits set for a phrase.
BITS_EACH, LEAST_BITS, MOST_BITS, SET = 16, 1 << 16, 1 << 27, 3
#: Shares of a language that are ranked apart before its first ones meet.
SHARES = 32

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK, BREAK = np.zeros(256, bool), np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
LISTS = "lang string, words array<string>, counts array<int>, positions binary"


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words as a dictionary array, their positions, their texts) of a buffer of texts."""
    low = LOWER[buf]
    inside = ~(BLANK | BREAK)[low]
    fresh = np.zeros(len(low) + 1, bool)
    fresh[off] = True
    before = np.concatenate(([False], inside[:-1])) if len(low) else inside
    start = np.flatnonzero(inside & (~before | fresh[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(low) else inside
    end = np.flatnonzero(inside & (~after | fresh[1:])) + 1
    text = np.searchsorted(off, start, "right") - 1
    piece = np.cumsum(BREAK[low])[start] if len(start) else np.zeros(0, np.int64)
    apart = np.zeros(len(start), bool)
    apart[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    at = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    flat = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(low[inside])))
    return flat, np.arange(len(start)) + np.cumsum(apart), text


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each segment and language: its vertical lists."""
    held, n_bytes = [], 0
    for b in batches:
        t = b.column("text")
        n_bytes += t.nbytes
        held.append(b)
        if n_bytes >= SEGMENT_BYTES:
            yield from _segment(pa.Table.from_batches(held))
            held, n_bytes = [], 0
    if held:
        yield from _segment(pa.Table.from_batches(held))


def _segment(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    for lang in pc.unique(rows.column("lang")).to_pylist():
        own = rows.column("text").filter(pc.equal(rows.column("lang"), lang)).cast(pa.large_string())
        for _, buf, off in chunks(own, SEGMENT_BYTES):
            flat, position, _ = tokens(buf, off)
            if not len(flat):
                continue
            named = flat.dictionary_encode()
            code = named.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            counts = np.bincount(code, minlength=len(named.dictionary)).astype(np.int32)
            lists = np.diff(position[order], prepend=0).astype(np.int32)  # steps are small within a list, so they compress
            one = np.array([0, len(counts)], np.int32)
            words, of = pa.ListArray.from_arrays(one, named.dictionary.cast(pa.string())), pa.ListArray.from_arrays(one, pa.array(counts))
            yield pa.RecordBatch.from_arrays([pa.array([lang]), words, of, pa.array([lists.tobytes()])], names=["lang", "words", "counts", "positions"])


def inverted_lists(docs: DataFrame) -> DataFrame:
    """(lang, words, counts, positions) of every segment."""
    return docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_lists, LISTS)


class Filter:
    """A Bloom filter of phrases by language; what isn't in it is surely infrequent."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, lang: str, phrases: pa.Array) -> np.ndarray:
        slots = bit_slots(_hashes(pa.array([lang]), phrases), len(self.bits) * 64)
        out = np.ones(len(phrases), bool)
        for s in slots:
            out &= (self.bits[s >> U64(6)] >> (s & U64(63))) & U64(1) > 0
        return out


def _hashes(lang: pa.Array, phrases: pa.Array) -> np.ndarray:
    """A 64-bit hash of each phrase in its language (one language, or one for each)."""

    def of(col: pa.Array) -> np.ndarray:
        data, start = _bytes(col)
        return span_hash(prefix_hash(data), start, np.append(start[1:], len(data)))

    return mix(of(phrases) ^ (of(lang) * U64(0x9E3779B97F4A7C15)))


def _bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, start of each string) of a string column."""
    col = col.cast(pa.large_string())
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off[:-1] - off[0]


def bit_slots(h: np.ndarray, n_bits: int) -> list[np.ndarray]:
    """The bits of each hash."""
    return [mix(h + U64(k + 1)) & U64(n_bits - 1) for k in range(SET)]


def _bits(batches: Iterator[pa.RecordBatch], n_bits: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            s = np.sort(np.concatenate(bit_slots(_hashes(b.column("lang"), b.column("phrase")), n_bits)))
            at = run_starts(s >> U64(6))
            bits = np.bitwise_or.reduceat(U64(1) << (s & U64(63)), at)
            yield pa.RecordBatch.from_arrays([pa.array((s[at] >> U64(6)).astype(np.int64)), pa.array(bits.view(np.int64))], names=["slot", "bits"])


def filter_of(frequent: DataFrame) -> Filter:
    """The filter of (lang, phrase); at most MOST_BITS reach the driver, whatever the number of phrases."""
    n_bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * frequent.count()).bit_length()))
    parts = frequent.select("lang", "phrase").mapInArrow(partial(_bits, n_bits=n_bits), "slot long, bits long")
    got = parts.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(n_bits // 64, U64)
    bits[got.column("slot").to_numpy()] = got.column("bits").to_numpy().view(U64)
    return Filter(bits)


class Lists:
    """One segment's lists, from which phrases grow."""

    def __init__(self, words: pa.Array, counts: np.ndarray, positions: bytes):
        self.words, size = words, len(counts)
        at = np.cumsum(np.frombuffer(positions, np.int32))
        #: The lists of all words merged by position: the word that holds each position, or -1.
        self.merged = np.full(int(at.max(initial=-1)) + 2 + LONGEST, -1, np.int32)
        self.merged[at] = np.repeat(np.arange(size, dtype=np.int32), counts)

    def without(self, dropped: np.ndarray) -> None:
        """Leave the lists of some words out."""
        gone = np.append(dropped, False)  # position -1 holds no word
        self.merged[gone[self.merged]] = -1

    def extended(self, starts: np.ndarray, phrase: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Join occurrences (sorted starts, and which phrase each is) with the postings of adjacent words.

        Returns the starts of what is longer by a word, which new phrase each is, and each one's old phrase and word.
        """
        word = self.merged[starts + length]
        hit = word >= 0
        code = phrase[hit].astype(np.int64) * len(self.words) + word[hit]
        order = np.argsort(code, kind="stable")
        first = run_starts(code[order])
        which = np.empty(len(code), np.int64)
        which[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(code))))
        old, new = np.divmod(code[order[first]], max(len(self.words), 1))
        return starts[hit], which, old, new


def _joined(phrases: pa.Array, words: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(phrases, words, pa.scalar(" ", pa.large_string()))


def _grown(batches: Iterator[pa.RecordBatch], length: int, filters: list[Filter]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) of a segment's phrases of so many words, their shorter parts all in the filters."""
    for b in batches:
        for i in range(b.num_rows):
            lang, words = b.column("lang")[i].as_py(), b.column("words")[i].values.cast(pa.large_string())
            lists = Lists(words, b.column("counts")[i].values.to_numpy(), b.column("positions")[i].as_py())
            lists.without(~filters[0].has(lang, words))
            starts = np.flatnonzero(lists.merged >= 0)
            phrase, text = lists.merged[starts].astype(np.int64), words
            for k in range(1, length):
                starts, phrase, old, new = lists.extended(starts, phrase, k)
                text = _joined(text.take(pa.array(old)), words.take(pa.array(new)))
                if k + 1 < length:  # a longer phrase needs this part and the one that begins a word later
                    kept = filters[k].has(lang, text)[phrase]
                    starts, phrase = starts[kept], phrase[kept]
                    here = np.zeros(len(lists.merged) + 1, bool)
                    here[starts] = True
                    both = here[starts + 1]
                    starts, phrase = starts[both], phrase[both]
            if len(starts):
                n = np.bincount(phrase, minlength=len(text))
                some = np.flatnonzero(n)
                for at in range(0, len(some), ROWS_AT_ONCE):
                    own = some[at : at + ROWS_AT_ONCE]
                    yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(own), np.int32))), text.take(pa.array(own)).cast(pa.string()), pa.array(n[own])], names=["lang", "phrase", "n"])
            del lists, starts, phrase, text
            give_back()


def counted(lists: DataFrame, length: int, filters: list[Filter], least: int) -> DataFrame:
    """(lang, phrase, a) of all phrases of so many words with a >= least, in all segments together."""
    parts = lists.mapInArrow(partial(_grown, length=length, filters=filters), "lang string, phrase string, n long")
    return parts.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= least)


def _scored(found: DataFrame, length: int, frequent: list[DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score): the lowest-scoring cut, of equals that after fewest words."""
    cuts = []
    for k in range(1, length):
        first = F.substring_index("phrase", " ", k)
        found = found.withColumn("first", first).withColumn("rest", F.expr("substr(phrase, length(first) + 2)"))
        left = frequent[k - 1].select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
        right = frequent[length - k - 1].select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
        found = found.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
        score = F.expr(f"(cast(a as decimal(14,0)) * cast(a as decimal(14,0)) * cast({SCALE} as decimal(7,0))) div (cast(l as decimal(14,0)) * cast(r as decimal(14,0)))")
        found = found.withColumn(f"c{k}", F.struct(score.alias("score"), F.lit(k).alias("k"), "l", "r")).drop("l", "r", "first", "rest")
        cuts.append(f"c{k}")
    best = F.least(*cuts) if len(cuts) > 1 else F.col(cuts[0])
    return found.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _first(found: DataFrame, top: int) -> DataFrame:
    """The first rows of each language, with their rank; ranked in shares first, so that no task sees a language whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    some = found.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    return some.drop("share", "rank").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """The strongest phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    lists = cut(inverted_lists(docs), "lists", WIDE)
    each = lists.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("phrase")).agg(F.sum("w.counts").alias("a"))
    frequent = [cut(each.where(F.col("a") >= least), "words")]
    totals = lists.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"))
    filters = []
    for length in range(2, longest + 1):
        filters.append(filter_of(frequent[-1]))
        frequent.append(cut(counted(lists, length, filters, least), "phrases"))
    total = cut(totals, "totals")
    discard(lists)
    scored = None
    for length in range(2, longest + 1):
        found = frequent[length - 1]
        for longer in range(length + 1, longest + 1):  # parts of longer candidates, by their position
            within = [F.expr(f"substring_index(substring_index(phrase, ' ', {i + length}), ' ', -{length})") for i in range(longer - length + 1)]
            most = frequent[longer - 1].select("lang", F.col("a").alias("whole"), F.explode(F.array(*within)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
            found = found.join(most, ["lang", "phrase"], "left").where(F.coalesce(F.lit(100) * F.col("whole") < F.lit(covered) * F.col("a"), F.lit(True))).drop("whole")
        rows = _scored(found, length, frequent)
        scored = rows if scored is None else scored.union(rows)
    ranked = _first(scored, top).join(total, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *(F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")))
