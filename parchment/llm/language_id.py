"""Language identification by rank-order profiles.

A profile lists a language's most frequent n-grams by rank.  A document's own most frequent n-grams
are compared with each profile by the out-of-place distance: the sum, over the document's n-grams, of
how far each is from its rank in the profile, a missing n-gram costing the longest distance.  The
nearest profile names the language.

N-grams are of 1 to LONGEST characters of the lower-cased text, letters only, with one blank around words and none
inside.  An n-gram is known by a 40-bit hash of its characters.

Edge cases.  A null, empty or letterless text gets language ``und`` and score 0.  Equal distances go to
the language that sorts first; equal counts rank by n-gram hash, so repeated rows and any partitioning
give equal results.  With no training rows every text is ``und``.  Extra columns pass through; a column
that already has an output's name is replaced by the output.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parchment.llm.common import fresh
from parchment.llm.textbuf import U64, chunks, mix, run_starts

UNKNOWN = "und"
PROFILE_SIZE = 400
#: Bound of the training sample: so many whole documents of each language, those with the least hash of doc_id and text.
SAMPLE_PER_LANGUAGE = 1500
SALTS = 16
LONGEST = 5
#: Bytes of texts whose n-grams are counted at once; a longer text is read in parts that end between words.
PART_BYTES = 400_000
_CODE_BITS = 40
_CODES = U64((1 << _CODE_BITS) - 1)
_BLANK = 32


@cache
def _letter(point: int) -> bool:
    return chr(point).isalpha()


def _folded(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(characters of a chunk, all but letters blank; place of each character's first byte)."""
    points = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    place = np.flatnonzero((buf & 0xC0) != 0x80)
    known, at = np.unique(points, return_inverse=True)
    letter = np.fromiter((_letter(int(x)) for x in known), bool, len(known))
    return np.where(letter[at], points, _BLANK), place


def _code(points: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters from each place on."""
    size = max(len(points) - n + 1, 0)
    acc = np.full(size, U64(n), U64)
    for k in range(n):
        acc = mix(acc ^ points[k : k + size].astype(U64))
    return acc >> U64(64 - _CODE_BITS)


def code_of(gram: str) -> int:
    return int(_code(np.array([ord(c) for c in gram], np.uint32), len(gram))[0])


def gram_counts(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, n-gram code, count) of every distinct n-gram of every text of a chunk, by text and code."""
    points, place = _folded(buf)
    doc = np.searchsorted(off, place, "right") - 1
    # a blank before every text, then runs of blanks as one
    first = np.searchsorted(place, off[:-1])
    points, doc = np.insert(points, first, _BLANK), np.insert(doc, first, np.arange(len(first)))
    points, doc = np.append(points, _BLANK), np.append(doc, doc[-1:] if len(doc) else 0)
    blank = points == _BLANK
    keep = np.concatenate(([True], ~(blank[1:] & blank[:-1])))
    points, doc, blank = points[keep], doc[keep], blank[keep]
    # a blank may belong to the text before: an n-gram is the text's of its letters
    owner = np.where(blank, np.append(doc[1:], doc[-1:]), doc).astype(U64)
    parts = []
    for n in range(1, LONGEST + 1):
        size = max(len(points) - n + 1, 0)
        ok = ~blank[:size] if n == 1 else np.ones(size, bool)
        for k in range(1, n - 1):  # a blank stands at an end or nowhere
            ok &= ~blank[k : k + size]
        parts.append(((owner[:size] << U64(_CODE_BITS)) | _code(points, n))[ok])
    keys = np.sort(np.concatenate(parts))
    first = run_starts(keys)
    count = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return (keys >> U64(_CODE_BITS)).astype(np.int64), (keys & _CODES).astype(np.int64), count


def text_counts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, text index, code, count) of consecutive texts, in parts of bounded size."""
    for first, buf, off in chunks(texts, PART_BYTES, lower=True):
        if len(buf) <= PART_BYTES:
            yield first, len(off) - 1, *gram_counts(buf, off)
            continue
        code, count, a = np.zeros(0, np.int64), np.zeros(0, np.int64), 0  # one long text
        between = np.append(np.flatnonzero(np.isin(buf, np.frombuffer(b" \n\t.,;:0123456789", np.uint8))), len(buf))
        while a < len(buf):
            b = max(a + 1, int(between[min(np.searchsorted(between, a + PART_BYTES), len(between) - 1)]))
            _, more, n = gram_counts(buf[a:b], np.array([0, b - a]))
            code, where = np.unique(np.concatenate((code, more)), return_inverse=True)
            count = np.bincount(where, np.concatenate((count, n)), len(code)).astype(np.int64)
            a = b
        yield first, 1, np.zeros(len(code), np.int64), code, count


def top_grams(doc: np.ndarray, code: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, code, rank from 0) of each text's most frequent n-grams; given by text and code."""
    most = int(count.max()) if len(count) else 0
    order = np.argsort(doc * (most + 1) + (most - count), kind="stable")
    doc, code = doc[order], code[order]
    first = run_starts(doc)
    rank = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
    keep = rank < size
    return doc[keep], code[keep], rank[keep]


def learn_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", size: int = PROFILE_SIZE, per_language: int = SAMPLE_PER_LANGUAGE) -> dict[str, list[int]]:
    """Each language's n-gram codes by rank, from a bounded sample of whole labelled documents.

    The result has at most size codes a language, whatever the input's size.
    """
    rows = labelled.select(F.col(key).alias("k"), F.col(lang).cast("string").alias("l"), F.col(text).alias("t")).where("l is not null and k is not null").withColumn("h", F.xxhash64("k", "t"))
    # first within each of SALTS shares of a language, so that no task ranks more than SALTS * per_language rows of it
    ids = rows.select("l", "k", "h").distinct()
    for part in (["l", F.pmod(F.col("h"), F.lit(SALTS))], ["l"]):
        ids = ids.withColumn("n", F.row_number().over(Window.partitionBy(*part).orderBy("h", "k"))).where(F.col("n") <= per_language).drop("n")
    sample = rows.join(F.broadcast(ids), ["l", "k", "h"], "left_semi").dropDuplicates(["l", "k", "h"])  # per_language rows a language, at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, at = np.unique(np.array(batch.column(0).to_pylist(), object).astype(str), return_inverse=True)
            for first, _, doc, code, n in text_counts(batch.column(1)):
                keys = at[first + doc].astype(np.int64) << _CODE_BITS | code
                ks, inv = np.unique(keys, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(names[ks >> _CODE_BITS].tolist(), pa.string()), pa.array(ks & int(_CODES), pa.int64()), pa.array(np.bincount(inv, n, len(ks)).astype(np.int64))], ["l", "code", "n"])

    counted = sample.select("l", "t").mapInArrow(count, "l string, code long, n long").groupBy("l", "code").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("l").orderBy(F.desc("n"), "code"))).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for r in sorted(ranked.collect(), key=lambda r: (r["l"], r["rank"])):  # languages x size rows
        profiles.setdefault(r["l"], []).append(r["code"])
    return profiles


def classifier(profiles: dict[str, list[int]], size: int = PROFILE_SIZE):
    """Arrow function text -> struct<lang, score, distance>.

    score is the relative lead over the second language, distance the nearest language's share of the longest possible.
    """
    langs = sorted(profiles)
    known = np.unique(np.concatenate([np.asarray(profiles[x], np.int64) for x in langs] or [np.zeros(0, np.int64)]))
    ranks = np.full((len(langs), len(known)), -1, np.int32)
    for i, x in enumerate(langs):
        ranks[i, np.searchsorted(known, profiles[x])] = np.arange(len(profiles[x]))
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("distance", pa.float64())])

    def one(texts: pa.Array) -> pa.Array:
        lang, score, far = np.full(len(texts), len(langs)), np.zeros(len(texts)), np.ones(len(texts))
        for first, n, *counts in text_counts(texts) if langs else ():
            doc, code, rank = top_grams(*counts, size)
            at = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
            there = known[at] == code
            dist = np.empty((len(langs), n))
            for i in range(len(langs)):
                theirs = ranks[i, at]
                dist[i] = np.bincount(doc, np.where(there & (theirs >= 0), np.minimum(np.abs(rank - theirs), size), size), n)
            longest = np.bincount(doc, minlength=n) * float(size)
            two = np.sort(dist, axis=0)[:2] if len(langs) > 1 else np.vstack((dist[0], longest))
            here = longest > 0
            lang[first : first + n][here] = dist.argmin(axis=0)[here]
            score[first : first + n][here] = (1 - two[0] / np.maximum(two[1], 1e-9))[here]
            far[first : first + n][here] = two[0][here] / longest[here]
        names = pa.array([*langs, UNKNOWN], pa.string())
        return pa.StructArray.from_arrays([names.take(pa.array(lang)), pa.array(np.clip(score, 0, 1)), pa.array(far)], fields=list(kind))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield one(texts)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", lang_out: str = "lang_pred", score_out: str = "score", distance_out: str = "distance") -> DataFrame:
    """docs with lang_out, score_out and distance_out (0 to 1) added; texts leave the JVM once and don't come back."""
    # a filter on the outputs would be pushed below and run the function again, if it might
    guess: Column = F.arrow_udf(classifier(profiles), "lang string, score double, distance double").asNondeterministic()(F.col(text))
    outs = (lang_out, score_out, distance_out)
    kept = [F.col(c) for c in docs.columns if c.lower() not in {x.lower() for x in outs}]
    tmp = fresh(docs, "__language")
    return docs.withColumn(tmp, guess).select(*kept, *(F.col(tmp)[f].alias(x) for f, x in zip(("lang", "score", "distance"), outs, strict=True)))
