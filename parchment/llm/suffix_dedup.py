"""Exact removal of repeated passages by range-partitioned suffixes.

A byte goes when a LENGTH-byte string that covers it also starts earlier: in a document with a smaller id, or
earlier in the same document.  Sorting every suffix of the corpus would move a hundred bytes for each byte of
text, so only suffixes at anchors are sorted, and they decide for all others:

1. Among the 61 40-byte strings that start in a LENGTH-byte window, the one with the least hash is the window's anchor.
   Equal windows have equal anchors at equal places.  One anchor owns a run of neighbouring windows; there are
   some 3 anchors to 100 bytes.
2. Sampled splitters range-partition the anchors' suffixes by their leading 40 bytes, then by the bytes that their windows
   cover (as a hash), so a common passage with many continuations is cut too.  Each bucket sorts its suffixes by
   multikey quicksort: by eight bytes, and runs of equal ones by the next eight.  Of suffixes that agree in all of it, all
   but the earliest have repeated windows only.
3. A group of equal leading bytes may cross a border.  Each bucket tells its first and last leading bytes, neighbours are
   compared, and a group that goes on beyond a border has another cover there.
4. Where leading bytes agree but the covers don't (a passage's ends), the windows themselves are compared: each
   is keyed by its LENGTH bytes and all but the earliest of a key are repeats.

Every step first keeps the earliest of equal records in its own batch, so a passage that a third of all
documents share reaches a bucket once a batch, not once a document.  Records travel packed.

Leading bytes are compared as they are.  Covers and windows, 100 to 160 bytes, are compared by four polynomials modulo the prime
2^31 - 1 at places drawn anew for each run: two unequal ones agree in a polynomial at less than 160 of its 2^31 places, so in all four
with a probability below 2^-94, whatever the texts (they are given before the places are drawn).  That is not a comparison
of bytes, which would be five times what may be written (see the README).

A row is known by a hash of its id and text, so rows that lack or repeat an id are spread like others.

Edge cases.  A null text counts as empty.  Texts shorter than LENGTH keep everything.  A null id counts as smaller
than all others.  Rows that repeat an id are one place in the order: strings at equal starts of them aren't
earlier than each other.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import cut, tasks_for
from parchment.llm.packed import BLOBS, dealt, joined
from parchment.llm.textbuf import U64, chunks, mix, powers, prefix_hash, run_starts

LENGTH = 100
GRAM = 40
SPAN = LENGTH - GRAM + 1
BUCKET_BYTES = 16 << 20
PART_BYTES = 2 << 20
SAMPLE_BYTES, SAMPLE_KEYS = 16 << 20, 400_000
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_NULL = np.iinfo(np.int64).min
WORDS = tuple(f"w{i}" for i in range(GRAM // 8))
_ANCHORS = dict.fromkeys((*WORDS, "cover", "cover2"), "<u8") | {"doc": "<i8", "row": "<u8", "at": "<u4", "low": "u1", "high": "u1"}
_FOUND = {"row": "<u8", "start": "<u4", "n": "u1", "open": "?"}
_WINDOWS = {"one": "<u8", "two": "<u8", "doc": "<i8", "row": "<u8", "at": "<u4"}
#: Rows between steps: kind, bucket, packed records; an anchor group at a border has its border, an end its leading bytes.
_STEP = f"kind int, {BLOBS}"
_SORTED = f"kind int, {BLOBS}, border long, lead binary"
FOUND, EDGE, END = 1, 2, 3


PRIME = U64((1 << 31) - 1)
#: Bytes of text that are named at once.
NAMED_BYTES = 1 << 18
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def drawn_bases() -> tuple[int, ...]:
    """Places of a run's four polynomials."""
    return tuple(2 + secrets.randbelow(int(PRIME) - 2) for _ in range(4))


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME."""
    for _ in range(2):
        x = (x & PRIME) + (x >> U64(31))
    return np.where(x >= PRIME, x - PRIME, x)


def _base_powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(base**i, base**-i) modulo PRIME, kept for the next call."""
    got = _tables.get(base)
    if got is None or len(got[0]) < n:
        if len(_tables) > 8:  # of runs before
            _tables.clear()
        got = []
        for b in (base, pow(base, -1, int(PRIME))):
            a, step = np.ones(1, U64), b
            while len(a) < n:
                a, step = np.concatenate((a, _reduced(a * U64(step)))), step * step % int(PRIME)
            got.append(a)
        got = _tables[base] = tuple(got)
    return got[0][:n], got[1][:n]


def span_names(buf: np.ndarray, low: np.ndarray, high: np.ndarray, bases: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Two words that name the bytes of each span, low being sorted: the values of a polynomial at each of the bases."""
    out = np.zeros((2, len(low)), U64)
    edges = np.searchsorted(low, np.arange(0, len(buf) + 1, NAMED_BYTES))
    for a, b in zip(edges, np.append(edges[1:], len(low)), strict=True):
        if a == b:
            continue
        base, end = int(low[a]), int(high[a:b].max())
        s, e, part = low[a:b] - base, high[a:b] - base, buf[base:end].astype(U64) + U64(1)
        total = np.zeros(len(part) + 1, U64)
        for k, place in enumerate(bases):
            up, down = _base_powers(place, max(len(part), NAMED_BYTES + 256))
            x = part * up[: len(part)]
            np.cumsum((x & PRIME) + (x >> U64(31)), out=total[1:])
            value = _reduced(_reduced(total[e] - total[s]) * down[s])
            out[k // 2, a:b] = (out[k // 2, a:b] << U64(31)) | value
    return out[0], out[1]


def multikey_sort(words: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(order of strings given as words, whether each begins a new string in that order).

    Multikey quicksort: strings are sorted by one word, and only runs that are equal so far by the next.
    """
    n = len(words[0])
    order = np.argsort(words[0])
    new = np.ones(n, bool)
    new[1:] = words[0][order[1:]] != words[0][order[:-1]]
    for w in words[1:]:
        run = np.cumsum(new) - 1
        live = np.flatnonzero(np.bincount(run, minlength=1)[run] > 1) if n else np.zeros(0, np.int64)
        if not len(live):
            break
        mine = order[live]
        order[live] = mine[np.lexsort((w[mine], run[live]))]
        new[live[1:]] |= (w[order[live[1:]]] != w[order[live[:-1]]]) & (run[live[1:]] == run[live[:-1]])
    return order, new


def anchors(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text index, place in buf, first and last owned window) of every anchor of a chunk."""
    n = len(buf)
    if n < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    prefix = prefix_hash(buf)
    down = powers("down", n + 1)
    value = (((prefix[GRAM:] - prefix[:-GRAM]) * down[: n - GRAM + 1]) >> U64(32)).astype(np.uint32)
    index = np.arange(len(value), dtype=np.int32)
    size = 1
    while size * 2 < SPAN:  # least value and leftmost place of it over size strings
        less = value[size:] < value[:-size]
        index = np.where(less, index[size:], index[:-size])
        value = np.minimum(value[size:], value[:-size])
        size *= 2
    rest = SPAN - size
    less = value[rest:] < value[:-rest]
    index = np.where(less, index[rest:], index[:-rest])  # of each window, by its start
    starts = np.flatnonzero(np.arange(LENGTH, LENGTH + len(index)) <= np.repeat(off[1:], np.diff(off))[: len(index)])
    own = index[starts]
    first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)))) if len(starts) else np.zeros(0, np.int64)
    low, high, at = starts[first], starts[np.append(first[1:], len(starts)) - 1] if len(starts) else starts, own[first].astype(np.int64)
    doc = np.searchsorted(off, low, "right") - 1
    return doc, at, low, high


def signed(buf: np.ndarray, codes: tuple[int, ...], at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(WORDS of the leading bytes, two hashes of what the windows cover and where) of anchors."""
    lead = buf[at[:, None] + np.arange(GRAM)].reshape(-1, len(WORDS), 8).view(">u8")[..., 0].astype(U64) if len(at) else np.zeros((0, len(WORDS)), U64)
    place = (at - low).astype(U64) * U64(131) + (high - low).astype(U64)
    one, two = span_names(buf, low, high + LENGTH, codes)
    return (*lead.T.copy(), mix(one ^ (place << U64(48))), mix(two ^ (place << U64(48))))


def _earliest(keys: tuple[np.ndarray, ...], doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted order, whether an entry of it is later than an earlier one of equal keys)."""
    order = np.lexsort((at, doc, *keys[::-1]))
    new = np.ones(len(order), bool)
    for k in keys:
        new[1:] &= k[order[1:]] == k[order[:-1]]
    new[1:] = ~new[1:]
    new[:1] = True
    group = np.flatnonzero(new)
    lead = np.repeat(group, np.diff(np.append(group, len(order))))
    d, a = doc[order], at[order]
    later = (d != d[lead]) | (a != a[lead])  # rows that repeat an id tie with its first
    return order, later


def _batch_rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, row names, buf, off) of a batch's chunks; null ids are the least number."""
    ids, names = batch.column(0).fill_null(_NULL).to_numpy(zero_copy_only=False), batch.column(1).to_numpy().view(U64)
    for first, buf, off in chunks(batch.column(2)):
        own = slice(first, first + len(off) - 1)
        yield ids[own], names[own], buf, off


def _doc_bucket(row: np.ndarray, n: int) -> np.ndarray:
    return (mix(row.astype(U64)) % U64(n)).astype(np.int32)


def bucket_of(keys: tuple[np.ndarray, ...], cuts: np.ndarray) -> np.ndarray:
    """Bucket of every suffix among cuts, rows of WORDS and cover in order; equal suffixes share one."""
    first = np.ascontiguousarray(cuts[:, 0]) if len(cuts) else np.zeros(0, U64)
    low, high = np.searchsorted(first, keys[0], "left"), np.searchsorted(first, keys[0], "right")
    near = np.flatnonzero(high > low)  # a cut has the same first word: all words decide
    if len(near):
        order = multikey_sort(tuple(np.concatenate((cuts[:, i], keys[i][near])) for i in range(len(keys))))[0]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at = np.searchsorted(np.sort(place[: len(cuts)]), place[len(cuts) :])
        # a suffix that equals a cut is behind it, wherever the sort put it among equals
        later = np.minimum(at, len(cuts) - 1)
        equal = np.all([cuts[later, i] == keys[i][near] for i in range(len(keys))], axis=0) & (at < len(cuts))
        low[near] = at + equal
    return low.astype(np.int32)


def _found(row: np.ndarray, start: np.ndarray, n: np.ndarray, open_: bool, buckets: int) -> pa.RecordBatch:
    return dealt(_doc_bucket(row, buckets), row=row, start=start.astype(np.uint32), n=n.astype(np.uint8), open=np.full(len(row), open_))


def _find_anchors(cuts: np.ndarray, buckets: int, codes: tuple[int, ...]):
    """docs -> anchors by bucket (kind 0); repeats found within the batch, by document bucket (FOUND)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            for ids, names, buf, off in _batch_rows(batch):
                doc, at, low, high = anchors(buf, off)
                begin = off[doc]
                parts.append((ids[doc], names[doc], (at - begin).astype(np.uint32), (at - high).astype(np.uint8), (at - low).astype(np.uint8), *signed(buf, codes, at, low, high)))
            if not parts:
                continue
            doc, row, at, low, high, *key = (np.concatenate(x) for x in zip(*parts, strict=True))
            order, later = _earliest((key[-1], key[-2], key[0]), doc, at)
            lost = order[later]
            if len(lost):
                yield _kind(FOUND, _found(row[lost], at[lost] - high[lost], high[lost] - low[lost], False, buckets))
            k = np.sort(order[~later])  # by document and place, which packs best; the bucket sorts anyway
            if len(k):
                own = {name: v[k] for name, v in zip((*WORDS, "cover", "cover2"), key, strict=True)}
                yield _kind(0, dealt(bucket_of(tuple(own.values())[:-1], cuts), **own, doc=doc[k], row=row[k], at=at[k], low=low[k], high=high[k]))

    return run


def _kind(kind: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, kind), pa.int32()), *rows.columns], ["kind", "bucket", "blob"])


_SORTED_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary()), ("border", pa.int64()), ("lead", pa.binary())])


def _sorted_rows(kind: int, rows: pa.RecordBatch, border: int | None = None) -> pa.Table:
    n = rows.num_rows
    return pa.Table.from_arrays([pa.array([kind] * n, pa.int32()), *rows.columns, pa.array([border] * n, pa.int64()), pa.nulls(n, pa.binary())], schema=_SORTED_SCHEMA)


def _sort_bucket(buckets: int):
    """A bucket's anchors -> repeated and open windows by document bucket (FOUND), what depends on a border (EDGE), its ends (END).

    Border i lies before bucket i.
    """

    def run(table: pa.Table) -> pa.Table:
        own = table.column("bucket")[0].as_py()
        a = joined(table.column("blob").to_pylist(), _ANCHORS)
        words = tuple(a[w] for w in WORDS)
        order, _ = multikey_sort((*words, a["cover"], a["cover2"]))
        a = {k: v[order] for k, v in a.items()}
        differ = lambda names: np.concatenate(([True], np.any([a[w][1:] != a[w][:-1] for w in names], axis=0)))
        lead, whole = np.cumsum(differ(WORDS)) - 1, np.cumsum(differ((*WORDS, "cover", "cover2"))) - 1
        # the earliest of each suffix
        by = np.lexsort((a["at"], a["doc"], whole))
        head = by[run_starts(whole[by])][whole]
        later = (a["doc"] != a["doc"][head]) | (a["at"] != a["at"][head])
        covers = np.bincount(lead[run_starts(whole)])
        mixed = covers[lead] > 1
        start, n = a["at"] - a["high"], a["high"] - a["low"]
        out = [_sorted_rows(FOUND, _found(a["row"][later], start[later], n[later], False, buckets))]
        use = ~later & mixed
        out.append(_sorted_rows(FOUND, _found(a["row"][use], start[use], n[use], True, buckets)))
        # a group of one cover at an end of the bucket is open if it goes on beyond the border
        for group, border in ((0, own), (lead[-1], own + 1)):
            use = ~later & ~mixed & (lead == group)
            out.append(_sorted_rows(EDGE, _found(a["row"][use], start[use], n[use], True, buckets), border))
        ends = [b"".join(int(a[w][i]).to_bytes(8, "big") for w in WORDS) for i in (0, -1)]
        out.append(pa.Table.from_arrays([pa.array([END] * 2, pa.int32()), pa.array([own, own], pa.int32()), pa.nulls(2, pa.binary()), pa.array([own, own + 1], pa.int64()), pa.array(ends, pa.binary())], schema=_SORTED_SCHEMA))
        return pa.concat_tables(out)

    return run


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, row names, buf, off) of a document bucket, sorted by name."""
    names = table.column("row").combine_chunks().to_numpy().view(U64)
    order = np.argsort(names, kind="stable")
    ids = table.column("doc_id").combine_chunks().fill_null(_NULL).to_numpy(zero_copy_only=False)
    texts = table.column("text").combine_chunks().fill_null("").cast(pa.large_string()).take(pa.array(order))
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return ids[order], names[order], data[off[0] : off[-1]], off - off[0]


def _places(names: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into row, place among names) for every row of the name."""
    low, high = np.searchsorted(names, row, "left"), np.searchsorted(names, row, "right")
    n = high - low
    return np.repeat(np.arange(len(row)), n), np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _fits(start: np.ndarray, n: np.ndarray, row: np.ndarray, off: np.ndarray) -> np.ndarray:
    return start.astype(np.int64) + n + LENGTH <= (off[1:] - off[:-1])[row]


def _open_windows(buckets: int, codes: tuple[int, ...]):
    """Documents and what was found -> the open windows' keys, by bucket of the key (kind 0), repeats here (kind 1)."""

    def run(_key, docs: pa.Table, found: pa.Table) -> pa.Table:
        f = joined(found.column("blob").to_pylist(), _FOUND)
        f = {k: v[f["open"]] for k, v in f.items()}
        out = []
        if len(f["row"]) and docs.num_rows:
            ids, names, buf, off = _flat(docs)
            i, row = _places(names, f["row"])
            i, row = (x[_fits(f["start"][i], f["n"][i], row, off)] for x in (i, row))
            n = f["n"][i].astype(np.int64) + 1
            start = np.repeat(f["start"][i].astype(np.int64), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            doc, name, place = np.repeat(ids[row], n), np.repeat(names[row], n), np.repeat(off[row], n) + start
            one, two = np.empty(len(place), U64), np.empty(len(place), U64)
            # windows of one stretch of the bucket at a time: prefix sums of a few MB
            by = np.argsort(place, kind="stable")
            edges = np.searchsorted(place[by], np.arange(0, len(buf) + 1, 1 << 21))
            for a, b in zip(edges, np.append(edges[1:], len(by)), strict=True):
                if a == b:
                    continue
                k = by[a:b]
                base = place[k[0]]
                part = buf[base : place[k[-1]] + LENGTH]
                p = place[k] - base
                one[k], two[k] = span_names(part, p, p + LENGTH, codes)
            order, later = _earliest((one, two), doc, start)
            lost, keep = order[later], np.sort(order[~later])
            if len(lost):
                out.append(_kind(FOUND, _found(name[lost], start[lost], np.zeros(len(lost)), False, buckets)))
            bucket = ((mix(one[keep]) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int32)
            out.append(_kind(0, dealt(bucket, one=one[keep], two=two[keep], doc=doc[keep], row=name[keep], at=start[keep].astype(np.uint32))))
        return pa.Table.from_batches(out, pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary())]))

    return run


def _sort_windows(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        w = joined(table.column("blob").to_pylist(), _WINDOWS)
        order, later = _earliest((w["one"], w["two"]), w["doc"], w["at"])
        lost = order[later]
        return pa.Table.from_batches([_found(w["row"][lost], w["at"][lost], np.zeros(len(lost)), False, buckets)])

    return run


def _remove(_key, docs: pa.Table, found: pa.Table) -> pa.Table:
    ids, names, buf, off = _flat(docs)
    f = joined(found.column("blob").to_pylist(), _FOUND)
    f = {k: v[~f["open"]] for k, v in f.items()}
    i, row = _places(names, f["row"])
    i, row = (x[_fits(f["start"][i], f["n"][i], row, off)] for x in (i, row))
    order = np.argsort(row, kind="stable")
    i, row = i[order], row[order]
    n_rows, out, a = len(ids), [], 0
    while a < n_rows:  # some texts at a time, or one
        b = max(a + 1, int(np.searchsorted(off, off[a] + PART_BYTES, "right")) - 1)
        own = slice(*np.searchsorted(row, (a, b)))
        begin = off[row[own]] - off[a] + f["start"][i[own]]
        out.append(_kept(buf[off[a] : off[b]], off[a : b + 1] - off[a], begin, begin + f["n"][i[own]] + LENGTH))
        a = b
    size, removed, spans, digests = (np.concatenate(x) for x in zip(*out, strict=True)) if out else ([], [], [], [])
    return pa.table({"doc_id": pa.array(ids, pa.int64(), mask=ids == _NULL), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})


def _kept(buf: np.ndarray, off: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bytes, bytes removed, removed runs, digest of the rest) of each text, without begin to end of buf."""
    depth = np.bincount(begin, minlength=len(buf) + 1) - np.bincount(end, minlength=len(buf) + 1)
    gone = np.cumsum(depth[: len(buf)]) > 0
    total = np.concatenate(([0], np.cumsum(gone)))
    edge = gone.copy()
    edge[1:] &= ~gone[:-1]
    inner = off[:-1][off[:-1] < len(buf)]
    edge[inner] = gone[inner]  # a run ends with its text
    runs = np.concatenate(([0], np.cumsum(edge)))
    removed = total[off[1:]] - total[off[:-1]]
    digests = [hashlib.sha256((buf[a:b][~gone[a:b]] if r else buf[a:b]).tobytes()).hexdigest() for a, b, r in zip(off[:-1].tolist(), off[1:].tolist(), removed.tolist(), strict=True)]
    return np.diff(off), removed, runs[off[1:]] - runs[off[:-1]], np.array(digests, object)


def splitters_of(rows: DataFrame, n_bytes: int, buckets: int, codes: tuple[int, ...]) -> np.ndarray:
    """Different suffixes, WORDS and cover a row, that cut a bounded sample of them evenly; they steer balance, never the result."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, off in _batch_rows(batch):
                _, at, low, high = anchors(buf, off)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in signed(buf, codes, at, low, high)[:-1]], [*WORDS, "cover"])

    some = rows.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, SAMPLE_BYTES / max(n_bytes, 1))))
    got = some.mapInArrow(keys, ", ".join(f"{x} long" for x in (*WORDS, "cover"))).limit(SAMPLE_KEYS).toArrow()
    found = tuple(got.column(x).to_numpy().view(U64) for x in (*WORDS, "cover"))
    order = multikey_sort(found)[0]
    at = np.unique((np.arange(1, buckets) * len(order)) // buckets) if len(order) else np.zeros(0, np.int64)
    cuts = np.stack([x[order[at]] for x in found], axis=1) if len(at) else np.zeros((0, len(found)), U64)
    return cuts[np.concatenate(([True], np.any(cuts[1:] != cuts[:-1], axis=1)))] if len(cuts) else cuts


def _by_kind(sort, found):
    """Kind 0 is sorted; what is found already passes."""

    def run(table: pa.Table) -> pa.Table:
        return found(table) if table.column("kind")[0].as_py() == FOUND else sort(table)

    return run


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """What is left of every document; columns RESULT."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = tasks_for(n_bytes, bucket_bytes)
    codes = drawn_bases()
    cuts = splitters_of(rows, n_bytes, buckets, codes)
    by_kind = lambda df: df.withColumn("part", F.col("kind") * buckets + F.col("bucket")).repartitionById(2 * buckets, "part").groupBy("part")
    passed = lambda t: pa.concat_tables([_sorted_rows(FOUND, b) for b in t.select(["bucket", "blob"]).to_batches()])
    raw = rows.mapInArrow(_find_anchors(cuts, buckets, codes), _STEP)
    step = cut(by_kind(raw).applyInArrow(_by_kind(_sort_bucket(buckets), passed), _SORTED), "anchors", free=True)
    # neighbours' ends meet at their border; one row a bucket and side
    ends = step.where(F.col("kind") == END).select("border", "bucket", "lead")
    shared = ends.groupBy("border").agg(F.min("lead").alias("a"), F.max("lead").alias("b"), F.count_distinct("bucket").alias("n")).where("n = 2 and a = b").select("border")
    edges = step.where(F.col("kind") == EDGE).join(shared, "border", "left_semi").select("bucket", "blob")
    found = step.where(F.col("kind") == FOUND).select("bucket", "blob").unionByName(edges)

    def place(names: pa.Array) -> pa.Array:
        return pa.array(_doc_bucket(names.to_numpy().view(U64), buckets))

    place.__annotations__ = {"names": pa.Array, "return": pa.Array}
    placed = rows.withColumn("bucket", F.arrow_udf(place, "int")("row")).repartitionById(buckets, "bucket")
    windows = placed.groupBy("bucket").cogroup(found.repartitionById(buckets, "bucket").groupBy("bucket")).applyInArrow(_open_windows(buckets, codes), _STEP)
    more = by_kind(windows).applyInArrow(_by_kind(_sort_windows(buckets), lambda t: t.select(["bucket", "blob"])), BLOBS)
    # one query with the step before, so the documents' exchange serves both
    return placed.groupBy("bucket").cogroup(found.unionByName(more).repartitionById(buckets, "bucket").groupBy("bucket")).applyInArrow(_remove, RESULT)
