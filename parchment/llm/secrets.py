"""Secret scans with multipart credential linking.

Base patterns report strong spans by themselves: assign (a named value of 12 characters or more), access (an
access identifier) and hex (16 hexadecimal digits or more).  Three weak kinds could be anything and are
reported only where complementary parts stand within SCOPE code points of them in the same text:

* key: 40 characters of the base64 alphabet, beside an identifier (access or user)
* user: a named login or client, beside a secret (assign or key)
* endpoint: the address of a service, beside an identifier and a secret

A scope never leaves its text, and a text's spans are already together, so the interval join runs inside each
text's arrays and shuffles nothing: the parts' starts and ends are sorted, and each span looks up the next start and
the last end by halving.  Work grows as n log n in a text's matches.  Everything is a JVM expression.

Edge cases.  A null text counts as empty and has no spans.  Spans of different kinds may overlap and are all
reported; order is by start, then kind as listed.  Repeated rows give repeated results.  Extra columns pass
through; a column that already has an output's name is replaced by the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import fresh
from parchment.llm.spans import WORD, first_not_below, let, mask, none, spans_of

KINDS = ("assign", "access", "hex", "key", "user", "endpoint")
BASE_KINDS = KINDS[:3]
SCOPE = 240

_NAMED = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN_HEAD = r"(?i:password|passwd|secret|token|api_?key)" + _NAMED
ASSIGN = ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
USER = WORD + r"(?i:(?:user(?:name)?|login|account|client_?id))" + _NAMED + r"[A-Za-z0-9@_.-]{3,}"
ENDPOINT = WORD + r"[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9.-]+(?::[0-9]{1,5})?"


def _places(*spans: Column) -> tuple[Column, Column]:
    """(starts, ends) of several spans, each in order: what an interval join by sorted places needs."""
    every = F.concat(*spans)
    return F.array_sort(F.transform(every, lambda s: s["start"])), F.array_sort(F.transform(every, lambda s: s["end"]))


def _near(a: Column, starts: Column, ends: Column) -> Column:
    """Whether a part begins within SCOPE after a's end, or ends within SCOPE before a's start."""
    after = F.get(starts, first_not_below(starts, a["end"])) - a["end"]
    before = a["start"] - F.get(ends, first_not_below(ends, a["start"] + 1) - 1)
    return F.coalesce(after <= SCOPE, F.lit(False)) | F.coalesce(before <= SCOPE, F.lit(False))


def _overlaps(a: Column, others: Column) -> Column:
    """Whether a overlaps one of others, which are in order and don't overlap each other."""
    later = F.get(others, first_not_below(F.transform(others, lambda b: b["end"]), a["start"] + 1))
    return F.coalesce(later["start"] < a["end"], F.lit(False))


def _joined(found: Column, places: tuple[Column, Column], use) -> Column:
    """use(found, near), near telling whether a span has a part of places in scope."""
    starts, ends = places
    return F.when(F.size(found) > 0, let(starts, lambda s: let(ends, lambda e: use(found, lambda a: _near(a, s, e))))).otherwise(F.slice(use(found, lambda a: F.lit(False)), 1, 0))


def _typed(kind: str, found: Column, places: tuple[Column, Column]) -> Column:
    def named(found: Column, near) -> Column:
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), near(s).alias("linked")))

    return _joined(found, places, named)


def _beside(found: Column, places: tuple[Column, Column]) -> Column:
    """The spans that have a part of places in scope."""
    return _joined(found, places, lambda found, near: F.filter(found, near))


def with_spans(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """docs with out: array<struct<start, rank, end, kind, linked>>; linked tells whether a complementary part is in scope."""
    kept = [F.col(c) for c in docs.columns if c.lower() != out.lower()]
    names = {k: fresh(docs, f"__{k}") for k in ("text", *KINDS)}
    t, assign, access, hexes, key, user, endpoint = (F.col(names[k]) for k in ("text", *KINDS))

    def step(d: DataFrame, kind: str, value: Column) -> DataFrame:
        return d.withColumn(names[kind], value)

    d = step(docs, "text", F.coalesce(F.col(text), F.lit("")))
    # a cheap search spares most texts the pattern; long enough runs are looked for once
    long = F.filter(spans_of(t, ASSIGN), lambda s: F.length(F.regexp_replace(s["value"], "^" + ASSIGN_HEAD, "")) >= 12)
    d = step(d, "assign", F.when(t.rlike(r"[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{12}"), long).otherwise(none()))
    d = step(d, "access", F.when(t.contains("AKIA"), spans_of(t, ACCESS)).otherwise(none()))
    d = step(d, "hex", F.when(t.rlike(HEX), spans_of(t, HEX)).otherwise(none()))
    some = (F.size(assign) > 0) | (F.size(access) > 0)  # no weak part is reported without one of these, or a key and a user
    d = step(d, "user", F.when(some | t.rlike(KEY), spans_of(t, USER)).otherwise(none()))
    d = step(d, "key", F.when((F.size(access) > 0) | (F.size(user) > 0), spans_of(t, KEY)).otherwise(none()))
    # weak parts stay only beside their complement; a key that overlaps a strong span is that span
    lone = F.filter(key, lambda s: ~(_overlaps(s, assign) | _overlaps(s, access) | _overlaps(s, hexes)))
    d = step(d, "key", F.when(F.size(key) > 0, _beside(lone, _places(access, user))).otherwise(none()))
    d = step(d, "user", _beside(user, _places(assign, key)))
    both = ((F.size(access) > 0) | (F.size(user) > 0)) & ((F.size(assign) > 0) | (F.size(key) > 0))
    d = step(d, "endpoint", F.when(both, _beside(_beside(spans_of(t, ENDPOINT), _places(access, user)), _places(assign, key))).otherwise(none()))
    ids, secrets = _places(access, user), _places(assign, key)
    found = [_typed("assign", assign, ids), _typed("access", access, secrets), _typed("hex", hexes, ids), _typed("key", key, ids), _typed("user", user, secrets), _typed("endpoint", endpoint, secrets)]
    # fields are in the order of sorting
    return d.select(*kept, F.array_sort(F.concat(*found)).alias(out))


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every reported span replaced by [KIND]."""
    tmp = fresh(docs, "__secrets")
    return with_spans(docs, text, tmp).withColumn(text, mask(F.col(text), F.col(tmp))).drop(tmp)
