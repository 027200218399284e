"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything runs as JVM expressions on whole texts.  Places are in code points.

Patterns that repeat a group would recurse once a repetition and overflow the stack on very long texts, so
single characters that join two others (a blank between digits, a dot between labels) are first exchanged
for a marker of the same length, after which runs of one character class say the same.

Kinds: email, ip, card (Luhn), phone, and iban (ISO 7064 mod 97), which the method adds.  A span's score starts at
its kind's, rises by CONTEXT_GAIN where one of the kind's words stands near it and falls by CONTEXT_LOSS where a word
stands near that speaks of numbers of another sort.  Kinds that the method adds are reported from LEAST up, so
context can reject them; base kinds are always reported, with their score.

Edge cases.  A null text counts as empty and has no spans.  Spans of different kinds may overlap and are all
reported; order is by start, then kind as listed.  Repeated rows give repeated results.  Extra columns pass
through; a column that already has an output's name is replaced by the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import fresh
from parchment.llm.spans import WORD, WORD_END, mask, none, spans_of

KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]
#: Characters before and after a span, up to the next match of its pattern, in which words count.
CONTEXT = 40
CONTEXT_GAIN, CONTEXT_LOSS, LEAST = 0.2, 0.4, 0.5
#: Words that make a span of a kind likelier.
CONTEXT_WORDS = {
    "email": "(?i)" + WORD + r"(e-?mail|mail|contact|write|correo|courriel)" + WORD_END,
    "ip": "(?i)" + WORD + r"(ip|host|server|address|addr|serveur|servidor)" + WORD_END,
    "card": "(?i)" + WORD + r"(card|visa|mastercard|amex|credit|debit|carte|tarjeta|karte)" + WORD_END,
    "phone": "(?i)" + WORD + r"(phone|tel|call|mobile|fax|whatsapp|telefon|telefono)" + WORD_END,
    "iban": "(?i)" + WORD + r"(iban|bank|account|konto|compte|cuenta)" + WORD_END,
}
#: Words that make any span less likely.
OTHER_WORDS = "(?i)" + WORD + r"(isbn|sku|invoice|serial|part no|order no|version|build|checksum|example|dummy|sample)" + WORD_END
BASE_SCORE = {"email": 0.7, "ip": 0.5, "card": 0.6, "phone": 0.5, "iban": 0.8}

IBAN = WORD + r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?" + WORD_END

_JOIN, _DOT = "\x01", "\x02"
_LABEL = "A-Za-z0-9-"
_LOCAL = "A-Za-z0-9._%+" + _DOT + "-"


def joined_digits(text: Column) -> Column:
    """text with each single blank or hyphen between two digits exchanged for a marker."""
    return F.regexp_replace(F.translate(text, _JOIN, "\x03"), r"(?<=[0-9])[\x20-](?=[0-9])", _JOIN)


def joined_labels(text: Column) -> Column:
    """text with each dot between two label characters exchanged for a marker."""
    return F.regexp_replace(F.translate(text, _DOT, "\x03"), rf"(?<=[{_LABEL}])\.(?=[{_LABEL}])", _DOT)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    n = F.length(number)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        F.lit(0),
        lambda acc, i: acc
        + F.when((n - i) % 2 == 1, (F.substr(number, i, F.lit(1)).cast("int") * 2) % 10 + F.floor(F.substr(number, i, F.lit(1)).cast("int") / 5).cast("int")).otherwise(F.substr(number, i, F.lit(1)).cast("int")),
    )
    return F.when(n > 0, total % 10 == 0).otherwise(False)


def mod97(account: Column) -> Column:
    """Whether an upper-case IBAN without blanks has remainder 1 modulo 97."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), lambda acc, c: F.when(c.between("0", "9"), acc * 10 + value(c)).otherwise(acc * 100 + value(c)) % 97)
    return rest == 1


def _account(s: Column) -> Column:
    """The span if its digits check; else without a last short group, which may be a word; else null."""

    def good(value: Column) -> Column:
        account = F.replace(value, F.lit(" "), F.lit(""))
        return F.when(F.length(account).between(15, 34), mod97(account)).otherwise(False)

    short = F.regexp_replace(s["value"], r"\x20[A-Z0-9]{1,3}\z", "")
    cut = F.struct(s["start"].alias("start"), (s["start"] + F.length(short)).alias("end"), short.alias("value"), s["before"].alias("before"), s["after"].alias("after"))
    return F.when(good(s["value"]), s).when(good(short), cut)


def _typed(kind: str, found: Column) -> Column:
    """Spans of a kind with a score from its pattern, checksum and the words around it."""

    def one(s: Column) -> Column:
        near = lambda words: s["before"].rlike(words) | s["after"].rlike(words)
        score = F.lit(BASE_SCORE[kind]) + F.when(near(CONTEXT_WORDS[kind]), CONTEXT_GAIN).otherwise(0.0) - F.when(near(OTHER_WORDS), CONTEXT_LOSS).otherwise(0.0)
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), F.round(score, 2).alias("score"))

    scored = F.transform(found, one)
    return scored if kind in BASE_KINDS else F.filter(scored, lambda s: s["score"] >= LEAST)


def _only(needed: Column, found: Column) -> Column:
    """found where the text can hold one at all; a cheap search spares the others the pattern."""
    return F.when(needed, found).otherwise(none())


def with_spans(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """docs with out: array<struct<start, rank, end, kind, score>>, by start, then kind as listed."""
    kept = [F.col(c) for c in docs.columns if c.lower() != out.lower()]
    names = [fresh(docs, x) for x in ("__text", "__digit_text", "__label_text")]
    raw, digit, label = (F.col(x) for x in names)
    # the marked texts are made once a row, by a projection of their own
    d = docs.withColumn(names[0], F.coalesce(F.col(text), F.lit(""))).withColumn(names[1], joined_digits(raw)).withColumn(names[2], F.when(raw.contains("@"), joined_labels(raw)))
    # a match begins where a run of local characters does, or where the match before it ended
    email = _only(label.isNotNull(), spans_of(label, rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++{_DOT}[{_LABEL}{_DOT}]+", CONTEXT))
    ip = spans_of(raw, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+", CONTEXT)
    ip = F.filter(ip, lambda s: ~F.exists(F.split(s["value"], r"\."), lambda p: ~p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$")))
    card = spans_of(digit, rf"[0-9][0-9{_JOIN}]{{13,}}", CONTEXT)
    card = F.filter(card, lambda s: F.when(F.length(digits(s["value"])).between(14, 19), luhn(digits(s["value"]))).otherwise(False))
    phone = _only(raw.contains("+"), spans_of(raw, r"\+[0-9][\x20().0-9-]+[0-9]", CONTEXT))
    phone = F.filter(phone, lambda s: F.length(digits(s["value"])).between(10, 15))
    iban = spans_of(raw, IBAN, CONTEXT)
    iban = F.array_compact(F.transform(iban, _account))
    found = F.concat(*(_typed(k, c) for k, c in zip(KINDS, (email, ip, card, phone, iban), strict=True)))
    # fields are in the order of sorting
    return d.select(*kept, F.array_sort(found).alias(out))


def masked(docs: DataFrame, text: str = "text", least: float = LEAST) -> DataFrame:
    """docs whose spans with a score of least or more are replaced by [KIND]."""
    tmp = fresh(docs, "__pii")
    d = with_spans(docs, text, tmp)
    return d.withColumn(text, mask(F.col(text), F.filter(F.col(tmp), lambda s: s["score"] >= least))).drop(tmp)
