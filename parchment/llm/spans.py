"""Places of pattern matches in whole texts as JVM expressions: no Python code, no shuffle.

Work grows as n log n in a text's matches.  A fold that appends to its array would copy it at each step, so running
values come from doubling (each pass adds the value 2**k places before), searches halve a sorted array, and
a text is cut at many places by halving the list of places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where a word begins and ends; what \\b takes for a letter differs between versions of the JVM.
WORD, WORD_END = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
SPANS = "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"


def none() -> Column:
    return F.array().cast(SPANS)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _halvings(n: Column) -> Column:
    """1 to the number of times that n things can be halved, at least once."""
    return F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(n + 1)).cast("int"), F.lit(1)))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """combine() over each value and all before it, for an associative combine()."""

    def add(acc: Column, k: Column) -> Column:
        back = F.pow(F.lit(2), k - 1).cast("int")
        return F.transform(acc, lambda v, i: F.when(i >= back, combine(F.get(acc, i - back), v)).otherwise(v))

    return F.when(F.size(values) > 1, F.aggregate(_halvings(F.size(values) - 1), values, add)).otherwise(values)


def first_not_below(ordered: Column, x: Column) -> Column:
    """Index of the first element of an ordered array that is x or more; its size if none is."""

    def step(acc: Column, _: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        right = F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))
        left = F.struct(acc["lo"].alias("lo"), mid.alias("hi"))
        return F.when(acc["lo"] >= acc["hi"], acc).when(F.get(ordered, mid) < x, right).otherwise(left)

    whole = F.struct(F.lit(0).alias("lo"), F.size(ordered).alias("hi"))
    return F.aggregate(_halvings(F.size(ordered)), whole, step, lambda acc: acc["lo"])


def spans_of(text: Column, pattern: str, context: int = 0) -> Column:
    """SPANS of the leftmost non-overlapping matches, in code points; end is exclusive.

    split() gives the gaps between matches and regexp_extract_all() the matches; their running lengths are the
    places.  before and after are the ends of the gaps on both sides, of at most context characters.
    """

    def place(found: Column, gaps: Column) -> Column:
        sizes = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: (F.length(g) + F.length(m)).cast("long"))
        side = lambda f, g: f(g, F.lit(context)) if context else F.lit("")

        def one(ends: Column) -> Column:
            return F.transform(
                found,
                lambda m, i: F.struct(
                    (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("value"),
                    side(F.right, F.get(gaps, i)).alias("before"), side(F.left, F.get(gaps, i + 1)).alias("after"),
                ),
            )

        return let(running(sizes, lambda a, b: a + b), one)

    some = lambda found: F.when(F.size(found) > 0, let(F.split(text, pattern, -1), lambda gaps: place(found, gaps))).otherwise(none())
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), some)


def digest(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pieces(text: Column, cuts: Column) -> Column:
    """text cut at rising places: one string more than there are cuts."""

    def halves(s: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        size = (F.get(cuts, mid) - s["at"]).cast("int")
        left = F.struct(F.substr(s["t"], F.lit(1), size).alias("t"), s["at"].alias("at"), s["lo"].alias("lo"), mid.alias("hi"))
        right = F.struct(F.substr(s["t"], size + 1).alias("t"), F.get(cuts, mid).alias("at"), (mid + 1).alias("lo"), s["hi"].alias("hi"))
        return F.array(left, right)

    whole = F.array(F.struct(text.alias("t"), F.lit(0).cast("long").alias("at"), F.lit(0).alias("lo"), F.size(cuts).alias("hi")))
    step = lambda acc, _: F.flatten(F.transform(acc, lambda s: F.when(s["lo"] < s["hi"], halves(s)).otherwise(F.array(s))))
    return F.aggregate(_halvings(F.size(cuts)), whole, step, lambda acc: F.transform(acc, lambda s: s["t"]))


def mask(text: Column, spans: Column) -> Column:
    """text with each span replaced by [KIND]; of overlapping spans the first names the whole."""

    def groups(spans: Column, reach: Column) -> Column:
        heads = F.filter(
            F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), i.alias("i"))),
            lambda h: F.coalesce(h["start"] >= F.get(reach, h["i"] - 1), F.lit(True)),
        )
        ended = lambda heads: F.transform(
            heads, lambda h, j: F.struct(h["start"].alias("start"), F.get(reach, F.coalesce(F.get(heads, j + 1)["i"], F.size(spans)) - 1).alias("end"), h["kind"].alias("kind"))
        )
        return let(heads, ended)

    def joined(groups: Column) -> Column:
        cuts = F.flatten(F.transform(groups, lambda g: F.array(g["start"], g["end"])))
        name = lambda i: F.concat(F.lit("["), F.upper(F.get(groups, F.shiftright(i, 1))["kind"]), F.lit("]"))
        return let(cuts, lambda cuts: F.array_join(F.transform(pieces(text, cuts), lambda p, i: F.when(i % 2 == 0, p).otherwise(name(i))), ""))

    reach = lambda spans: running(F.transform(spans, lambda s: s["end"]), F.greatest)
    whole = lambda spans: let(reach(spans), lambda r: let(groups(spans, r), joined))
    return F.when(F.size(spans) > 0, let(spans, whole)).otherwise(text)
