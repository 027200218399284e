"""The span operators as SQL: the same spans, scores and links by joins of rows instead of arrays in a row."""

from __future__ import annotations

from parchment.llm import pii, secrets
from parchment.llm.spans import WORD, WORD_END


def _quoted(x: str) -> str:
    """A literal; DuckDB's patterns know no look-around, and their \\b is of ASCII."""
    x = x.replace(WORD, r"\b").replace(WORD_END, r"\b")
    return "'" + x.replace("'", "''") + "'"


def _matches(kinds: list[tuple[str, str]]) -> str:
    """CTEs d and hits: (doc_id, kind, rank, v, s, e) of every match of every kind's pattern."""
    rows = ", ".join(f"({_quoted(k)}, {i}, {_quoted(p)})" for i, (k, p) in enumerate(kinds))
    return f"""d as (select doc_id, coalesce(text, '') t from documents),
kinds(kind, rank, pat) as (values {rows}),
found as (select doc_id, kind, rank, regexp_extract_all(t, pat) m, string_split_regex(t, pat) g from d, kinds),
flat as (select doc_id, kind, rank, unnest(m) v, unnest(g[:len(m)]) gap, unnest(range(len(m))) i from found),
hits as (select doc_id, kind, rank, v, (e - length(v))::bigint s, e::bigint e from (select *, sum(length(gap) + length(v)) over (partition by doc_id, kind order by i) e from flat))"""


def _summed(base: tuple[str, ...], more: str) -> str:
    """The digest columns over CTE spans (doc_id, kind, rank, s, e and others)."""
    counts = ", ".join(f"count(*) filter (kind = '{k}')::bigint n_{k}" for k in base)
    strong = ", ".join(_quoted(k) for k in base)
    one = "kind || ':' || s || ':' || e"
    return f"""r as (select doc_id, {counts}, string_agg({one}, ',' order by s, rank, e) filter (kind in ({strong})) b, string_agg({one}, ',' order by s, rank, e) a, {more} from spans group by doc_id)
select d.doc_id, {", ".join(f"coalesce(n_{k}, 0)::bigint n_{k}" for k in base)}, sha256(coalesce(b, '')) base_sha256, coalesce(a, '') spans"""


def _near(a: str, b: str) -> str:
    return f"exists (select 1 from {b} y where y.doc_id = {a}.doc_id and (y.s - {a}.e between 0 and {secrets.SCOPE} or {a}.s - y.e between 0 and {secrets.SCOPE}))"


SECRETS = f"""with {_matches([("assign", secrets.ASSIGN), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+"), ("key", "[A-Za-z0-9+/]+=?"), ("user", secrets.USER), ("endpoint", secrets.ENDPOINT)])},
strong as (select * from hits where case kind when 'assign' then length(regexp_replace(v, {_quoted("^" + secrets.ASSIGN_HEAD)}, '')) >= 12 when 'access' then length(v) >= 18 when 'hex' then length(v) >= 16 end),
users as (select * from hits where kind = 'user'),
parts as (select * from strong where kind = 'access' union all select * from users),
keys as (select * from hits where kind = 'key' and length(v) = 40 and v not like '%=' and {_near("hits", "parts")}
  and not exists (select 1 from strong b where b.doc_id = hits.doc_id and b.s < hits.e and hits.s < b.e)),
secret as (select * from strong where kind = 'assign' union all select * from keys),
user as (select * from users where {_near("users", "secret")}),
ids as (select * from strong where kind = 'access' union all select * from user),
ends as (select * from hits where kind = 'endpoint' and {_near("hits", "ids")} and {_near("hits", "secret")}),
every as (select * from strong union all select * from keys union all select * from user union all select * from ends),
spans as (select *, case when kind in ('access', 'user', 'endpoint') then {_near("every", "secret")} else {_near("every", "ids")} end linked from every),
{_summed(secrets.BASE_KINDS, "count(*) filter (linked)::bigint n")}, coalesce(n, 0)::bigint n_linked from d left join r using (doc_id)"""


def _digits(v: str) -> str:
    return f"regexp_replace({v}, '[^0-9]', '', 'g')"


_LUHN = f"""list_sum(list_transform(range(length({_digits("v")})), lambda i: case when i % 2 = 0 then substr(reverse({_digits("v")}), i + 1, 1)::int
  else (2 * substr(reverse({_digits("v")}), i + 1, 1)::int) % 10 + (2 * substr(reverse({_digits("v")}), i + 1, 1)::int) // 10 end)) % 10 = 0"""


def _checks(v: str) -> str:
    """Whether an account number has remainder 1 modulo 97."""
    bare = f"replace({v}, ' ', '')"
    numbers = f"list_transform(string_split(substr({bare}, 5) || substr({bare}, 1, 4), ''), lambda c: case when c between '0' and '9' then c else (ascii(c) - 55)::varchar end)"
    rest = f"list_reduce(list_transform(string_split(array_to_string({numbers}, ''), ''), lambda c: c::int), lambda a, c: (a * 10 + c) % 97)"
    return f"case when length({bare}) between 15 and 34 then {rest} = 1 else false end"


_SHORT = r"regexp_replace(v, '\x20[A-Z0-9]{1,3}$', '')"
_WORDS = " ".join(f"when '{k}' then {_quoted(w)}" for k, w in pii.CONTEXT_WORDS.items())
_SCORE = " ".join(f"when '{k}' then {x}" for k, x in pii.BASE_SCORE.items())
_BASE = ", ".join(_quoted(k) for k in pii.BASE_KINDS)

PII = f"""with {_matches([("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+"), ("ip", "[0-9]+([.][0-9]+)([.][0-9]+)([.][0-9]+)"), ("card", "[0-9]([ -]?[0-9])+"), ("phone", "[+][0-9][ ().0-9-]+[0-9]"), ("iban", pii.IBAN)])},
likely as (select *, coalesce(lag(e) over w, 0) low, lead(s) over w high from hits where kind <> 'card' or length(v) >= 14 window w as (partition by doc_id, kind order by s)),
around as (select l.*, right(substr(t, low + 1, s - low), {pii.CONTEXT}) before, left(substr(t, e + 1, coalesce(high, length(t)) - e), {pii.CONTEXT}) after from likely l join d using (doc_id)),
good as (select doc_id, kind, rank, before, after, s, case when kind = 'iban' and not ({_checks("v")}) then s + length({_SHORT}) else e end e from around where case kind
  when 'email' then true when 'ip' then list_max(list_transform(string_split(v, '.'), lambda p: p::hugeint)) <= 255
  when 'card' then length({_digits("v")}) between 14 and 19 and {_LUHN} when 'phone' then length({_digits("v")}) between 10 and 15
  else {_checks("v")} or {_checks(_SHORT)} end),
scored as (select *, round(case kind {_SCORE} end + case when regexp_matches(before, case kind {_WORDS} end) or regexp_matches(after, case kind {_WORDS} end) then {pii.CONTEXT_GAIN} else 0 end
  - case when regexp_matches(before, {_quoted(pii.OTHER_WORDS)}) or regexp_matches(after, {_quoted(pii.OTHER_WORDS)}) then {pii.CONTEXT_LOSS} else 0 end, 2)::double score from good),
spans as (select * from scored where kind in ({_BASE}) or score >= {pii.LEAST}),
{_summed(pii.BASE_KINDS, "string_agg(score::varchar, ',' order by s, rank, e) x")}, coalesce(x, '') scores from d left join r using (doc_id)"""
