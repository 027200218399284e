"""SQL, in DuckDB's dialect, of the operators on vectors and phrases."""

from __future__ import annotations

from parchment.llm import collocations, embedding_dedup, hamerly


def clusters_sql(clusters: int = hamerly.CLUSTERS, rounds: int = hamerly.ROUNDS, size: int = hamerly.DIMENSIONS) -> str:
    """Lloyd's rounds, every distance computed."""
    near = "select r, c, d from (select q.r, s.c, {d} d, row_number() over (partition by q.r order by {d}, s.c) k from q cross join s{i} s) where k = 1"
    d = "list_sum(list_transform(list_zip(q.q, s.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"a{i} as materialized ({near.format(d=d, i=i)})")
        if i < rounds:
            steps.append(f"m{i} as (select a{i}.c, i, sum(q.q[i]) s, count(*) n from a{i} join q using (r), range(1, {size + 1}) t(i) group by all)")
            steps.append(f"v{i} as (select c, list((case when s >= 0 then s // n else -((n - 1 - s) // n) end)::bigint order by i) q from m{i} group by c)")
            steps.append(f"s{i + 1} as materialized (select s.c, coalesce(v.q, s.q) q from s{i} s left join v{i} v using (c))")
    limit = hamerly.LIMIT
    return f"""
with e as (select row_number() over () r, vec_id, embedding e from embeddings
  where len(embedding) = {size} and len(list_filter(embedding, lambda x: x is not null and isfinite(x::double))) = {size}),
q as materialized (select r, vec_id, list_transform(e, lambda x: greatest(least(floor({hamerly.SCALE} * x::double), {limit}), -{limit})::bigint) q from e),
s0 as materialized (select row_number() over (order by h nulls last, q) - 1 c, q from (select q, sha256('2:' || vec_id) h from q) order by h nulls last, q limit {clusters}),
{", ".join(steps)}
select vec_id, a.c::int "cluster", d::bigint distance, sum(d) over (partition by a.c)::bigint cluster_inertia, sum(d) over ()::bigint inertia, sha256(array_to_string(s.q, ',')) centroid_sha256
from a{rounds} a join q using (r) join s{rounds} s on s.c = a.c"""


def collocations_sql(least: int = collocations.LEAST, covered: int = collocations.COVERED, top: int = collocations.TOP) -> str:
    """All phrases of one to three words, counted; cuts and covers by joins."""
    score = f"({collocations.SCALE}::hugeint * a * a) // (l::hugeint * r)"
    return rf"""
with t as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') x from documents),
p as (select lang, unnest(string_split_regex(x, '[.,;:!?\x0A-\x0D]')) p from t),
w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') w from p),
n as (select lang, sum(len(w)) n from w group by lang),
f as materialized (select lang, k, g, count(*) f from (
  select lang, 1 k, unnest(w) g from w
  union all select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from w
  union all select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from w) group by all having count(*) >= {least}),
c as (select lang, k, g, f a, string_split(g, ' ') s from f where k > 1),
u as (select lang, g, k, a, s, unnest(range(1, k)) cut from c),
x as (select u.lang, u.g, u.k, a, cut, x.f l, y.f r from u
  join f x on x.lang = u.lang and x.g = array_to_string(s[1:cut], ' ') and x.k = cut
  join f y on y.lang = u.lang and y.g = array_to_string(s[cut + 1:], ' ') and y.k = u.k - cut),
b as (select *, {score} score, row_number() over (partition by lang, k, g order by {score}, cut) z from x),
h as (select lang, unnest([array_to_string(s[1:2], ' '), array_to_string(s[2:3], ' ')]) g, a whole from c where k = 3),
o as (select lang, g, max(whole) whole from h group by all),
k as (select b.*, row_number() over (partition by b.lang order by score desc, a desc, b.g collate "C") rank from b left join o on o.lang = b.lang and o.g = b.g and b.k = 2
  where z = 1 and (whole is null or 100 * whole < {covered} * a))
select lang, rank::bigint rank, g phrase, a::bigint a, l::bigint l, r::bigint r, n::bigint n, score::bigint score from k join n using (lang) where rank <= {top}"""


def grouped_sql(threshold: float = embedding_dedup.THRESHOLD) -> str:
    """Every pair compared; what each vector reaches by links, whole."""
    return f"""
with recursive v as (select row_number() over () i, vec_id, embedding::double[] e from embeddings),
g as materialized (select i, vec_id, e from v where len(e) > 0 and len(list_filter(e, lambda x: x is not null and isfinite(x))) = len(e) and len(list_filter(e, lambda x: x <> 0)) > 0),
p as materialized (select a.i a, b.i b, b.vec_id v from g a join g b on a.i <> b.i and case when len(a.e) = len(b.e) then list_cosine_similarity(a.e, b.e) >= {threshold} else false end),
r as (select i, i j from v union select r.i, p.b from r join p on p.a = r.j),
m as (select r.i, min(vec_id) component_id from r join v on v.i = r.j group by r.i),
n as (select a i, count(*) n from p group by a)
select vec_id, coalesce(n, 0)::bigint n_links, component_id, coalesce(vec_id = component_id, false) kept from v join m using (i) left join n using (i)"""
