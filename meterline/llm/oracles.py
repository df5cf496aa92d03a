"""DuckDB SQL for the registered queries that SQL can express, written from the contracts."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_BASE32 = " || ".join(
    f"substr('{UPPER}234567', 1 + ((g{i} >> {shift}) & 31)::int, 1)" for i in range(4) for shift in range(35, -1, -5)
)

OP1 = f"""
with p as (
  select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
g as (
  select *, max(page_id) over (partition by body) as keeper,
    {", ".join(f"('0x' || substr(h, {10 * i + 1}, 10))::ubigint as g{i}" for i in range(4))}
  from p)
select page_id, strlen(body)::bigint as payload_bytes, {_BASE32} as payload_digest,
  case when page_id = keeper then 'response' else 'revisit' end as record_type,
  case when page_id <> keeper then keeper end as refers_to
from g
"""

OP4 = f"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words
  from documents),
s as (
  select doc_id, unnest(list_distinct(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end)) as shingle
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
-- Texts of the same set join through their smallest id, so the pairs below stay few.
sets as (select doc_id, n, md5(string_agg(shingle, chr(10) order by shingle)) as name from s join n using (doc_id) group by all),
rep as (select name, min(doc_id) as rep, any_value(n) as n from sets group by name),
k as (select rep, shingle, rep.n from rep join s on s.doc_id = rep.rep),
pairs as (
  select a.rep as a, b.rep as b from k a join k b on a.shingle = b.shingle and a.rep < b.rep
  group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links as (select a, b from pairs union all select b, a from pairs),
reach as (
  select rep as node, rep as seen from rep union
  select r.node, l.b from reach r join links l on l.a = r.seen),
root as (select node, min(seen) as root from reach group by node)
select d.doc_id, coalesce(sets.n, 0)::bigint as n_shingles, coalesce(root.root, d.doc_id) as component_id
from documents d left join sets on sets.doc_id = d.doc_id
left join rep on rep.name = sets.name left join root on root.node = rep.rep
"""

#: Verdict, host, path; longest first.
_RULES = (
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
    ("block", "net", "/"),
)
#: Expressions over host and path, in their order; all block.
_PATTERNS = (
    r"(?:^|[.-])cheap-pills[.-]", r"(?:^|[.-])cheap-[a-z]+\.", r"(?:^|[.-])casino[.-]", r"(?:^|[.-])poker[.-]",
    r"(?:^|[.-])betting[.-]", r"(?:^|[.-])viagra[.-]", r"(?:^|[.-])xxx[.-]", r"(?:^|[.-])porn[.-]",
    r"^(?:[^?]*\.)?ads\.[^?]+\?", r"^(?:[^?]*\.)?adserver[.-][^?]*\?", r"^(?:[^?]*\.)?tracker\.[^?]+\?",
    r"(?:^|[.-])free-download[.-]", r"(?:^|[.-])payday-loans?[.-]", r"\?(?:.*/)?wp-login\.", r"\?(?:.*/)?cgi-bin/",
    r"\?(?:.*)/affiliate/", r"\?(?:.*)/sponsored/", r"\?(?:.*)/torrent/", r"\?(?:.*)/warez/", r"\?(?:.*)/phishing/",
)


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')"


OP10 = f"""
with u as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), '{UPPER}', '{UPPER.lower()}') as host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') as path
  from pages),
r as (
  select *, case {" ".join(f"when {_fits(h, p)} then '{h}{p}'" for _, h, p in _RULES)} end as rule,
    case {" ".join(f"when regexp_matches(host || '?' || path, '{p}', 's') then '{p}'" for p in _PATTERNS)} end as hit
  from u)
select page_id, host, path, rule,
  case {" ".join(f"when rule = '{h}{p}' then '{v}'" for v, h, p in _RULES)}
    when hit is not null then 'block' else 'allow' end as verdict,
  case when rule is null then hit end as pattern
from r
"""



def _round(t: int) -> str:
    """Assignment ``a`` of the parts to the codebooks ``b`` of a round."""
    return f"""
d{t} as materialized (
  select e.vec_id, e.part, b.entry, sum((e.val - b.val) * (e.val - b.val)) as d
  from e join b{t} b on e.part = b.part and e.pos = b.pos group by all),
a{t} as materialized (
  select * from d{t} qualify row_number() over (partition by vec_id, part order by d, entry) = 1)"""


def _means(t: int) -> str:
    """Codebooks of the round after ``t``: floor of sum by count."""
    return f"""
m{t} as (
  select a.part, a.entry, e.pos, sum(e.val)::bigint as s, count(*) as n
  from a{t} a join e on a.vec_id = e.vec_id and a.part = e.part group by all),
b{t + 1} as materialized (
  select b.part, b.entry, b.pos, coalesce((s - ((s % n) + n) % n) // n, b.val) as val
  from b{t} b left join m{t} m on b.part = m.part and b.entry = m.entry and b.pos = m.pos)"""


OP11 = f"""
with k as materialized (
  select vec_id, label, embedding as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select vec_id, v, unnest(range(1, len(v) + 1)) as i, len(v) // 4 as width from k),
e as materialized (
  select vec_id, (i - 1) // width as part, (i - 1) % width as pos, floor(v[i]::double * 1024)::bigint as val from p),
first as (select vec_id, row_number() over (order by vec_id) - 1 as entry from k qualify entry < 256),
b0 as materialized (select part, entry, pos, val from e join first using (vec_id)),
{",".join(x for t in range(4) for x in (_round(t), _means(t)))},{_round(4)},
c as (
  select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error from a4 group by vec_id)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  (select sha256(string_agg(val::varchar, ',' order by part, entry, pos)) from b4) as codebooks_sha256
from c join k using (vec_id)
"""

OP12 = """
with t as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
w as (
  select *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words,
    min(doc_id) over (partition by text) as first
  from t),
f as (
  select doc_id, part,
    len(words) < 200 as a,
    100 * len(list_distinct(words)) < 50 * len(words) as b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) as c,
    regexp_matches(text, '[#$%&*|]') as d,
    coalesce(first < doc_id, false) as e
  from w),
l as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by doc_id),
m as (
  select part, [a, b, c, d, e] as fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from f left join l using (doc_id) group by all),
x as (select unnest(range(1, 6)) as i),
o as (
  select [x1.i, x2.i, x3.i, x4.i, x5.i] as places from x x1, x x2, x x3, x x4, x x5
  where len(list_distinct([x1.i, x2.i, x3.i, x4.i, x5.i])) = 5),
s as (
  select array_to_string(list_transform(places, lambda p: substr('ABCDE', p, 1)), '') as filter_order, i as step,
    places[i] as own, places[1:i - 1] as earlier
  from o, x),
j as (
  select part, filter_order, step, own, n, good, toxic, fails[own] as failing,
    len(list_filter(earlier, lambda p: fails[p])) > 0 as gone, len(list_filter(fails, lambda p: p)) as n_fails
  from m, s),
k as (
  select part, filter_order, step, own,
    sum(case when not gone and not failing then n else 0 end) as kept,
    sum(case when not gone and failing then n else 0 end) as removed,
    sum(case when gone and failing then n else 0 end) as redundant,
    sum(case when failing and n_fails = 1 then n else 0 end) as unique_fails,
    sum(case when not gone and failing then good else 0 end) as good_lost,
    sum(case when not gone and failing then toxic else 0 end) as toxic_lost
  from j group by all)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley
from k
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1, "op4_jaccard": OP4, "op10_urls": OP10, "op11_codebooks": OP11, "op12_filter_audit": OP12}
