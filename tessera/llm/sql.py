"""DuckDB SQL with the same result as the registered queries that SQL can express."""

OP1 = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents),
g as (select norm, min(doc_id) as keep_id, count(*) as group_size from t group by norm)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.norm) as text_sha256
from t join g on t.norm = g.norm
"""

OP8 = r"""
with u as (
  select page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages),
r(rhost, rpath, rverdict) as (values
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m as (
  select u.page_id, r.rhost || r.rpath as rule, r.rverdict as verdict,
         row_number() over (partition by u.page_id order by length(r.rhost || r.rpath) desc) as k
  from u join r on (u.host = r.rhost or ends_with(u.host, '.' || r.rhost)) and starts_with(u.path, r.rpath))
select u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') as verdict
from u left join m on m.page_id = u.page_id and m.k = 1
"""

OP11 = """
with t as (select doc_id, coalesce(text, '') as x, length(coalesce(text, '')) as n,
                  sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
u as (select *, cast('0x' || substr(h, 1, 8) as bigint) % (n + 1) as c1, cast('0x' || substr(h, 9, 8) as bigint) % (n + 1) as c2,
             cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from t),
v as (select *, least(c1, c2) as a, greatest(c1, c2) as b,
             case when x = '' or contains(x, '<P>') or contains(x, '<S>') or contains(x, '<M>') or h3 % 100 >= 90 then 'plain'
                  when h4 % 100 < 20 then 'spm' else 'psm' end as form from u),
w as (select *, substring(x, 1, a) as p, substring(x, a + 1, b - a) as m, substring(x, b + 1) as s from v),
o as (select *, case form when 'plain' then x when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                     else '<S>' || s || '<P>' || p || '<M>' || m end as output from w)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(output) as output_sha256, sha256(x) as restored_sha256
from o
"""

OP13 = """
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as x,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
e as (select x, min(doc_id) as first from d group by x),
f as (
  select d.part, coalesce(l.good, false) as good, coalesce(l.toxic, false) as toxic, map {
    'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
    'C': 100 * length(regexp_replace(d.x, '[^A-Z]', '', 'g')) > 5 * length(d.x),
    'D': regexp_matches(d.x, '[#$%&*|]'), 'E': coalesce(d.doc_id > e.first, e.first is not null)} as fails
  from d join e on e.x = d.x left join l on l.doc_id = d.doc_id),
c as (select unnest(['A', 'B', 'C', 'D', 'E']) as c),
o as (
  select a.c || b.c || g.c || h.c || i.c as filter_order from c a, c b, c g, c h, c i
  where len(list_distinct([a.c, b.c, g.c, h.c, i.c])) = 5),
s as (select filter_order, step, filter_order[step:step] as letter, string_split(filter_order[1:step - 1], '') as before,
             list_filter(string_split(filter_order, ''), lambda y: y <> filter_order[step:step]) as others
      from o, (select unnest(range(1, 6)) as step)),
r as (
  select f.part, s.filter_order, cast(s.step as int) as step, s.letter, good, toxic, fails[s.letter] as fail,
         len(list_filter(s.before, lambda y: y <> '' and fails[y])) > 0 as gone, len(list_filter(s.others, lambda y: fails[y])) = 0 as alone
  from f, s),
n as (
  select part, filter_order, step, letter, count(*) filter (not gone and not fail) as kept, count(*) filter (fail and not gone) as removed,
         count(*) filter (fail and gone) as redundant, count(*) filter (fail and alone) as unique_fails,
         count(*) filter (fail and not gone and good) as good_lost, count(*) filter (fail and not gone and toxic) as toxic_lost
  from r group by part, filter_order, step, letter)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from n
"""

ORACLE = {"op1_exact_dedup": OP1, "op8_url_filter": OP8, "op11_fill_middle": OP11, "op13_filter_audit": OP13}
