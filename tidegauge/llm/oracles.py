"""DuckDB SQL that gives the rows of the text queries that SQL can express."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]"

OP6 = rf"""
with t as (
  select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}+'), lambda x: x <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '{SPACE}', '', 'g') <> '') as l
  from documents),
windows as (select doc_id, unnest(range(len(w) - 2)) as i, w from t where len(w) >= 3),
hashed as (select doc_id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] as g from windows),
often as (select doc_id, i from hashed qualify count(*) over (partition by doc_id, g) > 1),
repeats as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from often) group by 1),
m as (
  select t.doc_id, stratum, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(t, '{SPACE}', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words,
    cast(length(regexp_replace(t, '[^A-Z]', '', 'g')) as bigint) as n_capitals, cast(len(l) as bigint) as n_lines
  from t left join repeats using (doc_id)),
x as (
  select m.*, unnest(['symbols', 'capitals', 'dup_lines', 'repeats']) as rule,
    unnest([case when word_chars > 0 then least(1000, n_symbols * 1000 // word_chars) else 0 end,
      case when word_chars > 0 then least(1000, n_capitals * 1000 // word_chars) else 0 end,
      case when n_lines > 0 then least(1000, n_dup_lines * 1000 // n_lines) else 0 end,
      case when n_words > 0 then least(1000, n_repeat_words * 1000 // n_words) else 0 end]) as f from m),
c as (select x.*, cast(ceil(f * 100 / 1000) as int) as cell from x),
good as (select doc_id from labels group by doc_id having max(quality) = 1),
n as (select stratum, rule, cell, count(*) as n from c join good using (doc_id) group by all),
s as (
  select *, sum(n) over (partition by stratum, rule) as tot,
    sum(n) over (partition by stratum, rule order by cell desc) - n as above,
    0.05 / (4 * (select count(distinct stratum) from n)) as d from n),
sizes as (select distinct tot, d from s),
terms as (
  select tot, d, k, sum(exp(lgamma(tot + 1) - lgamma(k + 1) - lgamma(tot - k + 1) + k * ln(0.005) + (tot - k) * ln(0.995)))
    over (partition by tot, d order by k) as below
  from (select tot, d, unnest(range(cast(ceil(tot * 0.005) as bigint) + 1)) as k from sizes) where k <= tot),
may as (select tot, d, max(k) as may from terms where below <= d group by all),
cuts as (select stratum, rule, min(cell) as cut from s join may using (tot, d) where above <= may group by all),
bad as (select distinct c.doc_id from c join cuts using (stratum, rule) where cell > cut)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and bad.doc_id is null as kept
from m left join bad using (doc_id)
"""

OP7 = rf"""
with t as (
  select doc_id, length(coalesce(text, '')) as c, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g')) as s,
    regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g') as n from documents),
g as (select n, arg_max(doc_id, [c, -doc_id]) as keep_id, count(*) as group_size from t group by n)
select doc_id, keep_id, cast(group_size as bigint) as group_size, doc_id = keep_id as kept, s as text_sha256 from t join g using (n)
"""

OP8 = rf"""
with t as (select doc_id, source, string_split(coalesce(text, ''), chr(10)) as l from documents),
p as (select source, count(*) as pages from t group by source),
e as (select doc_id, source, unnest(l) as x, unnest(range(len(l))) as i from t),
k as (select *, regexp_replace(x, '^{SPACE}+|{SPACE}+$', '', 'g') as line from e),
n as (select source, line, count(distinct doc_id) as n from k where line <> '' group by all),
bad as (select source, line from n join p using (source) where n >= 3 and n > 0.02 * pages)
select doc_id, coalesce(string_agg(x, chr(10) order by i) filter (bad.line is null), '') as text,
  cast(count(*) as bigint) as n_lines, cast(count(bad.line) as bigint) as n_dropped
from k left join bad on k.source is not distinct from bad.source and k.line = bad.line group by doc_id
"""

OP10 = """
with u as (select page_id, coalesce(url, '') as url from pages),
r as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from u),
h as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
rules(verdict, rhost, rpath) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m as (
  select page_id, arg_max(rhost || rpath, length(rhost || rpath)) as rule, arg_max(verdict, length(rhost || rpath)) as v
  from h join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from h left join m using (page_id)
"""

OP11 = """
with r as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.id as anchor_id, r.id, a.label = r.label as same, cast(list_dot_product(a.v, r.v) as bigint) as score
  from r a join r on a.id <> r.id where a.id % 100 = 0),
p as (
  select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, cast(row_number() over w as int) as rank, id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, id)
qualify row_number() over w <= 10
"""

SQL = {"op6_quality_rules": OP6, "op7_exact_dedup": OP7, "op8_line_dedup": OP8, "op10_url_filter": OP10, "op11_hard_negatives": OP11}
