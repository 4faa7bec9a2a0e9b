"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP7 = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') as ws from documents
), s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) end) as sh from w
), n as (
  select doc_id, count(*) as n from s group by doc_id
), c as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b using (sh) where a.doc_id <> b.doc_id group by all
), l as (
  select c.a, c.b from c join n na on na.doc_id = c.a join n nb on nb.doc_id = c.b where 100 * c.c >= 85 * (na.n + nb.n - c.c)
), r as (
  select doc_id as a, doc_id as b from documents union select r.a, l.b from r join l on r.b = l.a
), m as (
  select a, min(b) as component_id from r group by a
)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.component_id, d.doc_id = m.component_id as kept
from documents d join m on m.a = d.doc_id left join n on n.doc_id = d.doc_id
"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = f"""
with d as (
  select doc_id, {_TERMS} as ws from documents
), b as (
  select item_id, {_TERMS} as ws from benchmark
), w as (
  select distinct item_id, least(len(ws), 10) as n, unnest(list_transform(range(1, greatest(len(ws) - 10, 0) + 2), lambda i: array_to_string(ws[i:i + least(len(ws), 10) - 1], ' '))) as g
  from b where len(ws) > 0
), p as (
  select d.doc_id, s.n, unnest(range(1, len(ws) - s.n + 2)) as i, d.ws from d cross join (select distinct n from w) s where len(ws) >= s.n
), h as (
  select p.doc_id, p.i, p.n, w.item_id from p join w on w.n = p.n and w.g = array_to_string(p.ws[p.i:p.i + p.n - 1], ' ')
), c as (
  select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from h) group by doc_id
), t as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct doc_id, item_id::varchar as item_id from h) group by doc_id
), q as (
  select item_id, q, q[list_position(list_transform(q, lambda x: strlen(x)), list_max(list_transform(q, lambda x: strlen(x))))] as centre
  from (select distinct item_id, unnest(list_transform(range(1, greatest(len(ws) - 10, 0) + 2), lambda i: ws[i:i + least(len(ws), 10) - 1])) as q from b where len(ws) > 0)
), o as (
  select doc_id, unnest(range(1, len(ws) + 1)) as p, unnest(ws) as word from d
), a as (
  select distinct o.doc_id, q.item_id::varchar as item_id from o join q on q.centre = o.word join d on d.doc_id = o.doc_id where list_has_all(d.ws[greatest(o.p - 20, 1):o.p + 20], q.q)
), e as (
  select doc_id, count(*) as n_near, string_agg(item_id, ',' order by item_id) as items from (select doc_id, item_id from a except select doc_id, item_id::varchar from h) group by doc_id
)
select d.doc_id, len(d.ws)::bigint as n_words, coalesce(c.n_hit, 0)::bigint as n_hit, coalesce(t.n_items, 0)::bigint as n_items,
  sha256(coalesce(t.items, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated,
  coalesce(e.n_near, 0)::bigint as n_near, sha256(coalesce(e.items, '')) as near_sha256
from d left join c using (doc_id) left join t using (doc_id) left join e using (doc_id)
"""

OP2 = r"""
with l as (
  select doc_id, u.pos, u.line, len(regexp_extract_all(u.line, '[^\x20\x09-\x0D]+')) as n
  from (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null), unnest(ls) with ordinality as u(line, pos)
), k as (
  select *, row_number() over (partition by doc_id order by pos) as r from l where n > 0
), c as (
  select a.doc_id, a.r, b.pos, b.line, b.n, sum(b.n) over (partition by a.doc_id, a.r order by b.r) as cum
  from k a join k b on a.doc_id = b.doc_id and b.r between a.r and a.r + 7
), w as (
  select doc_id, r, min(pos) as start, max(pos) as stop, string_agg(line, chr(10) order by pos) as content
  from c where cum - n < 8 group by doc_id, r having max(cum) >= 8
), f as (
  select *, row_number() over (partition by content order by doc_id, r) as copy from w
), x as (
  select distinct doc_id, unnest(range(start, stop + 1)) as pos from f where copy > 1
), i as (
  select doc_id, pos, pos - row_number() over (partition by doc_id order by pos) as island from x
), t as (
  select doc_id, count(*) as n_removed, count(distinct island) as n_runs from i group by doc_id
), s as (
  select l.doc_id, string_agg(l.line, chr(10) order by l.pos) as kept from l left join x on x.doc_id = l.doc_id and x.pos = l.pos where x.pos is null group by l.doc_id
)
select d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines, coalesce(t.n_removed, 0)::bigint as n_removed,
  coalesce(t.n_runs, 0)::bigint as n_runs, sha256(coalesce(s.kept, '')) as kept_sha256
from documents d left join t using (doc_id) left join s using (doc_id)
"""

OP10 = r"""
with d as (
  select doc_id, encode(coalesce(text, '')) as b from documents
), s as (
  select doc_id, p, b[p + 1:p + 1] as byte, case when p + 400 <= octet_length(b) then hash(b[p + 1:p + 400]) end as w from (select doc_id, b, unnest(range(0, octet_length(b))) as p from d)
), n as (
  select w from s where w is not null group by w having count(*) > 1
), r as (
  select s.doc_id, s.p, s.byte, n.w is not null as start from s left join n using (w)
), c as (
  select doc_id, p, byte, coalesce(bool_or(start) over (partition by doc_id order by p rows between 399 preceding and current row), false) as gone from r
), g as (
  select *, gone and not coalesce(lag(gone) over (partition by doc_id order by p), false) as first from c
), t as (
  select doc_id, count(*) filter (gone) as n_removed, count(*) filter (first) as n_spans, string_agg(hex(byte), '' order by p) filter (not gone) as kept from g group by doc_id
)
select d.doc_id, octet_length(d.b)::bigint as n_bytes, coalesce(t.n_removed, 0)::bigint as n_removed, coalesce(t.n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(t.kept, ''))) as kept_sha256
from d left join t using (doc_id)
"""

#: Every anchor against every row, as the contract says it.
OP11 = """
WITH v AS (
    SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, CAST(list_dot_product(a.e, r.e) AS BIGINT) AS score FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
    SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
)
SELECT * FROM n WHERE rank <= 3
"""
