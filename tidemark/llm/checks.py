"""SQL for those queries that it can express; the method's inner steps are not part of it."""

TOPK = r"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
"""

MIXING = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents),
sources as (select source, cast(sum(size) as double) as n from sized group by source),
placed as (
  select *, list_extract([5.0::double, 2.0, 1.0], 1 + (row_number() over (order by source nulls last) - 1) % 3) as weight from sources),
total as (select 1.5 * sum(n) as total from placed),
ordered as (select *, row_number() over (order by n / weight, source nulls last) as k from placed where n > 0),
-- With the first k - 1 at their caps, the others share what is left; the first k whose cap is not exceeded ends it.
units as (
  select k, 2 * n / weight as reach,
    (total - coalesce(sum(2 * n) over (order by k rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by k rows between current row and unbounded following) as unit
  from ordered, total),
level as (select min_by(unit, k) as unit from units where unit <= reach),
targets as (
  select source, cast(n as bigint) as source_size,
    case when n = 0 then 0.0 when unit is null or weight * unit > 2 * n then 2 * n else weight * unit end as target
  from placed, level),
rated as (
  select s.doc_id, s.size, t.source_size, t.target,
    case when source_size = 0 then 0.0 else least(2.0, t.target / t.source_size) end as rate,
    cast('0x' || substr(md5('17:' || coalesce(cast(s.doc_id as varchar), 'null')), 1, 12) as bigint) / 281474976710656.0::double as draw
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  size * cast(floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end as bigint) as taken
from rated
"""

LINE_DEDUP = r"""
with lines as (
  select doc_id, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents where text is not null),
keyed as (
  select *, trim(line, ' ') as key, len(regexp_split_to_array(trim(line, ' '), '[ \t\n\x0B\f\r]+')) >= 5 as long from lines),
spread as (
  select key, min(doc_id) as first from keyed where long
  group by key having count(distinct coalesce(source, 'no source')) >= 3),
kept as (
  select k.doc_id, count(*) as n_lines, count(*) filter (long and s.key is not null and s.first <> k.doc_id) as n_removed,
    string_agg(k.line, chr(10) order by k.pos) filter (not (long and s.key is not null and s.first <> k.doc_id)) as text
  from keyed k left join spread s on k.key = s.key group by k.doc_id)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
  coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed
from documents d left join kept k on d.doc_id = k.doc_id
"""

JACCARD = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case when w is null or len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as s from worded),
items as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
links as (
  select a.doc_id as a, b.doc_id as b from items a join items b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(doc_id, other) as (
  select doc_id, doc_id from documents union select r.doc_id, l.b from reach r join links l on r.other = l.a)
select s.doc_id, len(s.s) as n_shingles, c.component_id
from sets s join (select doc_id, min(other) as component_id from reach group by doc_id) c on s.doc_id = c.doc_id
"""


def _codes() -> str:
    """Six rounds over eight parts and sixteen entries, one after the other."""
    at = []
    for r in range(7):
        at.append(f"""
apart{r} as materialized (
  select k, part, entry, cast(sum((x - c) * (x - c)) as bigint) as d from cells join book{r} using (part, pos) group by k, part, entry),
placed{r} as materialized (
  select k, part, entry, d from apart{r} qualify row_number() over (partition by k, part order by d, entry) = 1)""")
        if r < 6:
            at.append(f"""
mean{r} as (
  select part, entry, pos, cast(sum(x) as bigint) as s, count(*) as n from cells join placed{r} using (k, part) group by part, entry, pos),
book{r + 1} as materialized (
  select part, entry, pos, coalesce((s - ((s % n) + n) % n) // n, c) as c from book{r} left join mean{r} using (part, entry, pos))""")
    return f"""
with kept as materialized (
  select row_number() over (order by vec_id nulls last, embedding) - 1 as k, vec_id, label, embedding, len(embedding) // 8 as width
  from embeddings where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
cells as materialized (
  select k, (i - 1) // width as part, (i - 1) % width as pos, cast(floor(4096 * embedding[i]::double) as bigint) as x
  from (select k, width, embedding, unnest(range(1, len(embedding) + 1)) as i from kept)),
book0 as materialized (select part, k as entry, pos, x as c from cells where k < 16),{",".join(at)},
coded as (
  select k, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(d) as bigint) as error from placed6 group by k)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(cast(c as varchar), ',' order by part, entry, pos)) from book6) as codebooks_sha256
from coded join kept using (k)
"""


CODES = _codes()
