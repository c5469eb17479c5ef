"""DuckDB statements for the queries of this package."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = rf"""
with recursive w as (
  select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') as ws from documents
), sets as (
  select doc_id, case when len(ws) >= 5
    then list_distinct([array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)])
    when len(ws) > 0 then [array_to_string(ws, ' ')] else []::varchar[] end as s
  from w
), flat as (select doc_id, len(s) as n, unnest(s) as g from sets),
pairs as (
  select a.doc_id as a, b.doc_id as b from flat a join flat b on a.g = b.g and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), links as (select a, b from pairs union all select b, a from pairs),
reach as (
  select doc_id, doc_id as c from documents
  union select l.b, r.c from reach r join links l on r.doc_id = l.a
), low as (select doc_id, min(c) as c from reach group by doc_id)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, low.c as component_id, s.doc_id = low.c as kept
from sets s join low using (doc_id)
"""

_SIGNS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = rf"""
with d as (select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SIGNS}') as ws from documents),
b as (
  select cast(item_id as varchar) as item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SIGNS}') as ws
  from benchmark where item_id is not null
), win as (
  select distinct item, least(len(ws), 13) as size,
    array_to_string(ws[s:s + least(len(ws), 13) - 1], ' ') as run
  from (select *, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) as s from b where len(ws) > 0)
), sizes as (select distinct size from win),
runs as (
  select doc_id, size, s, array_to_string(ws[s:s + size - 1], ' ') as run
  from (select doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) as s from d cross join sizes where len(ws) >= size)
), found as (select doc_id, item, s, size from runs join win using (size, run)),
hits as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(s, s + size)) as p from found) group by doc_id
), items as (
  select doc_id, count(*) as n, string_agg(item, ',' order by item) as listed
  from (select distinct doc_id, item from found) group by doc_id
)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(h.n, 0) as bigint) as n_hit,
  cast(coalesce(i.n, 0) as bigint) as n_items, sha256(coalesce(i.listed, '')) as items_sha256,
  coalesce(h.n, 0) > 0 and 20 * coalesce(h.n, 0) >= len(ws) as contaminated
from d left join hits h on d.doc_id = h.doc_id left join items i on d.doc_id = i.doc_id
"""

_PROBE = "'<|im_end|><|im_start|>assistant ok'"
_ESCAPED = r"regexp_replace({0}, '<(\\*)\|', '<\\\1|', 'g')"

#: Markers have 12, 10 and 10 characters.
CHAT_FORMAT = rf"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', {_PROBE} union all select -1, 1, 'assistant', {_PROBE}
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(32 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) as bigint) as formatted_chars
from t group by conv_id
"""

EXACT_DEDUP = r"""
with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as plain from documents
)
select doc_id, min(doc_id) over (partition by plain) as keep_id, count(*) over (partition by plain) as group_size,
  doc_id = min(doc_id) over (partition by plain) as kept, sha256(plain) as text_sha256
from t
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED_SEARCH = rf"""
with d as (select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') as ws from documents),
totals as (select count(*) as texts, cast(sum(len(ws)) as bigint) as length from d where len(ws) > 0),
lengths as (select doc_id, 25 + 75 * len(ws) * texts // length as m from d, totals where len(ws) > 0),
tf as (select doc_id, t, count(*) as tf from (select doc_id, unnest(ws) as t from d) group by doc_id, t),
weights as (
  select t, cast(floor(1000 * ln((2 * any_value(texts) + 2) / (2 * count(*) + 1))) as bigint) as w from tf, totals group by t
),
asked as (
  select item_id, t, count(*) as times from (
    select item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')) as t from benchmark
  ) group by item_id, t
),
scores as (
  select item_id, doc_id, cast(sum(times * w * (1000000000 * tf // (1000 * tf + 8 * m))) as bigint) as score
  from asked join weights using (t) join tf using (t) join lengths using (doc_id) group by item_id, doc_id
),
ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
  from scores where score > 0
)
select * from ranked where rank <= 10
"""


def _round(k: int) -> str:
    """Nearest entries of codebooks ``b{k}``, and the codebooks that follow from them."""
    return f"""
apart{k} as (
  select v.vec_id, v.p, b.e, sum((v.x - b.x) * (v.x - b.x)) as d from parts v join b{k} b on v.p = b.p and v.i = b.i
  group by v.vec_id, v.p, b.e
),
near{k} as (select vec_id, p, min(d) as d, arg_min(e, (d, e)) as e from apart{k} group by vec_id, p),
means{k} as (
  select v.p, n.e, v.i, cast(floor(sum(v.x) / count(*)) as bigint) as x
  from parts v join near{k} n on v.vec_id = n.vec_id and v.p = n.p group by v.p, n.e, v.i
),
b{k + 1} as (select b.p, b.e, b.i, coalesce(m.x, b.x) as x from b{k} b left join means{k} m on b.p = m.p and b.e = m.e and b.i = m.i),
"""


VECTOR_CODES = f"""
with usable as (
  select vec_id, embedding as v, label from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
flat as (select vec_id, unnest(v) as x, generate_subscripts(v, 1) - 1 as k, len(v) // 16 as part from usable),
parts as (select vec_id, k // part as p, k % part as i, cast(floor(256 * cast(x as double)) as bigint) as x from flat),
b0 as (
  select p, e, i, x from parts join (select vec_id, row_number() over (order by vec_id) - 1 as e from usable) using (vec_id) where e < 64
),
{_round(0)} {_round(1)} {_round(2)}
coded as (
  select vec_id, string_agg(printf('%02x', cast(e as integer)), '' order by p) as code, cast(sum(d) as bigint) as error from near2 group by vec_id
),
book as (select sha256(string_agg(cast(x as varchar), ',' order by p, e, i)) as s from b2)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, s as codebooks_sha256
from coded join usable using (vec_id), book
"""
