"""DuckDB SQL of the queries that SQL can express."""

OP5_SQL = r"""
with docs as (
  select row_number() over () as row_id, doc_id, coalesce(source, '') as host,
    coalesce(text, '') as text
  from documents
),
words as (
  select row_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from docs
),
windows as (
  select row_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as win
  from words, lateral (select unnest(range(1, len(w) - 1)) as i)
),
repeated as (
  select row_id, i from windows
  qualify count(*) over (partition by row_id, win) > 1
),
covered as (
  select row_id, count(distinct i + k) as n_repeat_words
  from repeated, (select unnest([0, 1, 2]) as k) group by row_id
),
lines as (
  select row_id, host, text, line,
    trim(regexp_replace(
      regexp_replace(lower(line), '[0-9]', '0', 'g'), '[ \t\x0B\f\r]+', ' ', 'g'
    ), ' ') as normal,
    len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) as n
  from (
    select row_id, host, text, unnest(string_split(text, chr(10))) as line from docs
  )
  where regexp_matches(line, '[^\x20\x09-\x0D]')
),
dup_lines as (
  select row_id, count(*) - count(distinct line) as n_dup_lines from lines group by row_id
),
line_set as (select distinct host, text, normal from lines),
marks as (
  select host, text, i, md5(array_to_string(list_slice(
      list_sort(list(substr(md5(normal), (1 + 2 * i)::int))), 1, least((count(*) + 1) // 2, 6)
    ), ' '))[1:15] as sketch
  from line_set, (select unnest(range(0, 12)) as i) group by host, text, i
),
common as (
  select host, i, sketch,
    lpad(count(*)::varchar, 18, '0') || lpad((99 - i)::varchar, 2, '0') || sketch as rank
  from marks group by host, i, sketch
),
best as (
  select host, text, max(rank) as best from marks join common using (host, i, sketch) group by all
),
leads as (
  select host, i, sketch, max(best) as best from marks join best using (host, text) group by all
),
copies as (
  select host, text,
    case when max(best)[1:18]::bigint > 1 then max(best) else text end as copy
  from marks join leads using (host, i, sketch) group by host, text
),
frequent as (
  select host, normal from line_set join copies using (host, text)
  group by host, normal having count(distinct copy) >= 10
),
lost as (
  select row_id, sum(n) as lost from lines join frequent using (host, normal) group by row_id
),
counts as (
  select d.row_id, d.doc_id, len(w.w) as n_words,
    length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(l.n_dup_lines, 0) as n_dup_lines,
    coalesce(c.n_repeat_words, 0) as n_repeat_words,
    coalesce(x.lost, 0) as n_lost_words
  from docs d join words w using (row_id) left join dup_lines l using (row_id)
    left join covered c using (row_id) left join lost x using (row_id)
),
base as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars,
  n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
  n_repeat_words::bigint as n_repeat_words, base_failed, n_lost_words::bigint as n_lost_words,
  not base_failed and 100 * (n_words - n_lost_words) >= 50 * n_words as kept
from base
"""

OP1_SQL = r"""
with hashed as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex
  from pages
),
heads as (select hex, payload_bytes, max(page_id) as head from hashed group by all)
select page_id, payload_bytes::bigint as payload_bytes,
  list_reduce(list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int, 1
  )), lambda a, b: a || b) as payload_digest,
  case when head is null or page_id is not distinct from head then 'response' else 'revisit' end
    as record_type,
  case when page_id is distinct from head then head end as refers_to
from hashed join heads using (hex, payload_bytes)
"""

OP6_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized as (
  select *, list_sum(list_transform([role, text], lambda t: length(t)
    + length(t) - length(replace(t, '\', ''))
    + (length(t) - length(replace(t, '<|', ''))) // 2
    + (length(t) - length(replace(t, '|>', ''))) // 2
    + len(regexp_extract_all(t, '</?s>')) + len(regexp_extract_all(t, '\[/?INST\]'))
  )) + length('<||><|end|>') as chars
  from turns
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text))
    as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
    filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from sized group by conv_id
"""

OP12_SQL = r"""
with docs as (
  select row_number() over () as row_id, doc_id,
    regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as words
  from documents
),
postings as (
  select row_id, doc_id, any_value(n) as n, term, count(*) as tf from (
    select row_id, doc_id, len(words) as n, translate(unnest(words),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
    from docs
  ) group by row_id, doc_id, term
),
total as (
  select count(*) as docs, sum(len(words))::bigint as terms from docs where len(words) > 0
),
held as (select term, count(*) as df from postings group by term),
asked as (
  select distinct item_id, translate(
    unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
  from benchmark
),
weights as (
  select item_id, term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as w
  from asked join held using (term), total
),
scores as (
  select item_id, doc_id, row_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::bigint
      as score
  from weights join postings using (term), total
  group by item_id, doc_id, row_id
)
select item_id, (row_number() over (
    partition by item_id order by score desc, doc_id nulls first
  ))::int as rank, doc_id, score
from scores where score > 0 qualify rank <= 50
"""

OP13_SQL = r"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (
      partition by conv_id order by turn nulls first,
        md5(concat_ws(chr(10), length(coalesce(role, '')), coalesce(role, ''), coalesce(text, '')))
    ) - 1 as pos
  from conversations where conv_id is not null
),
convs as (
  select conv_id, conv_id - conv_id % 20 as base, (4294967295 - list_reduce(
      list_concat([4294967295::bigint], flatten(list_transform(
        range(1, length(conv_id::varchar) + 1),
        lambda i: [ascii(substr(conv_id::varchar, i::int, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]
      ))),
      lambda c, b: case when b >= 0 then xor(c, b) when c & 1 = 1 then xor(c >> 1, 3988292384)
        else c >> 1 end
    )) % 4 as h
  from (select distinct conv_id from turns)
),
rebuilt as (
  select c.conv_id, list({'role': t.role, 'text': t.text} order by t.conv_id = c.conv_id and t.pos >= h, t.pos)
    filter (t.pos is not null) as said
  from convs c left join turns t
    on (t.conv_id = c.base and t.pos < h) or (t.conv_id = c.conv_id and t.pos >= h)
  group by c.conv_id
),
ids as (
  select conv_id, coalesce(len(said), 0) as size, coalesce(list_transform(said,
    lambda t: md5(concat_ws(chr(10), length(t.role), t.role, t.text))), []) as turn_ids, said
  from rebuilt
),
places as (
  select conv_id, depth, size, md5(array_to_string(list_slice(turn_ids, 1, depth), ',')) as node,
    case when depth > 0 then md5(array_to_string(list_slice(turn_ids, 1, depth - 1), ',')) end as above,
    case when depth > 0
      then len(regexp_extract_all(said[depth].text, '[^\x20\x09-\x0D]+')) else 0 end as words
  from ids, lateral (select unnest(range(0, size + 1)) as depth)
),
nodes as (
  select node, depth, any_value(above) as above, min(conv_id) as conv_id, count(*) as n_convs,
    any_value(words) as words,
    string_agg(conv_id::varchar, ',' order by conv_id) filter (size = depth) as ended
  from places group by node, depth
),
children as (select above as node, depth - 1 as depth, count(*) as n_children from nodes group by all),
below as (
  select distinct p.node, p.depth, q.node as under, q.depth as under_depth
  from places p join places q on p.conv_id = q.conv_id and q.depth >= p.depth
),
sums as (
  select b.node, b.depth, sum((n.n_convs - 1) * n.words) as saved_tokens,
    count(*) filter (c.n_children is null) as n_leaves
  from below b join nodes n on n.node = b.under and n.depth = b.under_depth
    left join children c on c.node = b.under and c.depth = b.under_depth
  group by b.node, b.depth
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs::bigint as n_convs,
  coalesce(c.n_children, 0)::bigint as n_children, s.n_leaves::bigint as n_leaves,
  s.saved_tokens::bigint as saved_tokens, sha256(coalesce(n.ended, '')) as ends_sha256
from nodes n join sums s using (node, depth) left join children c using (node, depth)
  left join nodes p on p.node = n.above and p.depth = n.depth - 1
"""
