"""SQL that states the registered queries independently, for DuckDB."""

from __future__ import annotations

from winnower import fixed_values as fixed
from winnower.functions.garbled import GarbledRule
from winnower.functions.hashing import score_bound
from winnower.queries import BASELINE, CANDIDATE, FIRST_ROWS, QUARTER

_WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

_PAIRS = """
src as (
  select doc_id as seq,
    case when doc_id % 97 = 5 then null when doc_id % 101 = 7 then E'  \\t'
         when doc_id % 107 = 3 then split_part(text, '.', 1) || repeat('y', 130)
         when doc_id % 11 = 2 then text else split_part(text, '.', 1) end as question,
    case when doc_id % 103 = 9 then text || repeat('z', 130) else text end as response,
    case when doc_id % 3 = 0 then null else 'lang ' || lang end as system_prompt,
    cast(doc_id as varchar) as id
  from documents)"""


def _normal(expression: str) -> str:
    return f"trim(regexp_replace({expression}, '{_WS}', ' ', 'g'), ' ')"


_NORMAL = f"""{_PAIRS},
n as (
  select *, {_normal("coalesce(question, '')")} as q,
            {_normal("coalesce(response, '')")} as r
  from src)"""

_TOKENS = """
tc as (
  select seq, t, count(*) as c
  from (select seq, unnest(string_split(r, ' ')) as t from n) where t <> '' group by all),
rp as (
  select seq, cast(sum(c) as integer) as n_tokens, max(c) / sum(c)::double as share
  from tc group by seq)"""

_RUNS = """
ch as (
  select seq, side, unnest(string_split(s, '')) as c,
         generate_subscripts(string_split(s, ''), 1) as i
  from (select seq, 'q' as side, q as s from n union all select seq, 'r', r from n)
  where s <> ''),
g as (
  select *, i - row_number() over (partition by seq, side, c order by i) as gr from ch),
lr as (
  select seq, coalesce(max(k) filter (side = 'q'), 0) as q_run,
              coalesce(max(k) filter (side = 'r'), 0) as r_run
  from (select seq, side, c, gr, count(*) as k from g group by all) group by seq)"""

_EMPTY = "(q = '' or r = '')"
_LENGTH = (
    f"(length(q) < {fixed.MIN_QUESTION_CHARS} or length(r) < {fixed.MIN_RESPONSE_CHARS}"
    f" or length(q) > {fixed.MAX_QUESTION_CHARS} or length(r) > {fixed.MAX_RESPONSE_CHARS})"
)
_RUN = f"(greatest(coalesce(q_run, 0), coalesce(r_run, 0)) >= {fixed.CHAR_RUN_LIMIT})"
_REPEAT = (
    f"(coalesce(n_tokens, 0) >= {fixed.TOKEN_SHARE_MIN_TOKENS}"
    f" and coalesce(share, 1) >= {fixed.TOKEN_SHARE_LIMIT}::double)"
)
_KEY = "sha1(lower(q) || chr(10) || lower(r))"
_SCORE = f"sha1(unhex('{QUARTER.seed:016x}') || unhex(k))"

_LABELS = f"""{_NORMAL},{_TOKENS},{_RUNS},
v as (
  select n.*, case when {_EMPTY} then 'empty' when {_LENGTH} then 'length'
                   when {_RUN} then 'char_run' when {_REPEAT} then 'repetition'
                   else 'valid' end as drop_reason
  from n left join rp using (seq) left join lr using (seq))"""

_SCORED = f"""{_LABELS},
k as (select *, {_KEY} as k from v),
h as (select *, {_SCORE} as hx from k)"""

_QUARTER_BOUND = score_bound(QUARTER.probability)
_WHOLE_BOUND = score_bound(1.0)


def _selected(bound: str) -> str:
    return f"s as (select * from h where drop_reason = 'valid' and hx < '{bound}')"


_FIRST = "d as (select *, row_number() over (partition by k order by seq) as copy from s)"

_SYSTEM = _normal("coalesce(system_prompt, 'None')")
_RECORD = f"""q as instruction, '' as input, r as output, {_SYSTEM} as system,
  '[]' as history, id as source_id"""


def _filtered(ctes: str, joins: str, condition: str) -> str:
    return f"with {ctes} select seq from n {joins} where not {condition}"


# Evaluation results made of labelled documents.
_TASK_ROWS = ", ".join(
    f"({pos}, '{task}', {shots})" for pos, (task, shots) in enumerate(fixed.TASKS)
)
_SCORES = f"""
tasks(pos, task, fewshot) as (values {_TASK_ROWS}),
averages as (
  select source as run, doc_id % {len(fixed.TASKS)} as pos, avg(quality) as acc,
         avg(toxic) as acc_norm, avg(n_chars) as f1
  from documents join labels using (doc_id) group by all),
scores as (
  select run, task, fewshot,
    case task when 'hellaswag' then 'acc_norm,none' when 'truthfulqa_mc2' then 'f1,none'
              else 'acc,none' end as metric,
    case task when 'hellaswag' then acc_norm when 'truthfulqa_mc2' then f1
              else acc end as score
  from averages join tasks using (pos))"""

_TWO_RUNS = f"""{_SCORES},
compared as (
  select pos, task, fewshot, coalesce(c.metric, b.metric) as metric, b.score as base_score,
         c.score as sft_score, c.score - b.score as delta,
         false as base_corrupt, false as sft_corrupt
  from tasks
  left join (select * from scores where run = '{BASELINE}') b using (task, fewshot)
  left join (select * from scores where run = '{CANDIDATE}') c using (task, fewshot))"""

_MANY_RUNS = f"""{_SCORES},
compared as (
  select runs.run, pos, task, fewshot, coalesce(c.metric, b.metric) as metric,
         b.score as base_score, c.score as sft_score, c.score - b.score as delta,
         false as base_corrupt, false as sft_corrupt
  from (select distinct run from scores where run <> '{BASELINE}') runs
  cross join tasks
  left join (select * from scores where run = '{BASELINE}') b using (task, fewshot)
  left join scores c on c.run = runs.run and c.task = tasks.task
                    and c.fewshot = tasks.fewshot)"""


def _four_decimals(column: str) -> str:
    return f"case when {column} is null then '' else printf('%.4f', {column}) end"


_CONVERSATIONS = """
turns as (select * from conversations),
pairs as (
  select u.conv_id, u.turn, u.text as question, a.text as response,
         (select arg_min(s.text, s.turn) from turns s
          where s.conv_id = u.conv_id and s.role = 'system' and s.turn < u.turn) as system_prompt,
         u.conv_id || '-' || u.turn as id
  from turns u join turns a on a.conv_id = u.conv_id and a.turn = u.turn + 1
  where u.role = 'user' and a.role = 'assistant')"""

_GARBLED = GarbledRule()
_GARBLED_PAIRS = _NORMAL.replace(
    _PAIRS,
    f"""{_PAIRS.replace("src as", "plain as", 1)},
src as (
  select * replace (case when seq % 53 = 11 then replace(response, 'e', chr(65533))
    when seq % 59 = 13 then translate(response, 'aeiounrst', 'qxzjkwvyq') else response end
    as response)
  from plain)""",
)


def _with_garbled(ctes: str) -> str:
    """Adds ``b``: the share of bad characters and the surprise of letter pairs of each response."""
    return rf"""{ctes},
codes as (
  select seq, list_transform(string_split(lower(r), ''), lambda c: unicode(c)) as u
  from n where length(r) > 1),
near as (
  select seq, (u[i] * 257 + u[i + 1]) % 4093 as pair, u[i] % 4093 as first
  from (select seq, u, unnest(range(1, len(u))) as i from codes)),
counted as (select pair, first, count(*) as n from near group by all),
firsts as (select first, sum(n) as of_first from counted group by first),
chosen as (select pair, sum(n) as n, arg_max(first, (n, first)) as first from counted group by pair),
model as (
  select pair, greatest(0, floor(-log2((n + 0.5::double) / (of_first + 0.5::double * 4093)) * 1000))::bigint as m
  from chosen join firsts using (first)),
surprise as (
  select seq, sum(m) // count(*) as millibits from near join model using (pair) group by seq),
b as (
  select seq, case when r = '' then 0.0::double else
      len(regexp_extract_all(r, '[\x{{FFFD}}\x00-\x08\x0E-\x1F\x7F-\x84\x86-\x9F\x{{E000}}-\x{{F8FF}}]'))
      / length(r) end as bad_share,
    millibits::bigint as millibits,
    bad_share >= {_GARBLED.max_share}::double
      or (length(r) >= {_GARBLED.min_chars} and coalesce(millibits, 0) >= {_GARBLED.max_millibits}) as bad
  from n left join surprise using (seq))"""


_NEAR = f"""{_NORMAL},
texts as (select seq, trim(concat_ws(' ', lower(q), lower(r)), ' ') as t from n),
words as (select seq, t, case when t = '' then [] else string_split(t, ' ') end as w from texts),
sets as (
  select seq, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [md5(t)]
    else list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i + 4], ' '))) end)) as s
  from words),
nodes as (select s, min(seq) as node from sets group by s),
members as (select seq, node from sets join nodes using (s)),
shingles as (select node, len(s) as size, unnest(s) as h from nodes),
shared as (
  select a.node as a, b.node as b, any_value(a.size) + any_value(b.size) as total, count(*) as common
  from shingles a join shingles b on a.h = b.h and a.node < b.node group by all),
links as (select a, b from shared where 100 * common >= 80 * (total - common)),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select node as a, node as b from nodes
  union
  select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a),
classes as (select a as node, min(b) as class_id from reach group by a)"""

_ROLES = """
turns as (
  select conv_id, turn, case
      when (conv_id * 7 + turn) % 23 = 4 then 'system' when (conv_id * 7 + turn) % 29 = 5 then null
      when (conv_id * 7 + turn) % 31 = 6 then 'bot' when (conv_id * 7 + turn) % 19 = 3 then 'assistant'
      else role end as role
  from conversations),
placed as (
  select *, row_number() over w - 1 as place, lag(role) over w as before from turns
  window w as (partition by conv_id order by turn nulls first, role nulls first)),
faults as (
  select *, case
      when role is null or role not in ('user', 'assistant', 'system') then 'unknown_role'
      when role = 'system' and place > 0 then 'late_system'
      when (place = 0 or before = 'system') and role = 'assistant' then 'answer_first'
      when place > 0 and role = before then 'repeated_role' end as fault
  from placed)"""

_MANIFEST_ROWS = ", ".join(f"('{n}', '{field}')" for n, field in fixed.MANIFEST_COLUMNS.items())

ORACLE_SQL: dict[str, str] = {
    "coerce_fields": f"""with {_PAIRS}
select seq, coalesce(question, '') as question, coalesce(response, '') as response,
  coalesce(system_prompt, '') as system_prompt,
  case when seq = 0 then '' else cast(seq as varchar) end as seq_text, '' as absent
from src""",
    "normalize_text": f"with {_NORMAL} select seq, q, r from n",
    "text_length": f"""with {_NORMAL}
select seq, cast(length(q) as integer) as q_chars, cast(length(r) as integer) as r_chars
from n""",
    "char_run_flag": f"""with {_NORMAL},{_RUNS}
select seq, coalesce(q_run, 0) >= {fixed.CHAR_RUN_LIMIT} as q_run,
  coalesce(r_run, 0) >= {fixed.CHAR_RUN_LIMIT} as r_run
from n left join lr using (seq)""",
    "token_share": f"""with {_NORMAL},{_TOKENS}
select seq, coalesce(n_tokens, 0) as n_tokens, coalesce(share, 1.0::double) as top_share
from n left join rp using (seq)""",
    "empty_filter": _filtered(_NORMAL, "", _EMPTY),
    "length_filter": _filtered(_NORMAL, "", _LENGTH),
    "char_run_filter": _filtered(f"{_NORMAL},{_RUNS}", "left join lr using (seq)", _RUN),
    "repetition_filter": _filtered(
        f"{_NORMAL},{_TOKENS}", "left join rp using (seq)", _REPEAT
    ),
    "drop_reason": f"with {_LABELS} select seq, drop_reason from v",
    "drop_waterfall": f"with {_LABELS} select drop_reason, count(*) as n_rows from v group by 1",
    "bad_records": f"""with {_LABELS}
select case when seq % 89 = 3 then 'other' else drop_reason end as drop_reason,
  count(*) as n_rows
from v group by 1""",
    "garbled_share": f"""with {_with_garbled(_GARBLED_PAIRS)}
select seq, bad_share, millibits from b""",
    "garbled_filter": f"with {_with_garbled(_GARBLED_PAIRS)} select seq from b where not bad",
    "garbled_waterfall": f"""with {_with_garbled(_LABELS.replace(_NORMAL, _GARBLED_PAIRS))}
select case when drop_reason = 'valid' and bad then 'garbled' else drop_reason end as drop_reason,
  count(*) as n_rows
from v join b using (seq) group by 1""",
    "near_duplicate_pairs": f"""with recursive {_NEAR}
select seq, class_id, seq = class_id as is_first from members join classes using (node)""",
    "role_check": f"""with {_ROLES}
select conv_id, count(*) as n_turns, arg_min_null(role, place) as first_role,
  arg_max_null(role, place) as last_role,
  coalesce(arg_min(fault, place) filter (fault is not null),
    case when arg_max_null(role, place) is distinct from 'assistant' then 'open_end' end) as fault,
  coalesce(min(place) filter (fault is not null),
    case when arg_max_null(role, place) is distinct from 'assistant' then max(place) end) as fault_at
from faults group by conv_id""",
    "content_key": f"with {_NORMAL} select seq, {_KEY} as content_key from n",
    "hash_score": f"""with {_NORMAL},
k as (select seq, {_KEY} as k from n),
h as (select seq, {_SCORE} as hx from k)
select seq, hx as score_hex,
  cast('0x' || substring(hx, 1, 13) as bigint)::double / power(2, 52)
  + cast('0x' || substring(hx, 14, 13) as bigint)::double / power(2, 104) as score
from h""",
    "hash_sample": f"with {_SCORED}, {_selected(_QUARTER_BOUND)} select seq from s",
    "max_samples": f"with {_SCORED}, {_selected(score_bound(0.5))} select seq from s",
    "dedup_keep_first": f"""with {_SCORED}, {_selected(_WHOLE_BOUND)}, {_FIRST}
select seq, k as content_key from d where copy = 1""",
    "dedup_in_order": f"""with {_SCORED}, {_selected(_QUARTER_BOUND)}, {_FIRST}
select seq, q, r from d where copy = 1""",
    "instruction_records": f"""with {_SCORED}, {_selected(_WHOLE_BOUND)}
select seq, {_RECORD} from s""",
    "clean_records": f"""with {_SCORED}, {_selected(_QUARTER_BOUND)}, {_FIRST}
select seq, {_RECORD} from d where copy = 1""",
    "json_records": f"""with {_SCORED}, {_selected(_QUARTER_BOUND)},
r as (select seq, q as instruction, '' as input, r as output, {_SYSTEM} as system, id from s)
select seq, '{{"instruction":' || to_json(instruction) || ',"input":"","output":'
  || to_json(output) || ',"system":' || to_json(system) || ',"history":[],"source_id":'
  || to_json(id) || '}}' as line
from r""",
    "demo_200": f"""with {_SCORED}, {_selected(_WHOLE_BOUND)}, {_FIRST}
select seq, {_RECORD} from d where copy = 1 order by seq limit {fixed.DEMO_ROWS}""",
    "jsonl_roundtrip": f"""with {_SCORED}, {_selected(_QUARTER_BOUND)}, {_FIRST}
select {_RECORD} from d where copy = 1""",
    "cleaning_stats": f"""with {_SCORED}
select {fixed.MIN_QUESTION_CHARS} as min_question_chars,
  {fixed.MIN_RESPONSE_CHARS} as min_response_chars,
  {fixed.MAX_QUESTION_CHARS} as max_question_chars,
  {fixed.MAX_RESPONSE_CHARS} as max_response_chars,
  {fixed.CHAR_RUN_LIMIT} as drop_if_char_run_ge,
  {fixed.TOKEN_SHARE_LIMIT}::double as drop_if_rep_ratio_ge,
  {fixed.TOKEN_SHARE_MIN_TOKENS} as rep_ratio_min_tokens,
  {fixed.SOURCE_ROWS}::bigint as source_rows_requested,
  '{fixed.SOURCE_REVISION}' as source_revision,
  count(*) as seen_rows,
  count(distinct k) filter (drop_reason = 'valid' and hx < '{_QUARTER_BOUND}') as kept_rows,
  count(*) filter (drop_reason = 'valid' and hx < '{_QUARTER_BOUND}') as selected_rows,
  count(*) filter (drop_reason = 'valid' and hx >= '{_QUARTER_BOUND}') as not_sampled_rows,
  count(*) filter (drop_reason = 'empty') as dropped_empty,
  count(*) filter (drop_reason = 'length') as dropped_length,
  count(*) filter (drop_reason = 'char_run') as dropped_char_run,
  count(*) filter (drop_reason = 'repetition') as dropped_repetition,
  selected_rows - kept_rows as dropped_dedup,
  0::bigint as dropped_other
from h""",
    "demo_dataset": f"""with {_SCORED}, {_selected(_QUARTER_BOUND)}, {_FIRST}
select row_number() over (order by seq) - 1 as place, id as source_id, q as instruction
from d where copy = 1 order by seq limit {fixed.DEMO_ROWS}""",
    "written_order": f"""with {_SCORED}, {_selected(_QUARTER_BOUND)}, {_FIRST}
select row_number() over (order by seq) - 1 as place, id as source_id, q as instruction
from d where copy = 1""",
    "prepare_first_n": f"""with {_SCORED},
s as (
  select * from h where drop_reason = 'valid'
    and seq in (select doc_id from documents order by doc_id limit {FIRST_ROWS})
), {_FIRST},
p as (
  select row_number() over (order by seq) - 1 as place, id as source_id, q as instruction
  from d where copy = 1)
select *, 'dataset' as file from p union all select *, 'demo' as file from p where place < 20""",
    "manifest": f"""select 'instructions' as dataset, f.file_name, c.name, c.field
from (values ('instructions'), ('instructions_demo')) f(file_name),
  (values {_MANIFEST_ROWS}) c(name, field)""",
    "source_scan_many_files": """select row_number() over (order by doc_id) - 1 as seq, doc_id, source
from documents""",
    "source_scan_json": "select row_number() over (order by doc_id) - 1 as seq, doc_id, source from documents",
    "pinned_scan": "select row_number() over (order by doc_id) - 1 as seq, doc_id, source from documents",
    "source_scan": "select row_number() over () - 1 as seq, doc_id, source from documents",
    "first_n_rows": f"""select seq, doc_id, text
from (select row_number() over () - 1 as seq, doc_id, text from documents)
where seq < {FIRST_ROWS}""",
    "metric_resolve": f"""with {_SCORES}
select run, task, fewshot, metric, score, false as corrupt from scores""",
    "metric_compare": f"with {_TWO_RUNS} select * from compared",
    "metric_compare_many_runs": f"with {_MANY_RUNS} select * from compared",
    "metric_markdown": f"""with {_TWO_RUNS}
select -2 as pos, '| task | fewshot | metric | base | sft | delta |' as line
union all select -1, '|---|---:|---|---:|---:|---:|'
union all select pos, '| ' || task || ' | ' || fewshot || ' | ' || coalesce(metric, '')
  || ' | ' || {_four_decimals("base_score")} || ' | ' || {_four_decimals("sft_score")}
  || ' | ' || {_four_decimals("delta")} || ' |'
from compared""",
    "metric_format": f"""with {_MANY_RUNS}
select run, task, {_four_decimals("base_score")} as base_score,
  {_four_decimals("sft_score")} as sft_score, {_four_decimals("delta")} as delta
from compared""",
    "metric_csv": f"""with {_MANY_RUNS}
select run, task, fewshot, metric, base_score, sft_score, delta from compared""",
    "conversation_pairs": f"with {_CONVERSATIONS} select * from pairs",
    "conversation_records": f"""with {_CONVERSATIONS}
select conv_id, turn, {_normal("question")} as instruction, '' as input,
  {_normal("response")} as output, {_SYSTEM} as system, '[]' as history, id as source_id
from pairs""",
    "stream_first_copy": f"""with {_SCORED}, {_selected(_WHOLE_BOUND)}, {_FIRST}
select seq, q, r from d where copy = 1""",
    "stream_clean": f"""with {_SCORED}, {_selected(_WHOLE_BOUND)}, {_FIRST}
select lower(q) as q, lower(r) as r from d where copy = 1""",
}
ORACLE_SQL["stream_progress"] = f"""select seen_rows, selected_rows, not_sampled_rows,
  kept_rows, dropped_dedup, dropped_empty, dropped_length, dropped_char_run,
  dropped_repetition, dropped_other, {QUARTER.probability}::double as p
from ({ORACLE_SQL["cleaning_stats"]})"""
ORACLE_SQL["published_dataset"] = ORACLE_SQL["jsonl_roundtrip"]
ORACLE_SQL["stream_progress_pushed"] = ORACLE_SQL["stream_progress"]
ORACLE_SQL["stats_roundtrip"] = ORACLE_SQL["cleaning_stats"]
ORACLE_SQL["result_files"] = ORACLE_SQL["metric_resolve"]
