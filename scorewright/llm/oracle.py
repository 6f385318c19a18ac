"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

from scorewright.llm.chat import CONTROLS
from scorewright.llm.queries import CONTROL_STRINGS


def _quoted(character: str) -> str:
    return "\\" + character if character in "<>|[]/()" else character


_CONTROL = "|".join("".join(map(_quoted, c[:1])) + r"\\*" + "".join(map(_quoted, c[1:])) for c in CONTROLS)

OP6 = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{CONTROL_STRINGS}' union all select -7, 1, 'assistant', '{CONTROL_STRINGS}'
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
  cast(sum(length(role) + length(text) + length('<|turn|>') + length('<|end|>') + 2
    + len(regexp_extract_all(text, '{_CONTROL}'))) as bigint) as formatted_chars
from rows group by conv_id
"""

OP2 = r"""
with recursive d as materialized (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
), s as materialized (
  select doc_id, unnest(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end)) as g from d
), n as materialized (select doc_id, count(*) as n from s group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), half as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
), links as materialized (select a, b from half union all select b, a from half),
reach as (
  select a, a as b from links union select r.a, l.b from reach r join links l on r.b = l.a
), low as (select a, min(b) as component_id from reach group by a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(low.component_id, d.doc_id) as component_id
from d left join n on n.doc_id = d.doc_id left join low on low.a = d.doc_id
"""

_FINITE = "len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))"

OP3 = f"""
with v as (
  select vec_id, embedding, row_number() over (partition by vec_id order by embedding) as place from embeddings
  where vec_id is not null and embedding is not null and {_FINITE}
), w as (
  select vec_id, place, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from v
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
  from w q join w c on q.vec_id % 50 = 0 and q.place = 1 and (q.vec_id <> c.vec_id or c.place <> 1) and len(q.e) = len(c.e)
), r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s
)
select * from r where rank <= 5
"""

OP5 = f"""
with recursive v as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where embedding is not null and label is not null and {_FINITE}
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links as materialized (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    and list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.93
), reach as (
  select a, a as b from links union select r.a, l.b from reach r join links l on r.b = l.a
), low as (select a, min(b) as component_id from reach group by a),
counts as (select a, count(*) as n_links from links group by a)
select vec_id, coalesce(n_links, 0) as n_links, coalesce(component_id, vec_id) as component_id,
  vec_id = coalesce(component_id, vec_id) as kept
from embeddings left join low on low.a = vec_id left join counts on counts.a = vec_id
"""

# CRC-32 as SQL: the table of bytes, then a step for each character (two for those of two bytes in UTF-8, which
# are below U+0100 here). ``named`` holds the strings ``s``; ``sums`` gives each its checksum.
_CHECKSUMS = """
bits as (
  select i, cast(i as bigint) as c, 0 as k from range(256) t(i)
  union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8
), crc_table as materialized (select list(c order by i) as l from bits where k = 8),
steps as (
  select s, 1 as pos, cast(4294967295 as bigint) as c from named
  union all
  select s, pos + 1, case when o < 128 then xor(c >> 8, l[(xor(c, o) & 255) + 1])
    else xor(xor(c >> 8, l[(xor(c, 195) & 255) + 1]) >> 8, l[(xor(xor(c >> 8, l[(xor(c, 195) & 255) + 1]), o - 64) & 255) + 1]) end
  from (select *, cast(unicode(substr(s, pos, 1)) as bigint) as o from steps where pos <= length(s)), crc_table
), sums as materialized (select s, xor(c, 4294967295) as h from steps where pos = length(s) + 1)
"""


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _way(top: str, cost: str, letters: str, condition: str = "true") -> str:
    return f"{{'c': {top}.c + case when {condition} then {cost} else 100000000 end, 'a': {top}.a || {letters}}}"


_READ = f"3 * cut + case when initial = '{{0}}' then 0 else 3 end", "case when initial = '{0}' then 'K' else 'R' end"

OP11 = f"""
with recursive given as materialized (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as s from conversations
), named as (select distinct s from given), {_CHECKSUMS},
damaged as (
  select coalesce(cast(conv_id as varchar), ' ') as conv, turn, case when h % 20 = 4 then 'user' else role end as role,
    case h % 20 when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from given join sums using (s) join (values (1), (2)) v(copy) on copy <= case h % 20 when 0 then 0 when 3 then 2 else 1 end
), placed as (
  select *, row_number() over (partition by conv order by turn nulls first, role, text) as i, left(role, 1) as initial,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as ending from damaged
), seen as (
  select *, row_number() over (partition by conv, role, text order by i) as again,
    lag(initial) over (partition by conv order by i) as before from placed
), rows as materialized (
  select conv, i, turn, role, text, initial, ending = '' as blank, ending <> '' and again > 1 as duplicate,
    ending not in ('', '.', '!', '?') and again = 1 as truncated, ending = '' or again > 1 as gone,
    cast(ending not in ('', '.', '!', '?') and again = 1 as integer) as cut,
    before is not null and before || initial not in ('su', 'ua', 'au') as illegal from seen
), sizes as (select conv, max(i) as n from rows group by conv),
tops as (
  select conv, 0 as i, {{'c': 0, 'a': ''}} as e, {{'c': 100000000, 'a': ''}} as s, {{'c': 100000000, 'a': ''}} as u, {{'c': 100000000, 'a': ''}} as p from sizes
  union all
  select conv, i, {_way('e', '4', "'D'")},
    {_least(_way('s', '4', "'D'"), _way('e', '3 * cut', "'K'", "not gone and initial = 's'"))},
    {_least(_way('xu', '4', "'D'"), *[_way(t, _READ[0].format('u'), _READ[1].format('u'), 'not gone') for t in ('e', 's', 'xp')])},
    {_least(_way('xp', '4', "'D'"), _way('xu', _READ[0].format('a'), _READ[1].format('a'), 'not gone'))}
  from (
    select t.conv, r.i, e, s, initial, gone, cut, {_least('u', _way('e', '3', "'I'"), _way('s', '3', "'I'"), _way('p', '3', "'I'"))} as xu,
      {_least('p', _way('u', '3', "'I'"), _way('e', '6', "'II'"), _way('s', '6', "'II'"))} as xp
    from tops t join rows r on r.conv = t.conv and r.i = t.i + 1
  )
), best as materialized (
  select conv, {_least('e', 'p', _way('u', '3', "'I'"), _way('e', '6', "'II'"), _way('s', '6', "'II'"))} as w from tops join sizes using (conv) where i = n
), letters as (
  select conv, j, w.a[j] as letter, length(replace(left(w.a, j), 'I', '')) as i, length(replace(left(w.a, j), 'D', '')) as place
  from best, lateral (select unnest(generate_series(1, length(w.a))) as j)
), opened as (
  select l.conv, bool_or(l.letter = 'K' and r.initial = 's') as system from letters l join rows r on r.conv = l.conv and r.i = l.i where l.letter <> 'D' group by l.conv
), lines as (
  select l.conv, j, case when letter = 'K' then r.role when (place + cast(system as integer)) % 2 = 1 then 'user' else 'assistant' end
    || ':' || case when letter = 'I' then '' else r.text end as line
  from letters l left join opened o on o.conv = l.conv left join rows r on r.conv = l.conv and r.i = l.i and letter <> 'I' where letter <> 'D'
), said as (select conv, string_agg(line, chr(10) order by j) as text from lines group by conv),
counts as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(blank) as blank, count_if(duplicate) as duplicate,
    count_if(truncated) as truncated, count_if(illegal) as illegal from rows group by conv
)
select g.conv_id, coalesce(gaps, 0) as gaps, cast(coalesce(blank, 0) as bigint) as blank, cast(coalesce(duplicate, 0) as bigint) as duplicate,
  cast(coalesce(truncated, 0) as bigint) as truncated, cast(coalesce(illegal, 0) as bigint) as illegal, cast(coalesce(w.c, 0) as bigint) as cost,
  coalesce(w.a, '') as audit, sha256(coalesce(said.text, '')) as repaired_sha256
from (select distinct conv_id, coalesce(cast(conv_id as varchar), ' ') as conv from given) g
left join counts using (conv) left join best using (conv) left join said using (conv)
"""

OP13 = f"""
with recursive runs as materialized (
  select doc_id, run, count(*) as n, coalesce(cast(doc_id as varchar), '') || ':' || run as s from (
    select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents
  ) where length(run) >= 6 group by doc_id, run
), named as (select distinct s from runs), {_CHECKSUMS},
words as materialized (
  select word, cast(sum(n) as bigint) as n from (
    select case when h % 199 = 0 then left(run, cast(h % length(run) as integer)) || substr(run, cast(h % length(run) as integer) + 2) else run end as word, n from runs join sums using (s)
  ) where length(word) >= 6 group by word having sum(n) >= 5
), shorter as materialized (select word, i, left(word, cast(i - 1 as integer)) || substr(word, cast(i + 1 as integer)) as v from words, lateral (select unnest(generate_series(1, length(word))) as i)),
pairs as materialized (
  select a.word, b.word as near from shorter a join shorter b on a.i = b.i and a.v = b.v and a.word <> b.word
  union select word, v from shorter where v in (select word from words)
  union select v, word from shorter where v in (select word from words)
), ranked as (
  select p.word, near, w.n as near_n, row_number() over (partition by p.word order by w.n desc, near) as place, count(*) over (partition by p.word) as n_near
  from pairs p join words w on w.word = p.near
), formed as materialized (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * w.n then near end as form, case when near_n >= 5 * w.n then near_n end as form_n
  from words w left join ranked r on r.word = w.word and place = 1
), chain as (
  select word, word as root, 0 as k from formed
  union all select c.word, f.form, k + 1 from chain c join formed f on f.word = c.root where f.form is not null
)
select f.word, form, root, n, n_near, form_n from formed f join (select word, arg_max(root, k) as root from chain group by word) using (word)
"""

ORACLE: dict[str, str] = {
    "op2_jaccard_join": OP2, "op3_topk_search": OP3, "op5_near_vectors": OP5, "op6_chat_formatting": OP6,
    "op11_conversation_repair": OP11, "op13_spelling_variants": OP13,
}
