"""DuckDB twins of the queries whose rows SQL can give."""

from __future__ import annotations

WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

#: Links by the inverted index of all shingles, components by reachability.
NEAR_DUPLICATES = f"""
with recursive sets as (
  select doc_id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as tokens
  from (select doc_id, coalesce({WORDS}, []) as w from documents)
),
entries as (select doc_id, len(tokens) as n, unnest(tokens) as token from sets),
links as (
  select a.doc_id as a, b.doc_id as b from entries a join entries b using (token) where a.doc_id <> b.doc_id
  group by a.doc_id, a.n, b.doc_id, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b)
select s.doc_id, cast(len(tokens) as bigint) as n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) as component_id
from sets s left join reach r on r.a = s.doc_id group by s.doc_id, len(tokens)
"""

#: A field is escaped if it holds a control string or what unescaping would change.
CHAT = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
written as (
  select *,
    case when regexp_matches(text, '<\|im_start\|>|<\|im_end\|>|<\\+\|') then regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') else text end as out,
    case when regexp_matches(role, '<\|im_start\|>|<\|im_end\|>|<\\+\||\n|\\\\|\\n')
      then replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '\', '\\'), chr(10), '\n') else role end as out_role
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<|im_start|>') + length(out_role) + 1 + length(out) + length('<|im_end|>') + 1) as bigint) as formatted_chars
from written group by conv_id
"""



def crc32(text: str) -> str:
    """The crc32 of a text's UTF-8 bytes, one step per bit: a byte goes in, then come eight shifts (-1)."""
    hexed = f"hex({text})"
    byte = f"cast(('0x' || {hexed}[2 * i + 1:2 * i + 2]) as bigint)"
    steps = f"flatten(list_transform(range(0, length({hexed}) // 2), lambda i: [{byte}, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end"
    return f"xor(list_reduce(list_concat([4294967295], {steps}), lambda c, x: {step}), 4294967295)"


#: A node is below another if its smallest member goes through both.
PREFIX_TRIE = f"""
with own as (
  select conv_id, coalesce(text, '') as text, digest, row_number() over (partition by conv_id order by turn nulls first, digest) as pos
  from (select *, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as digest from conversations where conv_id is not null)
),
convs as (select conv_id, conv_id - conv_id % 100 as base, {crc32("cast(conv_id as varchar)")} % 6 as h from (select distinct conv_id from own)),
turns as (
  select c.conv_id, 0 as part, o.pos, o.text, o.digest from convs c join own o on o.conv_id = c.base and o.pos <= c.h
  union all select c.conv_id, 1, o.pos, o.text, o.digest from convs c join own o on o.conv_id = c.conv_id and o.pos > c.h
),
path as (
  select conv_id, row_number() over w as depth, length(text) as chars, md5(string_agg(digest, '') over w) as node
  from turns window w as (partition by conv_id order by part, pos)
  union all select conv_id, 0, 0, '' from convs
),
steps as (select *, lag(node) over w as up, lead(node) over w is null as is_end from path window w as (partition by conv_id order by depth)),
nodes as (
  select node, min(conv_id) as conv_id, min(depth) as depth, min(up) as up, count(*) as n_convs, min(chars) as chars,
    coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (is_end), '') as ends
  from steps group by node
),
children as (select up as node, count(*) as n from nodes where up is not null group by up),
below as (
  select s.node, count(*) filter (c.n is null) as leaves, sum((u.n_convs - 1) * u.chars) as saved
  from nodes u left join children c on c.node = u.node join steps s on s.conv_id = u.conv_id and s.depth <= u.depth group by s.node
)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children,
  b.leaves as n_leaves, cast(b.saved as bigint) as saved_tokens, sha256(n.ends) as ends_sha256
from nodes n join below b on b.node = n.node left join nodes p on p.node = n.up left join children c on c.node = n.node
"""

FEATURES = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

#: The crc32 of every distinct word once; each count that the bisection finds is a row number here.
RESAMPLING = f"""
with docs as (select row_number() over () as r, doc_id, {FEATURES} as w from documents),
targets as (select {FEATURES} as w from benchmark),
found as (select r, unnest(w) as word from docs),
wanted as (select unnest(w) as word from targets),
buckets as (select word, {crc32("word")} % 10000 as bucket from (select word from found union select word from wanted)),
s as (select bucket, count(*) as s from found join buckets using (word) group by bucket),
t as (select bucket, count(*) as t from wanted join buckets using (word) group by bucket),
totals as (select (select count(*) from found) as s_all, (select count(*) from wanted) as t_all),
gain as (
  select bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1.0::double) * (s_all + 10000.0::double) / ((coalesce(s, 0) + 1.0::double) * (t_all + 10000.0::double)))) as bigint) as gain
  from (select distinct bucket from buckets) left join s using (bucket) left join t using (bucket), totals
),
weights as (select r, cast(sum(gain) as bigint) as weight from found join buckets using (word) join gain using (bucket) group by r),
scores as (
  select d.r, d.doc_id, cast(len(d.w) as bigint) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast(('0x' || sha256('2024:' || coalesce(cast(d.doc_id as varchar), ''))[1:8]) as bigint) + 0.5::double) / 4294967296.0::double))) as bigint) as score
  from docs d left join weights using (r)
),
ranks as (
  select r, row_number() over (order by score desc, doc_id nulls last, n_features) as rank, count(*) over () as n from scores where n_features >= 20
)
select doc_id, n_features, weight, score, case when rank <= 10 * n // 100 then rank end as rank from scores left join ranks using (r)
"""

ORACLE: dict[str, str] = {
    "op3_signature_trees": NEAR_DUPLICATES,
    "op8_chat_grammar": CHAT,
    "op11_prefix_trie": PREFIX_TRIE,
    "op13_importance_resampling": RESAMPLING,
}
