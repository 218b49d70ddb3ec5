r"""SQL (DuckDB) for the operators that it can express: chat formatting and the n-gram Jaccard join.

The Jaccard SQL makes every pair of documents that share a shingle, so it is for small tables only.
"""

from __future__ import annotations

CHAT = r"""with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, v.turn, v.role, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(turn, role)),
  g as (select conv_id, count(*) as n_turns, string_agg(concat(role, chr(10), text, chr(10)), '' order by turn, role, text) as flat, coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
    sum(24 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) as chars from t group by conv_id)
  select conv_id, n_turns, sha256(flat) as turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256, chars::bigint as formatted_chars from g"""

JACCARD = r"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
  s as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) end) as g from w),
  n as (select doc_id, count(*) as n from s group by doc_id),
  p as (select a.doc_id as x, b.doc_id as y, count(*) as shared from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
  e as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * shared >= 90 * (a.n + b.n - shared)),
  r as (select doc_id, doc_id as c from documents union select l.y, r.c from r join (select x, y from e union all select y, x from e) l on l.x = r.doc_id where r.c < l.y)
  select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.c as component_id from documents d left join n using (doc_id) join (select doc_id, min(c) as c from r group by doc_id) m using (doc_id)"""

ORACLE: dict[str, str] = {"op2_chat": CHAT, "op9_jaccard": JACCARD}
