"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

#: A control string of the chat template with the escapes it may hold: first character, escapes and rest.
_CONTROL = r"(<)(\\*(?:conversation>|/?s>))|(\[)(\\*(?:/?INST\]|/?SYS\]|/?ROLE\]|END\]))"


def _escaped(column: str) -> str:
    return rf"regexp_replace({column}, '{_CONTROL}', '\1\3\\\2\4', 'g')"


#: The machine is stated as a pattern over the turns' letters, the escapes as one replacement.
OP13 = f"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as i,
         case role when 'system' then 's' when 'user' then 'u' when 'assistant' then 'a' else 'x' end as letter
  from rows_),
turns as (
  select *, length({_escaped('text')}) + (case when i = 1 then length('<conversation>\n') else 0 end)
            + case letter when 's' then length('[SYS]  [/SYS]\n') when 'u' then length('[INST]  [/INST]')
                          when 'a' then length('<s>  </s>\n')
                          else length('[ROLE]  [/ROLE]  [END]\n') + length({_escaped('role')}) end as chars
  from placed)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
       coalesce(sum(length(text)) filter (letter = 'a'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by i) filter (letter = 'a'), '')) as loss_sha256,
       sum(chars)::bigint as formatted_chars,
       regexp_full_match(string_agg(letter, '' order by i), 's?(ua)+') as valid
from turns group by conv_id"""


def _rounds(n: int) -> str:
    """Assignment and averaging, ``n`` times, then the last assignment: a packed (squared distance, index) per part."""
    out = []
    for r in range(n + 1):
        out.append(f"""
near_{r} as materialized (
  select v.id, v.label, v.p, v.x,
         min((list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, b.x) + list_dot_product(b.x, b.x)) * 256 + b.e)::bigint as packed
  from parts v join book_{r} b on v.p = b.p group by v.nth, v.id, v.label, v.p, v.x),""")
        if r < n:
            out.append(f"""
mean_{r} as (
  select p, e, list(m order by place) as x from (
    select p, e, place, floor(sum(c) / count(*)) as m
    from (select p, packed % 256 as e, unnest(x) as c, unnest(range(len(x))) as place from near_{r}) s group by p, e, place) t
  group by p, e),
book_{r + 1} as materialized (select b.p, b.e, coalesce(m.x, b.x) as x from book_{r} b left join mean_{r} m on b.p = m.p and b.e = m.e),""")
    return "".join(out)


#: Every entry is a candidate here; distances are integers held exactly by doubles.
OP11 = f"""
with kept as (
  select row_number() over (order by vec_id nulls last, embedding) - 1 as nth, vec_id as id, label,
         list_transform(embedding, lambda c: floor(1024 * c::double)) as x
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
parts as materialized (
  select nth, id, label, p, list_slice(x, p * len(x) // 4 + 1, (p + 1) * len(x) // 4) as x from kept, range(4) t(p)),
book_0 as materialized (select p, nth as e, x from parts where nth < 256),{_rounds(4)}
coded as (
  select id, label, string_agg(printf('%02x', packed % 256), '' order by p) as code, sum(packed // 256)::bigint as error
  from near_4 group by id, label),
digest as (
  select sha256(string_agg(c::bigint::varchar, ',' order by p, e, place)) as codebooks_sha256
  from (select p, e, unnest(x) as c, unnest(range(len(x))) as place from book_4) t)
select id as vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded, digest"""

#: Vectors that can link, or take part in a search: every component finite.
_FINITE = "embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0"

#: All pairs of a label; what is reachable by links is followed node by node.
OP1 = f"""
with recursive good as materialized (
  select id, label, x, sqrt(list_dot_product(x, x)) as norm
  from (select vec_id as id, label, list_transform(embedding, lambda c: c::double) as x from embeddings
        where vec_id is not null and label is not null and {_FINITE} and len(list_filter(embedding, lambda c: c <> 0)) > 0) t),
links as materialized (
  select a.id as a, b.id as b from good a join good b on a.label = b.label and a.id <> b.id and len(a.x) = len(b.x)
  where list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.93),
reach as (
  select a as id, b as other from links
  union select r.id, l.b from reach r join links l on r.other = l.a),
degree as (select a as id, count(*) as n from links group by a),
least_ as (select id, min(other) as other from reach group by id)
select vec_id, coalesce(d.n, 0)::bigint as n_links, least(vec_id, coalesce(r.other, vec_id))::bigint as component_id,
       coalesce(vec_id = least(vec_id, coalesce(r.other, vec_id)), true) as kept
from embeddings e left join degree d on e.vec_id = d.id left join least_ r on e.vec_id = r.id"""

#: Sets of equal shingles are one class; classes are joined by each shingle they share.
OP6 = r"""
with recursive texts as (
  select doc_id as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents where doc_id is not null),
words as (select id, len(w) as k, unnest(range(len(w))) as i, unnest(w) as word from texts),
grams as materialized (
  select distinct id, s from (
    select id, i, k, concat_ws(' ', word, lead(word, 1) over o, lead(word, 2) over o, lead(word, 3) over o, lead(word, 4) over o) as s
    from words window o as (partition by id order by i)) t
  where i + 5 <= k or (i = 0 and k < 5)),
sets as (select id, count(*) as n, md5(string_agg(s, chr(10) order by s)) as digest from grams group by id),
members as materialized (select id, n, min(id) over (partition by n, digest) as class_id from sets),
reps as materialized (select g.id, m.n, g.s from grams g join members m on g.id = m.id where m.id = m.class_id),
links as materialized (
  select a, b from (
    select a.id as a, b.id as b, a.n + b.n as total, count(*) as common
    from reps a join reps b on a.s = b.s and a.id <> b.id and 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) group by a.id, b.id, a.n, b.n) t
  where 100 * common >= 75 * (total - common)),
reach as (
  select a as id, b as other from links
  union select r.id, l.b from reach r join links l on r.other = l.a),
degree as (select a as id, count(*) as n from links group by a),
least_ as (select id, min(other) as other from reach group by id)
select t.id as doc_id, coalesce(m.n, 0)::bigint as n_shingles, coalesce(m.class_id, t.id)::bigint as class_id, coalesce(d.n, 0)::bigint as n_links,
       least(coalesce(m.class_id, t.id), coalesce(r.other, t.id))::bigint as component_id
from texts t left join members m on t.id = m.id left join degree d on m.class_id = d.id left join least_ r on m.class_id = r.id"""

#: Every query against every row; products and sums are integers.
OP10 = f"""
with kept as materialized (
  select vec_id as id, list_transform(embedding, lambda c: floor(256 * c::double)) as x
  from embeddings where vec_id is not null and {_FINITE}),
scored as (
  select q.id as query_id, v.id as vec_id, list_dot_product(q.x, v.x)::bigint as score
  from kept q join kept v on q.id <> v.id and len(q.x) = len(v.x) where q.id % 50 = 0),
ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5"""

ORACLE: dict[str, str] = {
    "op1_embedding_near_dedup": OP1, "op6_ngram_jaccard_join": OP6, "op10_exact_top_k": OP10, "op11_vector_code": OP11, "op13_chat_format": OP13,
}
