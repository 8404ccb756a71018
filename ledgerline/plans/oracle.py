"""DuckDB statements equivalent to the named queries (the correctness oracle).

Each statement derives the log L1 from `events` inline (the same rules as ``sources.fixtures``) and then
states the query in plain SQL.
"""

from __future__ import annotations

from ..schema import POST_FIELDS

LOG_CTE = """
with a as (
  select *, 0 as attempt from events
  union all
  select *, 1 from events where event_id % 50 = 0),
log as (
  select event_id::varchar as key,
         case when event_id % 97 = 0 then null
              when event_id % 89 = 0 then case (event_id // 89) % 4
                when 0 then '{bad' when 1 then '   ' when 2 then '{"id":"x","extra":1}' else '{"id":{"of":"x"}}' end
              else json_object('id', event_id::varchar,
                               'author', 'author' || user_id,
                               'description', 'description' || event_type,
                               'text', props,
                               'createdAt', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'),
                               'updatedAt', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'))::varchar end as value,
         'posts' as topic,
         (user_id % 20)::int as partition,
         (row_number() over (partition by user_id % 20 order by attempt, event_id) - 1)::bigint as "offset",
         ts as "timestamp"
  from a)"""

_KNOWN = ", ".join(f"'{f}'" for f in POST_FIELDS)
_NESTED = " or ".join(f"coalesce(json_type(value, '$.{f}') in ('OBJECT', 'ARRAY'), false)" for f in POST_FIELDS)

# strict-decode status of `value`, the same guards as functions.codec.decode_status
STATUS = f"""case
  when value is null then 'skip'
  when regexp_matches(value, '^\\s*$') then 'empty'
  when not coalesce(json_valid(value), false) or json_type(value) <> 'OBJECT' then 'malformed'
  when len(list_filter(json_keys(value), lambda k: k not in ({_KNOWN}))) > 0 then 'unknown_field'
  when {_NESTED} then 'nested_value'
  else 'ok' end"""

DECODED_CTE = f""",
decoded as (
  select *, {STATUS} as decode_status from log)"""

# Q3: first storable record per key in (partition, offset) order
FIRST_SUCCESS_CTE = """,
firsts as (
  select key as id, coalesce(value, 'null') as post_json, topic,
         partition::bigint as topic_partition, "offset" as partition_offset
  from (select *, row_number() over (partition by key order by partition, "offset") as rn
        from decoded where decode_status in ('ok', 'skip') and key is not null)
  where rn = 1)"""


def with_log(body: str, decoded: bool = False, firsts: bool = False) -> str:
    ctes = LOG_CTE + (DECODED_CTE if decoded or firsts else "") + (FIRST_SUCCESS_CTE if firsts else "")
    return ctes + "\n" + body


def field(name: str) -> str:
    return f"json_extract_string(value, '$.{name}')"


def firsts_of(source: str) -> str:
    """Q3 over a subset of the decoded log."""
    return f"""(select key as id, coalesce(value, 'null') as post_json, topic,
         partition::bigint as topic_partition, "offset" as partition_offset
  from (select *, row_number() over (partition by key order by partition, "offset") as rn
        from ({source}) s where decode_status in ('ok', 'skip') and key is not null) r
  where rn = 1)"""


# the consumer that stopped after half of each partition (see plans.catalog.halves)
HALF = "case when partition % 7 = 3 then 0 else (count(*) over (partition by topic, partition)) // 2 end"
STOPPED = firsts_of(f'select * from (select *, {HALF} as stop from decoded) h where "offset" < stop')
FULL = firsts_of("select * from decoded")


def split_case(pos: str, n: str, k: int, equal: bool) -> str:
    q = f"({n} // {k})"
    tail = f"({pos} - {q} * {k})" if equal else str(k - 1)
    return f"(case when {pos} < {q} * {k} then {pos} // {q} else {tail} end)::int"


def _even_split(equal: bool) -> str:
    return with_log(f"""
select key, partition, "offset", {split_case('i', 'n', 7, equal)} as split_id
from (select *, row_number() over (order by partition, "offset") - 1 as i, count(*) over () as n from log) t""")


READERS = f"""
readers as (
  select topic, partition, {split_case('i', 'n', 6, True)} as split_id
  from (select topic, partition, row_number() over (order by topic, partition) - 1 as i, count(*) over () as n
        from (select distinct topic, partition from log) p) t)"""

_POST_COLS = ", ".join(f"{field(f)} as {f}" for f in POST_FIELDS)
_DOC_PARTITION = "((('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint) % 20)::int"
_EVENT_PARTITION = "((('0x' || substr(md5(event_id::varchar), 1, 8))::bigint) % 20)::int"

ORACLE: dict[str, str] = {
    "log_scan": with_log('select key, value, topic, partition, "offset" from log'),
    "assigned_scan": with_log('select key, value, topic, partition, "offset" from log where partition in (3, 7, 11)'),
    "poll_batches": with_log('select key, partition, "offset", "offset" // 100 as poll from log'),
    "partition_list": with_log("select distinct topic, partition from log"),
    "partition_count": with_log("select topic, count(distinct partition)::bigint as n_partitions from log group by topic"),
    "drop_tombstones": with_log('select key, value, partition, "offset" from log where value is not null'),
    "post_deliveries": with_log(
        f"""select {field('id')} as post_id, partition, "offset" from decoded where decode_status = 'ok'""", decoded=True
    ),
    "next_offsets": with_log('select topic, partition, "offset" + 1 as next_offset from log'),
    "partition_predicate": with_log(
        f"""select id, post_json, topic_partition, partition_offset from {FULL} s
            where topic = 'posts' and topic_partition = 7""", decoded=True
    ),
    "quarantine": with_log(
        """select key, value, partition, "offset",
                  case when key is null then 'null_key' else decode_status end as reason
           from decoded where key is null or decode_status not in ('ok', 'skip')""", decoded=True
    ),
    "decode_posts": with_log(
        f"""select {_POST_COLS}, partition, "offset" from decoded where decode_status = 'ok'""", decoded=True
    ),
    "commit_ledger": with_log('select topic, partition, max("offset") + 1 as next_offset from log group by topic, partition'),
    "highest_offset": with_log(
        """select topic, partition, max("offset") as max_offset, max("offset") + 1 as next_offset
           from decoded where decode_status = 'ok' group by topic, partition""", decoded=True
    ),
    "sink_max_offset": with_log(
        f"""select p.topic, p.partition, coalesce(s.max_offset, 0)::bigint as max_offset
            from (select distinct topic, partition from log) p
            left join (select topic, topic_partition::int as partition, max(partition_offset) as max_offset
                       from {STOPPED} x group by 1, 2) s
              on p.topic = s.topic and p.partition = s.partition""", decoded=True
    ),
    "records_by_partition": with_log(
        """select "offset" // 100 as poll, topic, partition, count(*) as n_records, count(value) as n_values,
                  min("offset") as first_offset, max("offset") as last_offset
           from log group by 1, 2, 3"""
    ),
    "commits_per_batch": with_log(
        """select topic, partition, "offset" // 100 as poll, max("offset") + 1 as committed_offset, count(*) as n_records
           from log group by 1, 2, 3"""
    ),
    "resume_from_sink": with_log(
        f"""select l.key, l.partition, l."offset" from log l
            left join (select topic, topic_partition::int as partition, max(partition_offset) as start
                       from {STOPPED} x group by 1, 2) s
              on l.topic = s.topic and l.partition = s.partition
            where l."offset" >= coalesce(s.start, 0)""", decoded=True
    ),
    "resume_from_ledger": with_log(
        f"""select l.key, l.partition, l."offset" from log l
           left join (select topic, partition, max("offset") + 1 as start
                      from (select *, {HALF} as stop from log) h where "offset" < stop group by 1, 2) s
             on l.topic = s.topic and l.partition = s.partition
           where l."offset" >= coalesce(s.start, 0)"""
    ),
    "new_ids_only": with_log(
        f"""select key, partition, "offset" from (select *, {HALF} as stop from log) h
            where "offset" >= stop and key not in (select id from {STOPPED} x)""", decoded=True
    ),
    "ordered_position": with_log(
        """select key, partition, "offset", row_number() over (partition by topic, partition order by "offset") - 1 as position
           from log where value is not null"""
    ),
    "decoupled_process": with_log(
        f"""select {field('id')} as post_id, {field('author')} as author, partition, "offset"
            from decoded where decode_status = 'ok'""", decoded=True
    ),
    "per_partition_summary": with_log(
        """select topic, partition, count(*) as n_records, count(*) - count(value) as n_tombstones,
                  min("offset") as first_offset, max("offset") as last_offset
           from log group by topic, partition"""
    ),
    "even_split_equal": _even_split(True),
    "even_split_last": _even_split(False),
    "reader_assignment": LOG_CTE + "," + READERS + """
select split_id, list(partition order by partition)::varchar as partitions from readers group by split_id""",
    "merged_scan": LOG_CTE + "," + READERS + """
select l.key, l.partition, l."offset", r.split_id from log l join readers r on l.topic = r.topic and l.partition = r.partition""",
    "publish_encode": f"""
select event_id::varchar as key,
       json_object('id', event_id::varchar, 'author', 'author' || user_id, 'description', 'description' || event_type,
                   'text', props, 'createdAt', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'),
                   'updatedAt', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'))::varchar as value,
       'posts' as topic, {_EVENT_PARTITION} as partition
from events""",
    "publish_keyed": f"""
select key, value, topic, "index", ((('0x' || substr(md5(key), 1, 8))::bigint) % 20)::int as partition
from (
  select substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) as key,
         json_object('id', event_id::varchar, 'author', 'author' || user_id, 'description', 'description' || event_type,
                     'text', props, 'createdAt', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'),
                     'updatedAt', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'))::varchar as value,
         'posts' as topic, (('0x' || substr(h, 33, 8))::bigint - 2147483648)::int as "index"
  from (select *, sha256(event_id::varchar || chr(1) || event_type) as h from events) e) k""",
    "publish_roundtrip": f"""
select id, author, description, text, createdAt, updatedAt, partition,
       (row_number() over (partition by partition order by id) - 1)::bigint as "offset"
from (select doc_id::varchar as id, source as author, lang as description, text,
             null::varchar as createdAt, null::varchar as updatedAt, {_DOC_PARTITION} as partition
      from documents) d""",
    "udf_process": with_log(
        f"""select {field('id')} || ' at ' || partition || '/' || "offset" as delivered
            from decoded where decode_status = 'ok'""", decoded=True
    ),
    "audit_duplicates": with_log(
        f"""select post_id, partition, count(*) as copies, min("offset") as first_offset, max("offset") as last_offset
            from (select {field('id')} as post_id, partition, "offset" from decoded where decode_status = 'ok') d
            group by post_id, partition having count(*) > 1""", decoded=True
    ),
    "audit_missing": with_log(
        f"""select l.key, l.topic, l.partition, l."offset", (l.key in (select id from firsts)) as key_stored
            from log l
            where not exists (select 1 from firsts f where f.topic = l.topic and f.topic_partition = l.partition
                              and f.partition_offset = l."offset")""", firsts=True
    ),
    "first_success_per_key": with_log(
        "select id, post_json, topic, topic_partition, partition_offset from firsts", firsts=True
    ),
}


_DELIVERED = f"""select {field('id')} as post_id, partition, "offset" from decoded where decode_status = 'ok'"""

# `conversations` published as a keyed log (md5 key partitioner, offsets in (conversation, turn)
# order), first post per conversation
ORACLE["conversation_firsts"] = """
with c as (
  select *, ((('0x' || substr(md5(conv_id::varchar), 1, 8))::bigint) % 20)::int as partition from conversations),
o as (
  select *, row_number() over (partition by partition order by conv_id, turn) - 1 as "offset" from c)
select conv_id::varchar as id, conv_id::varchar || ':' || turn::varchar as post_id, role as author, text,
       partition::bigint as topic_partition, "offset" as partition_offset
from (select *, row_number() over (partition by conv_id order by partition, "offset") as rn from o) f
where rn = 1"""

# Stream queries: a stream run to the end equals its batch twin.
ORACLE.update({
    "log_stream_scan": ORACLE["log_scan"],
    "key_value_stream": with_log("select key, value from log"),
    "at_least_once_stream": ORACLE["post_deliveries"],
    "assigned_stream": with_log(_DELIVERED + " and partition in (3, 7, 11)", decoded=True),
    "exactly_once_sink": ORACLE["first_success_per_key"],
    "exactly_once_keyed": ORACLE["first_success_per_key"],
    "resume_table_stream": ORACLE["first_success_per_key"],
    "resume_table_keyed": ORACLE["first_success_per_key"],
    "stream_ledger": ORACLE["commit_ledger"],
    "stream_quarantine": ORACLE["quarantine"],
    "highest_offset_stream": ORACLE["highest_offset"],
    "resume_stream": with_log(
        f"""select post_id, partition, "offset", count(*) as deliveries from ({_DELIVERED}) d
            group by post_id, partition, "offset" """, decoded=True),
    "replay_stream": with_log(
        f"""select post_id, partition, "offset", 2 * count(*) as deliveries from ({_DELIVERED}) d
            group by post_id, partition, "offset" """, decoded=True),
    "seek_stream": with_log(
        f"""select {field('id')} as post_id, d.partition, d."offset" from decoded d
            left join (select topic, topic_partition::int as partition, max(partition_offset) as start
                       from {STOPPED} x group by 1, 2) s
              on d.topic = s.topic and d.partition = s.partition
            where d.decode_status = 'ok' and d."offset" >= coalesce(s.start, 0)""", decoded=True),
})

# K1 -> S1 -> K3: `events` published in two appends (split by event time), offsets per key partition
# in (append, key) order, every record stored once
ORACLE["published_stream"] = """
with p as (
  select event_id::varchar as key,
         json_object('id', event_id::varchar, 'author', 'author' || user_id,
                     'description', 'description' || event_type, 'text', props,
                     'createdAt', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'),
                     'updatedAt', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'))::varchar as value,
         ((('0x' || substr(md5(event_id::varchar), 1, 8))::bigint) % 20)::int as partition,
         case when ts < timestamp '2024-01-16 00:00:00' then 0 else 1 end as append_no
  from events),
o as (
  select *, row_number() over (partition by partition order by append_no, key) - 1 as "offset" from p)
select key as id, value as post_json, 'posts' as topic, partition::bigint as topic_partition,
       "offset"::bigint as partition_offset
from o"""

# polls of the longest partition's backlog (see plans.streams.POLLS): so many offsets of each partition at a time
_POLL = '(select ceil((max("offset") + 1) / 4.0)::bigint from log)'
ORACLE["paced_stream"] = with_log(f'select key, partition, "offset", "offset" // {_POLL} as poll from log')
ORACLE["paced_seek_stream"] = with_log(
    f"""select key, l.partition, l."offset", (l."offset" - coalesce(s.start, 0)) // {_POLL} as poll from log l
        left join (select topic, topic_partition::int as partition, max(partition_offset) as start
                   from {STOPPED} x group by 1, 2) s
          on l.topic = s.topic and l.partition = s.partition
        where l.partition in (3, 7, 11) and l."offset" >= coalesce(s.start, 0)""", decoded=True)

# the checksum chained record by record: one step of the recursion takes every partition one record on
ORACLE["running_checksum"] = "with recursive a as (" + LOG_CTE.split("with a as (", 1)[1] + """,
chained as (
  select topic, partition, key, "offset", (key::bigint % 1000000007) as checksum from log where "offset" = 0
  union all
  select l.topic, l.partition, l.key, l."offset", (c.checksum * 31 + l.key::bigint) % 1000000007
  from chained c join log l on l.topic = c.topic and l.partition = c.partition and l."offset" = c."offset" + 1)
select key, partition, "offset", checksum from chained"""
ORACLE["ordered_callback"] = with_log('select key, partition, "offset", 1::bigint as gap from log')

# holes of the delivered offsets by what was delivered just before; retries cover nothing that was not delivered
_HOLES = """,
delivered as (
  select topic, partition, "offset", coalesce(lag("offset") over (partition by topic, partition order by "offset") + 1, 0) as reached
  from decoded where decode_status = 'ok')"""
ORACLE["missing_ranges"] = LOG_CTE + DECODED_CTE + _HOLES + """
select topic, partition, reached as lo, "offset" as hi from delivered where "offset" > reached"""
ORACLE["completion_frontier"] = LOG_CTE + DECODED_CTE + _HOLES + """
select topic, partition, coalesce(min(reached) filter ("offset" > reached), max("offset") + 1)::bigint as frontier,
       max("offset") + 1 as highest, count(*) filter ("offset" > reached) as n_gaps, sum("offset" - reached)::bigint as n_missing
from delivered group by topic, partition"""
