"""SQL that computes each registered query straight from the base tables, without JSON."""

from __future__ import annotations

# b: one change per event; l: with the previous change of the user; decoded: readable events; moved: the old rows left
# behind by updates that change the country; rows: records.
_FEED = """
with b as (
  select event_id as pos, user_id, event_type, cast(floor(epoch(ts)) as bigint) as epoch,
    concat('user', cast(user_id as varchar)) as username, concat('pw', cast(event_id as varchar)) as password,
    cast(event_id % 2 as int) as enabled,
    cast(floor(epoch(ts)) as bigint) - case when event_id % 11 = 0 then 432000 else 0 end as ts,
    case (user_id + case when event_id % 7 = 0 then 1 else 0 end) % 3
      when 0 then 'SG' when 1 then 'ID' else 'MY' end as country,
    case when floor(epoch(ts)) >= 1705363200 then cast(event_id % 100 as int) end as number,
    strftime(ts, '%Y%m%d') || '000000000' as commit_time,
    case when event_id % 97 = 0 then 't' when event_type = 'signup' then 'c' when event_type = 'view' then 'r'
      when event_type = 'error' then 'd' else 'u' end as op,
    case when event_id % 101 = 0 then 'malformed' when event_id % 103 = 0 then 'tombstone' else 'ok' end as kind
  from events),
l as (
  select *, coalesce(lag(password) over w, password) as b_password, coalesce(lag(enabled) over w, enabled) as b_enabled,
    coalesce(lag(ts) over w, ts) as b_ts, coalesce(lag(country) over w, country) as b_country,
    case when lag(pos) over w is null then number else lag(number) over w end as b_number
  from b window w as (partition by user_id order by pos)),
decoded as (select * from l where kind = 'ok'),
rows as (
  select pos, commit_time, username, op,
    case when op = 'd' then b_password else password end as password,
    case when op = 'd' then b_enabled else enabled end as enabled,
    case when op = 'd' then b_ts else ts end as ts,
    case when op = 'd' then b_country else country end as country,
    case when op = 'd' then b_number else number end as number,
    op = 'd' as is_deleted
  from decoded where op in ('r', 'c', 'u', 'd'))
"""


def _pick(name: str, source: str, group: str, order: str, where: str = "true") -> str:
    """CTE ``name``: the first row of each group."""
    return f""",
{name} as (select * exclude (rn) from (
  select *, row_number() over (partition by {group} order by {order}) as rn from {source} where {where}) where rn = 1)"""


_BY_TS = "ts desc, pos desc"
_COMBINED = _FEED + _pick("comb", "rows", "commit_time, country, username", _BY_TS)


def _fold(where: str = "true") -> str:
    return _COMBINED + _pick("cur", "comb", "country, username", "commit_time desc", where)


_ROW = "username, password, enabled, ts, country, commit_time as _commit_time"
_RECORD = _ROW + ", is_deleted, pos as _src_pos"
_EVENT_FOLD = _FEED + _pick("cur", "rows", "country, username", _BY_TS)

_MOVED = (
    _FEED.replace("\nrows as (", "\nown as (")
    + """,
rows as (
  select * from own
  union all
  select pos, commit_time, username, op, b_password, b_enabled, b_ts, b_country, b_number, true
  from decoded where op = 'u' and country <> b_country)"""
    + _pick("comb", "rows", "commit_time, country, username", _BY_TS)
    + _pick("cur", "comb", "country, username", "commit_time desc")
)

_POSITIONS = """
with f as (
  select event_id, cast(user_id % 4 as int) as feed_partition, cast(floor(epoch(ts)) as bigint) as "timestamp",
    row_number() over (partition by user_id % 4 order by event_id) - 1 as feed_offset
  from events),
bounds as (
  select feed_partition,
    coalesce(min(case when "timestamp" >= 1704844800 then feed_offset end), max(feed_offset) + 1) as lo,
    coalesce(min(case when "timestamp" >= 1705708800 then feed_offset end), max(feed_offset) + 1) as hi
  from f group by feed_partition)
"""

_TWO_TABLES = _FEED + """,
t as (
  select *, case when pos % 89 = 0 then 'audit' when pos % 5 = 0 then 'authorities' else 'users' end as name
  from (select * replace (case when event_type = 'error' then 'd' else 'u' end as op) from b) where pos % 101 <> 0)"""

_SNAPSHOT = _fold() + f" select {_ROW} from cur where not is_deleted"
_AS_OF_MID_MONTH = _fold("commit_time <= '20240115000000000'") + f" select {_ROW} from cur where not is_deleted"

_RETENTION = (
    _COMBINED
    + f""", floor as (select min(c) as c from (select distinct commit_time as c from rows order by 1 desc limit 3)),
      v as (select *, lead(commit_time) over (partition by country, username order by commit_time) as successor
        from comb)
      select {_RECORD} from v, floor
      where (successor is null or successor > floor.c) and not (is_deleted and commit_time <= floor.c)"""
)

ORACLES: dict[str, str] = {
    "feed_scan_bounded": _POSITIONS
    + """ select event_id, feed_partition, feed_offset, "timestamp" from f join bounds using (feed_partition)
          where feed_offset < hi""",
    "feed_replay_window": _POSITIONS
    + """ select event_id, feed_partition, feed_offset, "timestamp" from f join bounds using (feed_partition)
          where feed_offset >= lo and feed_offset < hi""",
    "feed_projection": _POSITIONS + """ select event_id, feed_partition, feed_offset, "timestamp" from f""",
    "feed_sentinels": _POSITIONS
    + """ select '-2 to 0' as arguments, count(*) as rows from f
          union all select '-1 to 0', 0
          union all select '7 to -1', count(*) from f
          union all select '1704844800 to -2', count(*) from f join bounds using (feed_partition) where feed_offset >= lo
          union all select '0 to 1705708800', 0""",
    "feed_offsets_for_time": _POSITIONS + " select feed_partition, lo, hi from bounds",
    "feed_offsets_json": _POSITIONS
    + """, first as (select feed_partition, coalesce(min(case when "timestamp" >= 1704844800 then feed_offset end), -1)
           as o from f group by feed_partition)
         select 'users' as topic,
           '{' || string_agg('"' || feed_partition || '":' || o, ',' order by feed_partition) || '}' as offsets
         from first""",
    "feed_decode": _FEED
    + """ select pos as _src_pos, op, epoch * 1000 as ts_ms,
          case when op not in ('c', 'r') then username end as before_username,
          case when op not in ('c', 'r') then b_password end as before_password,
          case when op not in ('c', 'r') then cast(b_enabled as varchar) end as before_enabled,
          case when op not in ('c', 'r') then cast(b_ts as varchar) end as before_ts,
          case when op not in ('c', 'r') then b_country end as before_country,
          case when op <> 'd' then username end as after_username,
          case when op <> 'd' then password end as after_password,
          case when op <> 'd' then cast(enabled as varchar) end as after_enabled,
          case when op <> 'd' then cast(ts as varchar) end as after_ts,
          case when op <> 'd' then country end as after_country
         from decoded""",
    "feed_malformed": _FEED
    + """ select case when kind <> 'ok' then kind else 'unknown_op' end as reason, count(*) as events
          from l where kind <> 'ok' or op = 't' group by 1""",
    "feed_decode_lenient": _FEED
    + """ select case when kind <> 'ok' then kind when epoch % 7 = 0 then 'malformed' when op = 't' then 'unknown_op'
            else 'ok' end as reason, count(*) as events,
          count(*) filter (where kind = 'ok' and epoch % 7 <> 0) as with_number
          from l group by 1""",
    "feed_two_tables": _TWO_TABLES
    + """ select 'auth.' || name as "table", case when name = 'audit' then 'unknown_table' else 'ok' end as reason, op,
            pos as _src_pos, case when name <> 'audit' then username end as username,
            case when name = 'users' then password end as password,
            case when name = 'authorities' then event_type end as authority
          from t""",
    "feed_two_tables_fold": _TWO_TABLES
    + """, c as (select *, row_number() over (partition by username, event_type order by commit_time desc, epoch desc, pos desc)
             as rn from t where name = 'authorities')
         select username, event_type as authority, epoch as ts, commit_time as _commit_time from c where rn = 1 and op <> 'd'""",
    "feed_schema_inferred": _FEED
    + """, i as (
           select username, password, enabled, ts, country, number from decoded where op <> 'd'
           union all
           select username, b_password, b_enabled, b_ts, b_country, b_number from decoded where op not in ('c', 'r'))
         select unnest(['username', 'password', 'enabled', 'ts', 'country', 'number']) as "column",
           unnest(['string', 'string', 'int', 'bigint', 'string', 'bigint']) as type,
           unnest([count(username), count(password), count(enabled), count(ts), count(country), count(number)]) as images
         from i""",
    "normalize_epoch": """
      with g as (select event_id, cast(floor(epoch(ts)) as bigint) * case when event_type = 'view' then 1000 else 1 end
        as given from events)
      select event_id, given, case when given > 4294967295 then given else given * 1000 end as millis from g""",
    "json_rows_inferred": """
      select o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate,
        o_orderpriority from orders""",
    "route_upserts": _FEED
    + """ select pos as _src_pos, op, username, password, enabled, ts, country from decoded
          where op in ('r', 'c', 'u')""",
    "route_deletes": _FEED
    + """ select pos as _src_pos, op, username, b_password as password, b_enabled as enabled, b_ts as ts,
          b_country as country from decoded where op = 'd'""",
    "route_records": _FEED + f" select {_RECORD} from rows",
    "partition_moves": _FEED
    + """ select pos as _src_pos, username, b_country as from_country, country as to_country from decoded
          where op = 'u' and country <> b_country""",
    "combine_batch": _COMBINED + f" select {_RECORD} from comb",
    "upsert_fold": _fold() + f" select {_RECORD} from cur",
    "upsert_fold_offsets": _fold() + f" select {_RECORD} from cur",
    "upsert_fold_event_time": _EVENT_FOLD + f" select {_ROW} from cur where not is_deleted",
    "upsert_fold_global": _FEED
    + _pick("comb", "rows", "commit_time, username", _BY_TS)
    + _pick("cur", "comb", "username", "commit_time desc")
    + f" select {_ROW} from cur where not is_deleted",
    "changelog_global_moves": _FEED
    + _pick("comb", "rows", "commit_time, username", _BY_TS)
    + _pick("cur", "comb", "username", "commit_time desc")
    + f" select {_ROW} from cur where not is_deleted",
    "upsert_fold_moves": _MOVED + f" select {_ROW} from cur where not is_deleted",
    "delete_apply": _fold() + " select country, username, commit_time as _commit_time from cur where is_deleted",
    "live_view": _EVENT_FOLD + f" select {_ROW} from cur where not is_deleted",
    "stream_upsert_fold": _EVENT_FOLD
    + " select username, password, enabled, ts, country from cur where not is_deleted",
    "schema_evolution": _fold() + f" select {_ROW}, cast(number as varchar) as number from cur where not is_deleted",
    "snapshot": _SNAPSHOT,
    "compact_equivalence": _SNAPSHOT,
    "compact_slices": _SNAPSHOT,
    "joined_files": _SNAPSHOT,
    "catalog_current": _SNAPSHOT,
    "full_range_read": _SNAPSHOT,
    "stream_redelivered": _FEED + f" select {_RECORD} from rows",
    "stream_commits": _COMBINED + f" select {_RECORD} from comb where commit_time > '20240115000000000'",
    "stream_refused": _FEED
    + """ select case when kind <> 'ok' then kind else 'unknown_op' end as reason, count(*) as events,
            count(*) filter (where kind <> 'tombstone') as with_text
          from l where kind <> 'ok' or op = 't' group by 1""",
    "version_changes": _COMBINED
    + _pick("old", "comb", "country, username", "commit_time desc", "commit_time <= '20240115000000000'")
    + _pick("new", "comb", "country, username", "commit_time desc", "commit_time <= '20240125000000000'")
    + """, o as (select * from old where not is_deleted), n as (select * from new where not is_deleted)
         select case when o.pos is null then 'insert' when n.pos is null then 'delete' else 'update' end as change,
           country, username, o.password as before_password, n.password as after_password,
           o.commit_time as before_commit, n.commit_time as after_commit
         from o full join n using (country, username) where o.commit_time is distinct from n.commit_time""",
    "incremental": _SNAPSHOT + " and commit_time > '20240125000000000'",
    "time_travel": _AS_OF_MID_MONTH,
    "time_travel_prefix": _AS_OF_MID_MONTH,
    "table_count": _fold() + " select count(*) as rows from cur where not is_deleted",
    "partition_counts": _fold() + " select country, count(*) as rows from cur where not is_deleted group by country",
    "commit_timeline": _FEED + " select distinct commit_time as _commit_time from rows",
    "meta_columns": _COMBINED
    + f""", k as (select *, md5(username) as digest from comb)
          select {_RECORD}, username as _record_key, 'country=' || country as _partition_path,
            commit_time || '_' || cast(('0x' || digest[1:4])::int as varchar) || '_' || cast(row_number() over (
              partition by commit_time, digest[1:4] order by digest, username, country) - 1 as varchar)
              as _commit_seqno
          from k""",
    "snapshot_meta": _fold()
    + f""" select {_ROW}, username as _record_key, 'country=' || country as _partition_path,
            commit_time || '_' || md5('country=' || country || '/' || username)[1:16] as _commit_seqno
           from cur where not is_deleted""",
    "stream_retention": _RETENTION,
    "retention": _RETENTION,
    "retention_stored": _RETENTION,
    "quickstart_roundtrip": """
      select count(*) as rows, cast(3 as bigint) as commits,
        count(*) filter (where epoch(o_orderdate) >= 852076800 and epoch(o_orderdate) < 883612800) as updated
      from orders""",
    "limit_update": """
      select o_orderkey, o_orderstatus, case when l.k is null then o_totalprice else o_totalprice * 2 end
        as o_totalprice, case when l.k is null then '20240101000000000' else '20240103000000000' end as _commit_time
      from orders left join (select o_orderkey as k from orders order by 1 limit 10) l on o_orderkey = l.k""",
    "rewrite_versions": """
      select 'before' as version, c_custkey, c_acctbal, c_mktsegment, '20240101000000000' as _commit_time from customer
      union all
      select 'after', c_custkey, case when c_acctbal < 0 then 0 else c_acctbal end, c_mktsegment,
        case when c_acctbal < 0 then '20240103000000000' else '20240101000000000' end
      from customer where c_mktsegment <> 'FURNITURE'""",
    "rewrite_retained": """
      with o as (select o_orderkey, o_totalprice, epoch(o_orderdate) as s from orders),
      v as (select *, case when s < 883612800 then '20240101000000000' else '20240102000000000' end as c from o)
      select '20240102000000000' as version, o_orderkey, o_totalprice, c as _commit_time from v
      union all
      select '20240103000000000', o_orderkey, case when s >= 852076800 and s < 883612800 then o_totalprice * 2
        else o_totalprice end, case when s >= 852076800 and s < 883612800 then '20240103000000000' else c end from v""",
    "rewrite_global_moves": _FEED
    + """, batches as (select * exclude (commit_time), '2024010' || (1 + least((cast(commit_time[7:8] as int) - 1) // 10, 2))
             || '000000000' as commit_time from rows)"""
    + _pick("comb", "batches", "commit_time, username", _BY_TS)
    + _pick("cur", "comb", "username", "commit_time desc")
    + f" select {_ROW} from cur where not is_deleted",
    "rewrite_changes": """
      select case when c_mktsegment = 'FURNITURE' then 'delete' else 'update' end as change, c_custkey,
        c_acctbal as before_acctbal, case when c_mktsegment <> 'FURNITURE' then cast(0 as double) end as after_acctbal
      from customer where c_mktsegment = 'FURNITURE' or c_acctbal < 0""",
    "rewrite_incremental": """
      select c_custkey, c_name, cast(0 as double) as c_acctbal, c_mktsegment, '20240103000000000' as _commit_time
      from customer where c_acctbal < 0 and c_mktsegment <> 'FURNITURE'""",
}
