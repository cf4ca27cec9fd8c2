"""DuckDB SQL for the core problems' queries, written without regard to the operators."""

# --- times: every form spelled out by its own pattern, zones asked of the database -----------------------------------

_TIMES = r"""
raw as (
  select 'feed_landing' as table_name, landed_no as row_no, trim(event_time) as v, event_time as original, s.time_zone as zone, s.locale_tag as loc
  from feed_landing f left join feed_sources s using (event_source)
  union all
  select 'object_listing', listing_no, trim(_s3_last_modified), _s3_last_modified, host_time_zone, null from object_listing
), low as (select table_name, row_no, lower(v) as v, zone, loc from raw where original is not null),
split_zone as (
  select *, regexp_replace(v, '\[.*\]$', '') as w from low
), shaped as (
  select *, case
    when regexp_full_match(w, '\d{4}[-/]\d\d[-/]\d\d[t ]+\d\d:\d\d(:\d\d(\.\d{1,9})?)? ?(z|[+-]\d\d(:?\d\d)?|[a-z]{3,4})?') then 'iso'
    when regexp_full_match(w, '\d{8}t\d{6}z') then 'compact'
    when regexp_full_match(w, '\d\d/\d\d/\d{4} \d\d:\d\d:\d\d( [ap]m)?') then 'slash'
    when regexp_full_match(w, '\d\d\.\d\d\.\d{4} \d\d:\d\d:\d\d') then 'dot'
    when regexp_full_match(w, '[a-z]{3}, \d\d [a-z]{3} \d{4} \d\d:\d\d:\d\d gmt') then 'rfc'
    when regexp_full_match(w, '\d{10}|\d{13}|\d{16}|\d{19}') then 'epoch' end as form
  from split_zone
), cut as (
  select *, case
      when form = 'iso' then replace(substr(w, 1, 10), '/', '-')
      when form = 'compact' then substr(w, 1, 4) || '-' || substr(w, 5, 2) || '-' || substr(w, 7, 2)
      when form = 'slash' and loc = 'en-US' then substr(w, 7, 4) || '-' || substr(w, 1, 2) || '-' || substr(w, 4, 2)
      when form in ('slash', 'dot') then substr(w, 7, 4) || '-' || substr(w, 4, 2) || '-' || substr(w, 1, 2)
      when form = 'rfc' then substr(w, 13, 4) || '-' || lpad(cast((position(substr(w, 9, 3) in 'janfebmaraprmayjunjulaugsepoctnovdec') + 2) // 3 as varchar), 2, '0') || '-' || substr(w, 6, 2)
    end as day_text,
    case
      when form = 'iso' then rpad(regexp_extract(w, '\d\d:\d\d(:\d\d)?'), 8, ':00')
      when form = 'compact' then substr(w, 10, 2) || ':' || substr(w, 12, 2) || ':' || substr(w, 14, 2)
      when form in ('slash', 'dot') then substr(w, 12, 8)
      when form = 'rfc' then substr(w, 18, 8)
    end as clock,
    regexp_extract(w, '(am|pm)$') as half,
    case when form = 'iso' then regexp_extract(w, ':\d\d(?::\d\d(?:\.\d+)?)? ?(z|[+-]\d\d(?::?\d\d)?|[a-z]{3,4})$', 1) when form in ('compact', 'rfc') then 'z' else '' end as mark,
    rpad(substr(regexp_extract(w, '\.(\d+)', 1) || '000000', 1, 6), 6, '0') as frac
  from shaped
), made as (
  select *, try_cast(day_text as date) as day,
    case when half = '' then try_cast(substr(clock, 1, 2) as int) when try_cast(substr(clock, 1, 2) as int) between 1 and 12 then try_cast(substr(clock, 1, 2) as int) % 12 + case when half = 'pm' then 12 else 0 end end as hh,
    try_cast(substr(clock, 4, 2) as int) as mi, try_cast(substr(clock, 7, 2) as int) as ss
  from cut
), local_time as (
  select *, case when day is not null and day >= date '0001-01-01' and hh between 0 and 23 and mi between 0 and 59 and ss between 0 and 59
    then epoch_us(cast(day as timestamp)) + (hh * 3600 + mi * 60 + ss) * 1000000::bigint + case when form = 'iso' then cast(frac as bigint) else 0 end end as us,
    case when mark = '' then null
      when mark in ('z', 'utc', 'gmt') then 0 when mark = 'est' then -300 when mark = 'edt' then -240 when mark = 'cst' then -360 when mark = 'cdt' then -300 when mark = 'mst' then -420 when mark = 'mdt' then -360
      when mark = 'pst' then -480 when mark = 'pdt' then -420 when mark = 'cet' then 60 when mark = 'cest' then 120 when mark = 'bst' then 60 when mark = 'ist' then 330 when mark = 'jst' then 540 when mark = 'aest' then 600 when mark = 'aedt' then 660
      else (case when mark[1] = '-' then -1 else 1 end) * (cast(substr(mark, 2, 2) as int) * 60 + coalesce(try_cast(substr(replace(mark, ':', ''), 4, 2) as int), 0)) end as off
  from made
), zoned as (
  select *, case when off is null and us is not null and zone is not null then epoch_us(timezone(zone, make_timestamp(us))) end as guess from local_time
), candidates as (
  select table_name, row_no, guess + shift as u, us, zone from zoned, (values (-7200000000), (-3600000000), (-1800000000), (0), (1800000000), (3600000000), (7200000000)) s(shift) where guess is not null
), real as (
  select table_name, row_no, count(*) as hits, min(u) as u from candidates
  where epoch_us(timezone(zone, to_timestamp(0) + to_microseconds(u))) = us group by 1, 2
), instants as (
  select z.table_name, z.row_no, case
    when form = 'epoch' then case length(w) when 10 then cast(w as bigint) * 1000000 when 13 then cast(w as bigint) * 1000 when 16 then cast(w as bigint) else cast(w as bigint) // 1000 end
    when us is null then null when off is not null then us - off * 60000000::bigint
    when r.hits = 1 then r.u end as micros
  from zoned z left join real r using (table_name, row_no)
)
"""

_FIRST = """
first_copy as (
  select landed_no, _s3_last_modified from (
    select landed_no, _s3_last_modified, row_number() over (partition by event_id is null, case when event_id is null then _source_record_id else lower(event_id) end, case when event_id is not null then event_source end order by landed_no) as n
    from feed_landing) where n = 1
), arrivals as (
  select f.landed_no, micros // 3600000000 * 3600 as hour_s, epoch_us(_s3_last_modified) - (micros // 3600000000 + 1) * 3600000000 as late
  from first_copy f join instants i on i.table_name = 'feed_landing' and i.row_no = f.landed_no where micros is not null
), accepted as (
  select hour_s, case when late <= 900000000 then 0 else greatest(1, cast(ceil((late - 900000000) / 3600000000.0) as bigint)) end as version from arrivals where late <= 172800000000
), totals as (
  select hour_s, version, sum(count(*)) over (partition by hour_s order by version) as messages, count(*) as added, row_number() over (partition by hour_s order by version) as n from accepted group by 1, 2
)
"""

# --- nested records --------------------------------------------------------------------------------------------------

_NAMES = "('lines', 'modifiers', 'components', 'tenders', 'breaks', 'hops')"
_MEMBER = "json_extract(w.node, '$.\"' || k || '\"')"
_HELD = f"""case when json_type({_MEMBER}) = 'ARRAY' then {_MEMBER}
  when json_type({_MEMBER}) = 'VARCHAR' and json_extract_string({_MEMBER}, '$') like '[%' then cast(json_extract_string({_MEMBER}, '$') as json) else json_array({_MEMBER}) end"""
_FORM = f"case when json_type({_MEMBER}) = 'ARRAY' then 'list' when json_type({_MEMBER}) = 'VARCHAR' and json_extract_string({_MEMBER}, '$') like '[%' then 'text' else 'lone' end"
_WALK = f"""
recursive walk as (
  select landed_no, 'payload' as root, 'payload' as path, cast(payload_json as json) as node, cast(null as varchar) as kind, 0 as ordinal, cast(null as varchar) as parent, 'payload' as owner, 'root' as carrier from feed_landing
  union all
  select landed_no, 'envelope', 'envelope', json_merge_patch(cast(envelope_json as json), '{{"data": null, "data_base64": null}}'), null, 0, null, 'envelope', 'root' from feed_landing
  union all
  select landed_no, root, e.path, e.node, e.kind, e.ordinal, e.parent, case when e.kind is null then owner else e.path end, e.carrier from (
    select w.landed_no, w.root, w.owner, unnest(case json_type(w.node)
      when 'OBJECT' then flatten(list_transform(json_keys(w.node), lambda k: case
        when k in {_NAMES} then list_transform(range(cast(json_array_length({_HELD}) as bigint)), lambda i: struct_pack(path := w.path || '.' || k || '[' || i || ']', node := json_extract({_HELD}, '$[' || i || ']'), kind := k, ordinal := i, parent := w.owner, carrier := {_FORM}))
        else [struct_pack(path := w.path || '.' || k, node := {_MEMBER}, kind := cast(null as varchar), ordinal := 0::bigint, parent := w.owner, carrier := ''::varchar)] end))
      when 'ARRAY' then list_transform(range(cast(json_array_length(w.node) as bigint)), lambda i: struct_pack(path := w.path || '[' || i || ']', node := json_extract(w.node, '$[' || i || ']'), kind := cast(null as varchar), ordinal := 0::bigint, parent := w.owner, carrier := ''::varchar))
      end) as e from walk w where json_type(w.node) in ('OBJECT', 'ARRAY')) where json_type(e.node) <> 'NULL'
)
"""

SQL = {
    "p1_found": f"with {_WALK} select landed_no, path as child_path from walk where kind is not null",
    "p1_hops": f"""with {_WALK} select landed_no, path as record_path, parent as parent_path, cast(ordinal as int) as ordinal, 1 as depth, node ->> '$.relay' as relay, try_cast(node ->> '$.lag' as bigint) as lag from walk where kind = 'hops'""",
    "p1_shapes": f"""with {_WALK}, typed as (select *, case json_type(node) when 'VARCHAR' then 'string' when 'ARRAY' then 'string' when 'BOOLEAN' then 'boolean' when 'DOUBLE' then 'decimal(38,19)' when 'OBJECT' then null else 'decimal(38,0)' end as type from walk),
      records as (select landed_no, root, path, coalesce(kind, root) as kind, type from typed where kind is not null or path = root),
      leaves as (select landed_no, root, owner, substr(path, length(owner) + 2) as field, type from typed where kind is null and path <> root and type is not null),
      shapes as (select r.landed_no, r.root, r.path, r.kind, coalesce('value:' || r.type, (select string_agg(field || ':' || l.type, ',' order by field) from leaves l where l.landed_no = r.landed_no and l.root = r.root and l.owner = r.path and not contains(field, '[')), '') as fields from records r)
      select kind, fields, count(*) as records from shapes group by all""",
    "p1_kinds": f"""with {_WALK}, paths as (select landed_no, root, path, kind, parent, carrier from walk where kind is not null),
      deep as (select landed_no, root, path, 1 as depth from paths where parent = root union all select p.landed_no, p.root, p.path, d.depth + 1 from paths p join deep d on p.landed_no = d.landed_no and p.root = d.root and p.parent = d.path)
      select p.root, kind, carrier, cast(depth as int) as depth, count(*) as records from paths p join deep d using (landed_no, root, path) group by all
      union all select 'payload', 'payload', 'root', 0, count(*) from feed_landing where payload_json <> '' having count(*) > 0 union all select 'envelope', 'envelope', 'root', 0, count(*) from feed_landing where envelope_json <> '' having count(*) > 0""",
    "p1_lines": f"""with {_WALK}, deep as (select landed_no, path, 1 as depth from walk where kind is not null and parent in ('payload', 'envelope') union all
      select w.landed_no, w.path, d.depth + 1 from walk w join deep d on w.landed_no = d.landed_no and w.parent = d.path where w.kind is not null)
      select w.landed_no, w.path as record_path, parent as parent_path, cast(ordinal as int) as ordinal, cast(depth as int) as depth, case when json_type(node) = 'OBJECT' then node ->> '$.sku' end as sku,
      case when json_type(node) = 'OBJECT' then try_cast(node ->> '$.qty' as bigint) end as qty, case when json_type(node) = 'OBJECT' then try_cast(node ->> '$.price' as double) end as price from walk w join deep d using (landed_no, path) where kind = 'lines'""",
    "p2_instants": f"with {_TIMES} select table_name, row_no, micros from instants where micros is not null",
    "p2_found": f"with {_TIMES} select table_name, row_no from instants where micros is null",
    "p3_found": """
with named as (select source_system, run_id, substr(started_at, 1, 10) as day, unnest(files) as name from run_manifests where status = 'SUCCESS'),
full_names as (select distinct case when position('/' in name) > 0 then replace(replace(name, 's3a://', 's3://'), '%3D', '=') end as uri, source_system, run_id, day, name from named)
select distinct l.file_uri from landing_files l
where l.size_bytes < 8388608 and (l.file_uri in (select uri from full_names where uri is not null)
  or exists (select 1 from full_names n where n.uri is null and regexp_full_match(l.file_uri, 's3://brindle-lake-landing/landing/' || n.source_system || '/[^/]+/ingest_date=' || n.day || '/run_id=' || n.run_id || '/' || n.name) and n.run_id = l.run_id))
""",
    "p4_found": """
with runs as (select distinct source_system, source, run_id, completed_at, schema from run_manifests where status = 'SUCCESS' and schema is not null and len(schema) > 0),
numbered as (select *, row_number() over (partition by source_system, source order by completed_at, run_id) as n from runs),
raw as (select source_system, source, n, run_id, unnest(schema) as c from numbered),
typed as (select source_system, source, n, run_id, lower(c.name) as name, replace(lower(c.type), ' ', '') as t from raw),
cols as (select source_system, source, n, run_id, name, case when t like 'decimal%' then regexp_replace(t, '^decimal(128)?', 'decimal') when t like 'timestamp%' then 'timestamp' when t in ('int64', 'bigint') then 'bigint' when t in ('int32', 'int') then 'int'
  when t in ('bool', 'boolean') then 'boolean' when t in ('double', 'float') then t when t in ('date32[day]', 'date') then 'date' else 'string' end as type from typed),
pairs as (select a.source_system, a.source, a.n, a.run_id, b.n as m from numbered a join numbered b on a.source_system = b.source_system and a.source = b.source and b.n = a.n - 1),
now as (select p.run_id, c.name, c.type from pairs p join cols c on c.source_system = p.source_system and c.source = p.source and c.n = p.n),
old as (select p.run_id, c.name, c.type from pairs p join cols c on c.source_system = p.source_system and c.source = p.source and c.n = p.m)
select run_id, name as column_name from now full join old using (run_id, name) where now.type is distinct from old.type
""",
    "p5_found": f"with {_TIMES}, {_FIRST} select landed_no from arrivals where late > 900000000 and late <= 172800000000",
    "p5_totals": f"with {_TIMES}, {_FIRST} select hour_s, count(*) as messages from accepted group by 1",
    "p5_changes": f"""with {_TIMES}, {_FIRST}
select hour_s, version, cast(1 as bigint) as sign, cast(messages as bigint) as messages from totals
union all select hour_s, version, cast(-1 as bigint), cast(messages - added as bigint) from totals where version > 0""",
    "p6_found": """
select landed_no from (select landed_no, row_number() over (partition by event_id is null, case when event_id is null then _source_record_id else lower(event_id) end, case when event_id is not null then event_source end order by landed_no) as n from feed_landing) where n > 1
""",
    "p6_once": """
select landed_no, event_source, event_type, _s3_etag, business_date from (select *, row_number() over (partition by event_id is null, case when event_id is null then _source_record_id else lower(event_id) end, case when event_id is not null then event_source end order by landed_no) as n from feed_landing) where n = 1
""",
}

SQL["p3_plan"] = f"""
with found as ({SQL["p3_found"]}), once as (select distinct l.file_uri, size_bytes, row_count from landing_files l join found using (file_uri))
select split_part(file_uri, '/', 5) as source_system, split_part(file_uri, '/', 6) as table_name, count(*) as files, cast(sum(size_bytes) as bigint) as bytes, cast(sum(row_count) as bigint) as rows from once group by 1, 2
"""
SQL["p4_changes"] = SQL["p4_found"].replace("pairs as (select a.source_system, a.source, a.n, a.run_id, b.n as m", "pairs as (select a.source_system, a.source, a.n, a.run_id, b.n as m, b.run_id as previous_run_id").replace(
    "select run_id, name as column_name from now full join old using (run_id, name) where",
    "select p.source_system, run_id, p.previous_run_id, name as column_name, case when old.type is null then 'added' when now.type is null then 'removed' else 'retyped' end as change, old.type as old_type, now.type as new_type"
    " from now full join old using (run_id, name) join pairs p using (run_id) where",
)
_EXACT = lambda t: f"""case when {t} = 'string' then v when {t} in ('bigint', 'int') then case when regexp_full_match(v, '[+-]?\\d+') then cast(case when {t} = 'int' then cast(try_cast(v as int) as bigint) else try_cast(v as bigint) end as varchar) end
  when {t} = 'decimal(12,2)' then case when regexp_full_match(v, '[+-]?\\d+(\\.\\d{{0,2}}0*)?') then cast(try_cast(v as decimal(12, 2)) as varchar) end when {t} = 'decimal(38,3)' then case when regexp_full_match(v, '[+-]?\\d+(\\.\\d{{0,3}}0*)?') then cast(try_cast(v as decimal(38, 3)) as varchar) end
  when {t} = 'decimal(38,0)' then case when regexp_full_match(v, '[+-]?\\d+(\\.0*)?') then cast(try_cast(v as decimal(38, 0)) as varchar) end when {t} in ('double', 'float') then case when regexp_full_match(v, '[+-]?\\d+(\\.\\d*)?') then v end when {t} = 'boolean' then case when lower(v) in ('true', 'false') then lower(v) end when {t} = 'date' then case when regexp_full_match(v, '\\d{{4}}-\\d\\d-\\d\\d') and try_cast(v as date) is not null then v end
  when {t} = 'timestamp' then case when regexp_full_match(v, '\\d{{4}}-\\d\\d-\\d\\d([T ]\\d\\d:\\d\\d(:\\d\\d(\\.\\d{{1,6}})?)?)?') and try_cast(v as timestamp) is not null then v end end"""  # noqa: E731
_INGESTED = SQL["p4_found"][: SQL["p4_found"].index(",\nnow as")] + f""",
meets as (select c.source_system, c.source, c.run_id, coalesce(p.m, c.n) as first_n, max(c.n) over (partition by c.source_system, c.source) as last_n from numbered c left join pairs p on p.source_system = c.source_system and p.source = c.source and p.n = c.n),
fields as (select run_id, row_no, k, lower(k) as column_name, json_extract_string(record_json, '$."' || k || '"') as v from (select *, unnest(json_keys(record_json)) as k from landed_samples)),
typed_fields as (select f.run_id, row_no, m.source_system, f.column_name, v, a.type as arrival_type, z.type as catalog_type from fields f left join meets m using (run_id)
  left join cols a on a.source_system = m.source_system and a.source = m.source and a.n = m.first_n and a.name = f.column_name left join cols z on z.source_system = m.source_system and z.source = m.source and z.n = m.last_n and z.name = f.column_name where v is not null),
ingested as (select *, {_EXACT("arrival_type")} as was, {_EXACT("catalog_type")} as value from typed_fields),
judged as (select *, case when value is not null and was is not null then 'typed' when value is not null then 'replayed' when catalog_type is null then 'unknown' else 'uncastable' end as outcome from ingested)
"""
SQL["p4_rescued"] = f"{_INGESTED} select source_system, column_name, arrival_type, catalog_type, outcome, count(*) as fields from judged group by all"
SQL["p4_table"] = f"{_INGESTED} select run_id, row_no, column_name, catalog_type, outcome, value, value is null as is_rescued from judged"
SQL["p3_joined"] = f"""
with found as ({SQL["p3_found"]}), files as (select distinct l.file_uri, first_landed_no as a, last_landed_no as z from landing_files l join found using (file_uri) where first_landed_no is not null)
select landed_no, sha256(payload_json) as checksum from feed_landing f join files on landed_no between a and z
"""
SQL["p4_envelopes"] = r"""
with e as (select landed_no, envelope_json as j, envelope_json ->> '$.type' as type, trim(envelope_json ->> '$.time') as t, envelope_json ->> '$.businessdate' as b, envelope_json ->> '$.specversion' as s from feed_landing where envelope_json is not null),
held as (select *, case when regexp_full_match(t, '\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d{1,6}0*)?)?)?') then try_cast(t as timestamp) end as ts, case when regexp_full_match(b, '\d{4}-\d\d-\d\d') then try_cast(b as date) end as bd, case when regexp_full_match(s, '\d(\.\d0*)?') then cast(s as decimal(2, 1)) end as sv from e)
select landed_no, type, case when ts is not null then regexp_replace(regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '\.$', '') end as time, cast(bd as varchar) as businessdate, cast(sv as varchar) as specversion,
  (select string_agg(k, ',' order by k) from (select unnest(json_keys(j)) as k) where json_extract_string(j, '$."' || k || '"') is not null and not (k = 'type' or (k = 'time' and ts is not null) or (k = 'businessdate' and bd is not null) or (k = 'specversion' and sv is not null))) as left_over from held
"""
SQL["p5_streamed"] = SQL["p5_totals"]
