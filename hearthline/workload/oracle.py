"""The registered queries in DuckDB SQL, written independently of the Spark operators."""

from __future__ import annotations

from hearthline.workload.device_events import duckdb_device_events

AT = "2024-02-02T00:00:00Z"
ID = '"DeviceId", "TimestampUTC", "DeviceType", "Status"'


def _sorted_tokens(text: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split_regex({text}, '\\s+'), lambda t: t <> '')), ' ')"


def _key(text: str, fold: bool = True) -> str:
    return _sorted_tokens(f"regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}_]', ' ', 'g')" if fold else text)


def _lcs(pairs: str, out: str) -> str:
    """CTEs giving `out`(a, b, score) for the distinct text pairs (a, b) of a query: one row of the
    classic table per character of a."""
    return f"""
{out}_steps(a, b, i, line) as (
  select a, b, 0, list_transform(range(length(b) + 1), lambda x: 0) from (select distinct a, b from ({pairs}))
  union all
  select a, b, i + 1,
    list_transform(range(1, length(b) + 2), lambda k: case when k = 1 then 0 else list_max(list_transform(range(2, k + 1),
      lambda j: greatest(line[j], line[j - 1] + case when substr(a, i + 1, 1) = substr(b, j - 1, 1) then 1 else 0 end)))
      end)
  from {out}_steps where i < length(a)
),
{out} as (
  select a, b, case when a = b then 100.0::double when length(a) = 0 or length(b) = 0 then 0.0::double
    else 200.0::double * line[length(b) + 1] / (length(a) + length(b)) end as score
  from {out}_steps where i = length(a)
)"""


DEV = f"dev as ({duckdb_device_events()})"

VALID = f"""{DEV},
judged as (
  select *, case when coalesce(trim("DeviceId"), '') = '' or coalesce(trim("TimestampUTC"), '') = ''
      or coalesce(trim("DeviceType"), '') = '' or coalesce(trim("Status"), '') = '' then 'missing_required_field'
    when canon is null then 'unparseable_timestamp' end as reason
  from (select *, strftime(try_strptime(regexp_replace("TimestampUTC", 'Z$', ''), '%Y-%m-%dT%H:%M:%S'),
    '%Y-%m-%dT%H:%M:%SZ') as canon from dev)
),
valid as (select * replace (canon as "TimestampUTC") from judged where reason is null),
exact as (select * from valid qualify row_number() over (partition by {ID} order by _pos) = 1)"""


def _survivors(name: str, block: str, fold: bool = True) -> str:
    """CTEs giving the events without an earlier similar one in their block."""
    return f"""
{name}_keyed as (select *, {_key('"Status"', fold)} as k from exact),
{_lcs(f"select x.k as a, y.k as b from (select distinct k from {name}_keyed) x, (select distinct k from {name}_keyed) y",
      f"{name}_score")},
{name}_firsts as (select {block}, k, min(_pos) as first_pos from {name}_keyed group by all),
{name}_lost as (
  select distinct r.* from {name}_keyed r join {name}_firsts e using ({block})
  join {name}_score s on s.a = e.k and s.b = r.k
  where e.first_pos < r._pos and s.score >= 90
),
{name} as (select * from {name}_keyed where _pos not in (select _pos from {name}_lost))"""


BLOCK = '"DeviceId", "DeviceType", "TimestampUTC"'
SILVER = f"{VALID}, {_survivors('silver', BLOCK)}"


def _dev(select: str) -> str:
    return f"with {DEV} {select}"


def _valid(select: str) -> str:
    return f"with {VALID} {select}"


def _silver(select: str) -> str:
    return f"with recursive {SILVER} {select}"


def _celsius(round_all: bool) -> str:
    t = "try_cast(\"Attributes\"->>'$.Temperature' as double)"
    other = f"round({t}, 2)" if round_all else t
    return f"""case when lower("Attributes"->>'$.Temperature_Unit') in ('f', 'fahrenheit')
      then round(({t} - 32.0) * 5.0 / 9.0, 2) else {other} end"""


FAILURES = """left join lateral (select unnest(json_extract_string("Attributes", '$.FailureIds[*]')) as f) on true"""
FAILURE_ID = 'try_cast(f as integer) as "FailureId"'
AUDIT = f"""_ingested_at, '{AT}' as _silver_processed_at, _source_file"""

WASHING = f"""select {ID}, {_celsius(False)} as "Temperature_C",
  case when "Attributes"->>'$.Temperature' is not null then 'Celsius' end as "Temperature_Unit",
  try_cast("Attributes"->>'$.SpinningSpeed' as integer) as "SpinningSpeed",
  "Attributes"->>'$.SpinningSpeed_Unit' as "SpinningSpeed_Unit",
  try_cast("Attributes"->>'$.TwinDos[0]' as integer) as "TwinDos_Colour",
  try_cast("Attributes"->>'$.TwinDos[1]' as integer) as "TwinDos_White",
  "Attributes"->>'$.TwinDos_Unit' as "TwinDos_Unit", {FAILURE_ID}, {AUDIT}
from silver {FAILURES} where lower("DeviceType") like '%washing%'"""

DISHWASHER = f"""select {ID}, {_celsius(True)} as "Temperature_C",
  try_cast("Attributes"->>'$.QuickPowerWashActive' as integer) <> 0 as "QuickPowerWashActive", {FAILURE_ID}, {AUDIT}
from silver {FAILURES} where lower("DeviceType") like '%dishwasher%'"""

IS_KNOWN = """(lower("DeviceType") like '%washing%' or lower("DeviceType") like '%coffee%'
 or lower("DeviceType") like '%dishwasher%')"""

COFFEE_LONG = f"""select {ID}, trim(e->>'$.Id') as "Id", try_cast(e->>'$.Value' as double) as "Value", e->>'$.Unit' as "Unit"
from (select * from silver where lower("DeviceType") like '%coffee%')
left join lateral (select e from (select unnest(json_extract("Attributes", '$[*]')) as e) where json_type(e) = 'OBJECT') on true"""


def _coffee_pair(attribute_id: str, stem: str) -> str:
    entry = f"list_filter(json_extract(\"Attributes\", '$[*]'), lambda e: trim(e->>'$.Id') = '{attribute_id}')[1]"
    return f"""try_cast({entry}->>'$.Value' as double) as "{stem}_Value", {entry}->>'$.Unit' as "{stem}_Unit\""""


COFFEE_WIDE = f"""select {ID}, {_coffee_pair('Cup-Size', 'Cup_Size')}, {_coffee_pair('Grinding', 'Grinding')},
  {_coffee_pair('Temperature', 'Temperature')}, {AUDIT} from silver where lower("DeviceType") like '%coffee%'"""


def _summary(days: str) -> str:
    return f"""select "DeviceId", "DeviceType", total_events, failure_events, first_seen_utc, last_seen_utc,
  round(failure_events / total_events * 100.0, 2) as failure_rate_pct, cast({days} as integer) as days_active
from (select "DeviceId", "DeviceType", count(*) as total_events,
    cast(sum(case when lower("Status") like '%failure%' then 1 else 0 end) as bigint) as failure_events,
    min(strptime("TimestampUTC", '%Y-%m-%dT%H:%M:%SZ')) as first_seen_utc,
    max(strptime("TimestampUTC", '%Y-%m-%dT%H:%M:%SZ')) as last_seen_utc
  from silver group by 1, 2)"""


SUMMARY = _summary("date_diff('day', first_seen_utc, last_seen_utc)")

STAGES = """select 'bronze' as stage, count(*) as rows from judged
union all select 'missing', count(*) from judged where reason = 'missing_required_field'
union all select 'bad_time', count(*) from judged where reason = 'unparseable_timestamp'
union all select 'valid', count(*) from valid
union all select 'exact', count(*) from exact
union all select 'silver', count(*) from silver"""

METRICS = """select rows_in, rows_out, rows_in - n_valid as dropped_invalid, n_valid - n_exact as dropped_duplicate,
  n_exact - rows_out as dropped_fuzzy, (rows_in - n_valid) / rows_in * 100.0 as invalid_pct,
  (n_valid - rows_out) / rows_in * 100.0 as post_dedup_pct
from (select (select count(*) from judged) as rows_in, (select count(*) from silver) as rows_out,
  (select count(*) from valid) as n_valid, (select count(*) from exact) as n_exact)"""


def _alert(name: str, limit: str, text: str) -> str:
    return f"""select '{name}' as "check", {name} as value, {limit}::double as threshold, {name} > {limit} as breached,
  case when {name} > {limit} then printf('{text} %.1f%% exceeds threshold %.1f%%', {name}, {limit}::double) end as message
from ({METRICS})"""


def _leaves(attributes: str) -> str:
    return f"""{attributes}->>'$.Temperature' as temperature, {attributes}->>'$.FailureIds[0]' as first_failure,
  {attributes}->>'$[0].Id' as first_id"""


def _rebuilt(kind: str, extra: str) -> str:
    """Identity and attribute leaves of messages, or the bare value that stands in their place."""
    identity = ", ".join(f'case when {kind} then {c} end as {c}' for c in ID.split(", "))
    return f"""{identity}, {extra}, {_leaves('(case when ' + kind + ' then "Attributes" end)')}"""


RECORDS = f"""select {_rebuilt('event_id % 103 <> 0 and event_id % 107 <> 0', '_pos, _ingested_at')},
  case when event_id % 103 = 0 then concat('', event_id) end as bare_value
from dev where event_id % 101 <> 0"""

NUMBERED = """(select *, concat('batch-', _batch_id) as file,
  row_number() over (partition by _batch_id order by _pos) - 1 as place from dev)"""
PLAIN = "event_id % 103 <> 0 and event_id % 107 <> 0 and event_id % 109 <> 0"
ELEMENTS = f"""select {_rebuilt(PLAIN, 'file as _source_file, place as _pos')},
  case when event_id % 103 = 0 then concat('', event_id) when event_id % 107 = 0 then null
    when event_id % 109 = 0 then '"{{text}}"' end as bare_value
from {NUMBERED} where _batch_id % 10 not in (4, 9)"""

# The texts as written, without the blanks between values.
ARRAY_TEXT = f"""select file as _source_file, place as _pos,
  case when event_id % 103 = 0 then concat('', event_id) when event_id % 107 = 0 then null
    when event_id % 109 = 0 then '"{{text}}"'
    else replace(replace("Attributes", ': ', ':'), ', ', ',') end as "Attributes"
from {NUMBERED} where _batch_id % 10 not in (4, 9)"""

BAD_FILES = """select concat('batch-', _batch_id) as _source_file,
  case _batch_id % 10 when 4 then 'the file holds no JSON array at its root' else 'file is not valid JSON' end as error
from (select distinct _batch_id from dev) where _batch_id % 10 in (4, 9)"""

TIMES = """select event_id, raw, lenient, case when event_id % 10 in (0, 1) then lenient end as strict from (
  select event_id,
    case event_id % 10 when 0 then concat(d, 'T', s) when 1 then concat(d, 'T', s, 'Z') when 2 then concat(d, 'T', s, '+02:00')
      when 3 then concat(d, 'T', s, '-0530') when 4 then concat(d, 'T', s, '.75Z') when 5 then concat(d, 'T', m, 'Z')
      when 6 then concat(d, ' ', s) when 7 then d when 8 then concat('2024-02-30T', s) else '2024' end as raw,
    strftime(case when event_id % 10 in (8, 9) then null
      when event_id % 10 = 2 then ts - interval 2 hour
      when event_id % 10 = 3 then ts + interval 330 minute
      when event_id % 10 = 5 then date_trunc('minute', ts)
      when event_id % 10 = 7 then date_trunc('day', ts) else ts end, '%Y-%m-%dT%H:%M:%SZ') as lenient
  from (select event_id, ts, strftime(ts, '%Y-%m-%d') as d, strftime(ts, '%H:%M:%S') as s, strftime(ts, '%H:%M') as m
    from events))"""


def _pairs(block: str, timed: bool) -> str:
    """Similar keys of a block between their first spellings, and later spellings with the first."""
    return f"""with recursive {VALID},
keyed as (select *, {_key('"Status"')} as k from exact),
texts as (select * from keyed qualify row_number() over (partition by {block}, "Status" order by _pos) = 1),
firsts as (select * from texts qualify row_number() over (partition by {block}, k order by _pos) = 1),
{_lcs('select x.k as a, y.k as b from (select distinct k from keyed) x, (select distinct k from keyed) y', 'score')},
found as (
  select x.*, y."TimestampUTC" as rt, y."Status" as rs, score from firsts x join firsts y using ({block})
  join score on a = x.k and b = y.k where x._pos < y._pos and score >= 90
  union all
  select x.*, y."TimestampUTC" as rt, y."Status" as rs, 100.0 from firsts x join texts y using ({block}, k)
  where x._pos < y._pos
)
select "DeviceId", "DeviceType", "TimestampUTC" as left_timestamp, "Status" as left_status, rt as right_timestamp,
  rs as right_status, 1 as "DeviceId_exact", 1 as "DeviceType_exact",
  cast("TimestampUTC" = rt as integer) as timestamp_exact, round(score, 6) as status_fuzzy from found"""


PART_NAMES = f"""with recursive named as (
  select p.p_partkey, p.p_name as x, upper(n.p_name) as y from part p join part n on n.p_partkey = p.p_partkey + 1),
keyed as (select p_partkey, {_key('x')} as fx, {_key('y')} as fy, {_key('x', False)} as rx, {_key('y', False)} as ry from named),
{_lcs('select fx as a, fy as b from keyed union all select rx, ry from keyed', 'score')}
select p_partkey, round(f.score, 6) as score, round(r.score, 6) as raw_score
from keyed join score f on f.a = fx and f.b = fy join score r on r.a = rx and r.b = ry"""

STATUS_SCORES = f"""with recursive {VALID},
labels(name, label) as (values ('to_start', 'Program Start'), ('to_end', 'Program End'), ('to_failure', 'Program Failure')),
counted as (select "Status", count(*) as events from valid group by 1),
keyed as (select *, {_key('"Status"')} as x, {_key('label')} as y from counted, labels),
{_lcs('select x as a, y as b from keyed', 'score')}
select "Status", events, round(max(case when name = 'to_start' then score end), 6) as to_start,
  round(max(case when name = 'to_end' then score end), 6) as to_end,
  round(max(case when name = 'to_failure' then score end), 6) as to_failure
from keyed join score on a = x and b = y group by 1, 2"""

UPSERT = f"""with {VALID},
source as (select * from valid where _batch_id % 2 = 0
  qualify row_number() over (partition by {ID} order by _pos) = 1),
updates as (select * from valid where _batch_id % 2 = 1 or _batch_id % 10 = 0
  qualify row_number() over (partition by {ID} order by _pos) = 1)
select {ID}, _ingested_at, _pos from source s
where not exists (select 1 from updates u where u."DeviceId" = s."DeviceId" and u."TimestampUTC" = s."TimestampUTC"
  and u."DeviceType" = s."DeviceType" and u."Status" = s."Status")
union all select {ID}, '2024-02-03T00:00:00Z', _pos from updates"""

ROUTING = f"""select 'silver' as "table", count(*) as rows from silver
union all select 'gold_washing_machine', count(*) from ({WASHING})
union all select 'gold_coffee_machine', count(*) from silver where lower("DeviceType") like '%coffee%'
union all select 'gold_dishwasher', count(*) from ({DISHWASHER})
union all select 'gold_unknown_devices', count(*) from silver where not {IS_KNOWN}
union all select 'unknown_types', count(*) from silver where not {IS_KNOWN}
union all select 'unrouted', count(*) from (select {ID} from silver except (
  select {ID} from ({WASHING}) union all select {ID} from ({DISHWASHER})
  union all select {ID} from silver where lower("DeviceType") like '%coffee%' or not {IS_KNOWN}))"""

RULES = f"""with recursive {SILVER}, w as ({WASHING})
select 'canonical_time' as rule, count("TimestampUTC") as checked,
  count(*) filter (not regexp_full_match("TimestampUTC", '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}Z')) as violations
from w
union all select 'temperature_range', count("Temperature_C"), count(*) filter (not ("Temperature_C" between 0 and 100)) from w
union all select 'no_blank_status', count("Status"), count(*) filter (trim("Status") = '') from w
union all select 'known_speed', count("SpinningSpeed"),
  count(*) filter ("SpinningSpeed" not between 650 and 1350) from w"""

REPLAY = """select _batch_id, batch_rows, cast(sum(batch_rows) over (order by _batch_id) as bigint) as cumulative_rows
from (select _batch_id, count(*) as batch_rows from dev group by 1)"""

#: Part names as statuses of three devices: every row against every earlier one of its device.
CROWDED = f"""with recursive named as (
  select concat('dev_', p_partkey % 3) as "DeviceId", p_partkey as _pos,
    concat(case when p_type = 'PROMO' and p_size % 2 = 0 then lower(p_type) else p_type end, ' ', p_brand) as "Status" from part),
keyed as (
  select *, true as fold, {_key('"Status"')} as k from named union all select *, false, {_key('"Status"', False)} from named),
{_lcs('select x.k as a, y.k as b from (select distinct k, fold from keyed) x join (select distinct k, fold from keyed) y on x.fold = y.fold', 'score')},
firsts as (select "DeviceId", fold, k, min(_pos) as first_pos from keyed group by all),
best as (
  select r._pos, r.fold, max(s.score) as score from keyed r join firsts e on e."DeviceId" = r."DeviceId" and e.fold = r.fold
  join score s on s.a = e.k and s.b = r.k where e.first_pos < r._pos group by 1, 2)
select cast(t.threshold as integer) as threshold, r.fold, r."DeviceId", r."Status", r._pos
from keyed r left join best b on b._pos = r._pos and b.fold = r.fold, (values (60), (90), (97)) as t(threshold)
where coalesce(b.score, 0) < t.threshold"""

#: By place modulo 6: cut off, a list, a number, nothing, values that are no numbers, as it was.
MALFORMED = f"""with {VALID},
shaped as (
  select *, case when _pos % 6 = 4 then '{{"Temperature": "warm", "SpinningSpeed": "900.0", "TwinDos": [5], "FailureIds": [1, "x", null]}}'
    when _pos % 6 = 5 then "Attributes" end as a from valid where lower("DeviceType") like '%washing%')
select {ID}, {_celsius(False).replace('"Attributes"', 'a')} as "Temperature_C",
  cast(trunc(try_cast(a->>'$.SpinningSpeed' as double)) as integer) as "SpinningSpeed",
  try_cast(a->>'$.TwinDos[0]' as integer) as "TwinDos_Colour", try_cast(a->>'$.TwinDos[1]' as integer) as "TwinDos_White", {FAILURE_ID}
from shaped {FAILURES.replace('"Attributes"', 'a')}"""


def _clash(counts: str) -> str:
    """Of the repeated Temperature the first or the last entry; `Cup Size` comes before `Cup-Size`."""
    entry = "list_filter(json_extract(\"Attributes\", '$[*]'), lambda e: trim(e->>'$.Id') = '{}')[1]"
    grinding = entry.format("Grinding")
    temperature = f"try_cast({entry.format('Temperature')}->>'$.Value' as double)" if counts == "first" else "1.0::double"
    unit = f"{entry.format('Temperature')}->>'$.Unit'" if counts == "first" else "'K'"
    return f"""select {ID}, cast(_pos % 5 as double) as "Cup_Size_Value", 'cl' as "Cup_Size_Unit",
  try_cast({grinding}->>'$.Value' as double) as "Grinding_Value", {grinding}->>'$.Unit' as "Grinding_Unit",
  {temperature} as "Temperature_Value", {unit} as "Temperature_Unit", '{counts}' as counts
from valid where lower("DeviceType") like '%coffee%'"""


BY_BATCH = """select _batch_id, count(*) as bronze_rows, count(*) filter (reason = 'missing_required_field') as missing_rows,
  count(*) filter (reason = 'unparseable_timestamp') as bad_time_rows, count(*) filter (reason is null) as valid_rows,
  count(*) filter (_pos in (select _pos from exact)) as exact_rows, count(*) filter (_pos in (select _pos from silver)) as silver_rows
from judged group by 1"""

#: The summary of the silver events up to each batch in which the device has events.
SUMMARY_BY_BATCH = f"""select * from (select distinct "DeviceId" as d, "DeviceType" as t, _batch_id from silver) b,
lateral ({SUMMARY.replace('from silver', 'from silver s where s."DeviceId" = b.d and s."DeviceType" = b.t and s._batch_id <= b._batch_id')})"""

LIFECYCLE = """select 'created' as step, 0 as rows union all select 'filled True', count(*) from silver union all select 'refreshed False', 0
union all select 'empty silver', 0 union all select 'empty gold_washing_machine', 0 union all select 'empty gold_coffee_machine', 0
union all select 'empty gold_dishwasher', 0 union all select 'empty gold_unknown_devices', 0 union all select 'empty gold_summary', 0"""

PREVIEWS = """with batches as (
  select _batch_id from (select _batch_id, row_number() over (order by _batch_id) - 1 as i from (select distinct _batch_id from dev)) where i % 3 = 0),
counted as (
  select b._batch_id, count(*) filter ("DeviceId" like 'syn\\_%' escape '\\') as p, count(*) as n
  from batches b join dev d on d._batch_id <= b._batch_id group by 1)
select _batch_id, 'plain' as preview, least(500, n - p) as rows, 0 as prefixed_rows from counted
union all select _batch_id, 'prefixed', least(500, p), least(500, p) from counted"""

END_TO_END = f"""select 'bronze' as "table", count(*) as rows from dev
union all select "table", rows from ({ROUTING}) where "table" not in ('unrouted', 'unknown_types')
union all select 'gold_summary', count(*) from ({SUMMARY})
union all select 'unknown_types', count(distinct "DeviceType") from silver where not {IS_KNOWN}
union all select 'alerts', cast(invalid_pct > 5 as integer) + cast(post_dedup_pct > 20 as integer) from ({METRICS})"""

REGISTERED = """with failing as (select distinct "DeviceId", "DeviceType" from silver where lower("Status") like '%failure%')
select s."DeviceType", count(*) as rows, count(f."DeviceId") as rows_of_failing
from silver s left join failing f on f."DeviceId" = s."DeviceId" and f."DeviceType" = s."DeviceType" group by 1"""

LOG = f"""select * exclude (message), '2024-02-02T00:00:00Z' as _run_at from ({_alert("invalid_pct", "1.0", "x")} union all {_alert("post_dedup_pct", "20.0", "x")})
union all select * exclude (message), '2024-02-03T00:00:00Z' from ({_alert("invalid_pct", "99.0", "x")} union all {_alert("post_dedup_pct", "20.0", "x")})
union all select 'stopped', null, null, invalid_pct > 1.0, '2024-02-02T00:00:00Z' from ({METRICS})
union all select 'stopped', null, null, invalid_pct > 99.0, '2024-02-03T00:00:00Z' from ({METRICS})"""

#: Rows that the two filters find; the files are free, but for their number.
ZORDER = """select 'device' as filter, count(*) as rows, true as skips from silver where "DeviceId" = (select min("DeviceId") from silver)
union all select 'time', count(*), true from silver where "TimestampUTC" < '2024-01-03'
union all select 'both', count(*), true from silver where "DeviceId" = (select min("DeviceId") from silver) and "TimestampUTC" < '2024-01-03'"""

#: The keys that events of either part have, and what is to be found under them; the later events' units are objects.
DRIFT = f"""with {DEV},
keys as (select distinct * from (
  select case when "DeviceType" = 'Dishwasher' then 'dishwasher' else 'washing' end as family, event_id % 5 = 0 as known,
    unnest(json_keys("Attributes")) as key
  from dev where "DeviceType" in ('Washing machine', 'Dishwasher') and "Attributes" not like '%FailureIds%')),
shapes(key, path, known_type, found_type) as (values
  ('Temperature', '$.Temperature', 'BIGINT', 'BIGINT'), ('Temperature_Unit', '$.Temperature_Unit', 'STRING', 'OBJECT'),
  ('Temperature_Unit', '$.Temperature_Unit.name', null, 'STRING'), ('Temperature_Unit', '$.Temperature_Unit.scale', null, 'ARRAY'),
  ('Temperature_Unit', '$.Temperature_Unit.scale[*]', null, 'BIGINT'), ('SpinningSpeed', '$.SpinningSpeed', 'BIGINT', 'BIGINT'),
  ('SpinningSpeed_Unit', '$.SpinningSpeed_Unit', 'STRING', 'STRING'), ('TwinDos', '$.TwinDos', 'ARRAY', 'ARRAY'),
  ('TwinDos', '$.TwinDos[*]', 'BIGINT', 'BIGINT'), ('TwinDos_Unit', '$.TwinDos_Unit', 'STRING', 'STRING'),
  ('QuickPowerWashActive', '$.QuickPowerWashActive', 'BIGINT', 'BIGINT'))
select f.family, s.path, case when k.key is not null then s.known_type end as old_type, s.found_type as new_type
from keys f join shapes s on s.key = f.key left join keys k on k.known and k.family = f.family and k.key = f.key
where not f.known and coalesce(case when k.key is not null then s.known_type end, '') <> s.found_type"""

BRONZE_COLUMNS = f'{ID}, "Attributes", _ingested_at, _source_file, _pos'

ORACLE: dict[str, str] = {
    "device_summary": _silver(SUMMARY),
    "device_summary_elapsed": _silver(_summary("date_sub('day', first_seen_utc, last_seen_utc)")),
    "summary_join_form": _silver(SUMMARY),
    "devices_with_failures": _silver(f"select * from ({SUMMARY}) where failure_events > 0"),
    "bronze_records": _dev(RECORDS),
    "bronze_dead_letter": _dev(
        "select 'record is not valid JSON' as error, record as raw, _ingested_at from dev where event_id % 101 = 0"
    ),
    "bronze_array_elements": _dev(ELEMENTS),
    "bronze_array_text": _dev(ARRAY_TEXT),
    "bronze_lines": _dev('select "DeviceId", count(*) as rows, count(*) as positions from dev group by 1'),
    "bronze_bad_files": _dev(BAD_FILES),
    "validate_split": _valid(f"select {ID}, _pos, reason as _rejection_reason from judged"),
    "dead_letter": _valid(
        f"select {BRONZE_COLUMNS}, '{AT}' as _silver_processed_at, reason as _rejection_reason from judged "
        "where reason is not null"
    ),
    "missing_column": _dev(
        'select "DeviceId", cast(null as varchar) as "Status", _pos, '
        "'missing_required_field' as _rejection_reason from dev"
    ),
    "normalize_timestamps": TIMES,
    "normalize_device_type": _valid(
        """select case "DeviceType" when 'Washing machine' then 'Washing Machine' else "DeviceType" end as "DeviceType",
 count(*) as rows from valid group by 1"""
    ),
    "exact_dedup": _valid(f'select {ID}, "Attributes", _pos from exact'),
    "duplicate_keys": _valid(f"select {ID}, count(*) as copies from valid group by all having count(*) > 1"),
    "restrict_to_keys": _valid(f"select {ID}, _pos from valid where lower(\"Status\") like '%failure%'"),
    "part_name_similarity": PART_NAMES,
    "status_similarity": STATUS_SCORES,
    "candidate_pairs": _pairs(BLOCK, True),
    "candidate_pairs_per_device": _pairs('"DeviceId", "DeviceType"', False),
    "fuzzy_dedup": _silver(f"select {ID}, _pos from silver"),
    "fuzzy_dedup_case_sensitive": f"""with recursive {VALID}, {_survivors('kept', BLOCK, False)}
select {ID}, _pos from kept""",
    "fuzzy_dedup_no_time": f"""with recursive {VALID}, {_survivors('kept', '"DeviceId", "DeviceType"')}
select {ID}, _pos from kept""",
    "silver_events": _silver(f"select {BRONZE_COLUMNS}, '{AT}' as _silver_processed_at from silver"),
    "silver_ordered": _silver(f'select {ID} from silver order by "DeviceId", "TimestampUTC"'),
    "silver_upsert": UPSERT,
    "gold_washing": _silver(WASHING),
    "gold_dishwasher": _silver(DISHWASHER),
    "gold_unknown": _silver(f'select {ID}, "Attributes", {AUDIT} from silver where not {IS_KNOWN}'),
    "gold_coffee": _silver(COFFEE_WIDE),
    "attribute_long": _silver(COFFEE_LONG),
    "attribute_ids": _silver(
        f"""select distinct "Id", regexp_replace("Id", '[^\\p{{L}}\\p{{N}}_]', '_', 'g') as stem from ({COFFEE_LONG})"""
    ),
    "attribute_drift": _dev(
        f"""select distinct "Id" from ({COFFEE_LONG.replace('from silver', 'from dev')}) where "Id" not in
 (select "Id" from ({COFFEE_LONG.replace('from silver', 'from dev')}) where "Unit" = 'Celsius')"""
    ),
    "unknown_type_counts": _silver(f'select "DeviceType", count(*) as rows from silver where not {IS_KNOWN} group by 1'),
    "unknown_types": _silver(f'select distinct "DeviceType" from silver where not {IS_KNOWN}'),
    "id_prefix_split": _dev(
        """select case when "DeviceId" like 'syn\\_%' escape '\\' then 'prefixed' else 'other' end as part, "DeviceId",
 count(*) as rows from dev group by 1, 2"""
    ),
    "failure_events": _silver(f"select {ID}, _pos from silver where lower(\"Status\") like '%failure%'"),
    "stage_counts": _silver(STAGES),
    "quality_metrics": _silver(METRICS),
    "quality_alerts": _silver(
        _alert("invalid_pct", "1.0", "share of rejected rows")
        + " union all "
        + _alert("post_dedup_pct", "20.0", "share of dropped copies")
    ),
    "quality_rules": RULES,
    "routing_check": _silver(ROUTING),
    "rows_by_device_type": _silver('select "DeviceType", count(*) as rows from silver group by 1'),
    "sample_rows": _silver(
        f"""select {ID} from silver
 order by md5(concat_ws('|', '7', "DeviceId", "TimestampUTC", "DeviceType", "Status")), {ID} limit 100"""
    ),
    "replay_cumulative": _dev(REPLAY),
    "as_of_batch": _dev(f"select {ID}, _pos from dev where _batch_id < (select max(_batch_id) from dev)"),
    "batch_list": _dev("select distinct _batch_id from dev order by 1"),
    "csv_round_trip": _silver(f"""select {ID}, "Attributes", '{AT}' as _silver_processed_at from silver"""),
    "compacted_table": _silver(f"select {ID}, _pos from silver"),
    "streaming_bronze": _dev(f'select * exclude (_source_file, temperature, first_failure, first_id, bare_value) from ({ELEMENTS})'),
    "streaming_bad_files": _dev(f"select error, count(*) as files from ({BAD_FILES}) group by 1"),
    "streaming_dedup": _valid(f"select distinct {ID} from valid"),
    "streaming_silver": _valid(f"select distinct {ID} from valid"),
    "streaming_dead_letter": _valid(f"select {ID}, _pos, reason as _rejection_reason from judged where reason is not null"),
    "bronze_split_array": _dev(ARRAY_TEXT),
    "incremental_silver": _silver(f"select {BRONZE_COLUMNS}, '{AT}' as _silver_processed_at from silver"),
    "incremental_summary": _silver(SUMMARY),
    "fuzzy_dedup_crowded": CROWDED,
    "gold_malformed": MALFORMED,
    "coffee_name_clashes": f"""with {VALID.replace('valid as (select * replace (canon as "TimestampUTC") from',
        "valid as (select * replace (canon as \"TimestampUTC\", concat(substr(\"Attributes\", 1, length(\"Attributes\") - 1), "
        "', {\"Id\": \"Status\", \"Value\": 1, \"Unit\": \"x\"}, {\"Id\": \"Cup Size\", \"Value\": ', _pos % 5, "
        "', \"Unit\": \"cl\"}, {\"Id\": \"Temperature\", \"Value\": 1, \"Unit\": \"K\"}]') as \"Attributes\") from")}
{_clash('first')} union all {_clash('last')}""",
    "summary_by_batch": _silver(SUMMARY_BY_BATCH).replace("select * from (select distinct", "select * exclude (d, t) from (select distinct"),
    "quality_by_batch": _silver(BY_BATCH),
    "quality_log": _silver(LOG),
    "routed_gold": _silver(ROUTING),
    "csv_line_breaks": _valid(f"""select {ID}, replace("Attributes", ', ', concat(',', chr(10), '"')) as "Attributes", cast(_pos as varchar) as _pos from valid"""),
    "table_lifecycle": _silver(LIFECYCLE),
    "replay_previews": f"with {DEV}, {PREVIEWS.removeprefix('with ')}",
    "layers_end_to_end": _silver(END_TO_END),
    "registered_table": f"with recursive {SILVER}, {REGISTERED.removeprefix('with ')}",
    "streaming_near_duplicates": _silver(f"select {BRONZE_COLUMNS}, '{AT}' as _silver_processed_at from silver"),
    "zorder_skipping": _silver(ZORDER),
    "attribute_drift_all": DRIFT,
}
