"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from tickflow.schemas import LADDER, LADDER_SCALED, Ladder

HOUR = 3600
DAY = 86400
LONG_HORIZON = 7200


def _rounded(expression: str) -> str:
    return f"round({expression} + 1e-9, 6) + 0.0"


def _bucket(seconds: str) -> str:
    # The default origin is not the epoch.
    return f"time_bucket(to_seconds({seconds}), ts, timestamp '1970-01-01')"


def _ladder(ladder: Ladder) -> str:
    rungs = ", ".join(f"('{label}', {width})" for label, width in ladder.rungs)
    return f"""rungs(win, secs) as (values {rungs}),
stats as (
  select {_bucket('secs')} + to_seconds(secs) as t, event_type as symbol, win, secs,
         avg(value + 0.0) as a, stddev_samp(value + 0.0) as sd
  from events, rungs group by all)"""


def _prices(grain: int) -> str:
    return f"""prices as (
  select {_bucket(str(grain))} as t, event_type as symbol, avg(value + 0.0) as p from events group by all)"""


_TICKS = """select event_type as symbol, value + 0.0 as price, ts as "timestamp" from events"""


def _second_price(grain: int) -> str:
    return f"""with {_prices(grain)}
select t as "timestamp", symbol, {_rounded('p')} as price from prices"""


def _window_stats(ladder: Ladder) -> str:
    return f"""with {_ladder(ladder)}
select t as "timestamp", symbol, win as "window",
       {_rounded('a')} as avg_price, {_rounded('sd')} as std_price from stats"""


def _scores(ladder: Ladder, grain: int) -> str:
    return f"""with {_ladder(ladder)}, {_prices(grain)},
scores as (
  select t, symbol, win, secs, p, a, sd,
         case when sd = 0 or sd is null then 0.0 else (p - a) / sd end as z
  from prices join stats using (t, symbol))"""


def _zscores(ladder: Ladder, grain: int) -> str:
    return f"""{_scores(ladder, grain)}
select t as "timestamp", symbol, win as "window", {_rounded('p')} as price,
       {_rounded('a')} as avg_price, {_rounded('sd')} as std_price, {_rounded('z')} as zscore_price
from scores"""


_DOCUMENTS = f"""{_scores(LADDER_SCALED, HOUR)}
select t as "timestamp", symbol, win as "window", {_rounded('z')} as zscore_price from scores"""


def _shifts(horizon: int, price: str = "value") -> str:
    def seconds(side: str) -> str:
        return f"coalesce(({side} // 1000) / 1000.0, {horizon}.0)::double"
    return f"""with ticks as (select event_id, event_type as symbol, {price} as price, ts, epoch_us(ts) as us from events where {price} is not null),
gaps as (
  select a.event_id, a.symbol, a.ts,
         min(case when b.price > a.price then b.us - a.us end) as hi,
         min(case when b.price < a.price then b.us - a.us end) as lo
  from ticks a left join ticks b
    on a.symbol = b.symbol and b.us > a.us and b.us - a.us < {(horizon + 1) * 1_000_000}
  group by all),
shifts as (
  select event_id, symbol, ts,
         {seconds('hi')} as higher_window, hi is not null as higher_found,
         {seconds('lo')} as lower_window, lo is not null as lower_found
  from gaps)"""


def _price_shift(horizon: int, price: str = "value") -> str:
    return f"""{_shifts(horizon, price)}
select event_id, higher_window, higher_found, lower_window, lower_found from shifts"""


def _first(kind: str) -> str:
    return f"""{_shifts(LONG_HORIZON)}
select symbol, ts as "timestamp", {kind}_window as window_seconds, {kind}_found as "found" from shifts"""


_SHIFT_EVENTS = f"""{_shifts(LONG_HORIZON)}
select symbol, ts as "timestamp", 'higher' as kind, higher_window as window_seconds, higher_found as "found" from shifts
union all
select symbol, ts, 'lower', lower_window, lower_found from shifts"""


# Late ticks: the watermark is 10 s (in whole milliseconds) behind the last tick in time; a slot is half of the
# horizon and waits until the watermark has passed its end by the horizon.
_LATE_SHIFTS = f"""with ticks as (
  select event_type as symbol, value as price, ts, epoch_us(ts) as us, event_id % 7 = 3 as late from events where value is not null),
mark as (select max(us) // 1000 * 1000 - 10000000 as us from ticks where not late),
placed as (
  select t.*, t.us // {(DAY + 2) // 2 * 1_000_000} * {(DAY + 2) // 2 * 1_000_000} + {((DAY + 2) // 2 + DAY + 1) * 1_000_000} <= mark.us as over
  from ticks t, mark),
gaps as (
  select a.symbol, a.ts, a.us, a.price, a.late, a.over,
         min(case when b.price > a.price then b.us - a.us end) as hi,
         min(case when b.price < a.price then b.us - a.us end) as lo
  from placed a left join placed b
    on a.symbol = b.symbol and b.us > a.us and b.us - a.us < {(DAY + 1) * 1_000_000} and not (a.over and b.late)
  where not (a.late and a.over) group by all)
select symbol, ts as "timestamp", 'late' as kind, null::double as window_seconds, null::boolean as "found" from placed where late and over
union all
select symbol, ts, 'higher', coalesce((hi // 1000) / 1000.0, {DAY}.0)::double, hi is not null from gaps
union all
select symbol, ts, 'lower', coalesce((lo // 1000) / 1000.0, {DAY}.0)::double, lo is not null from gaps"""


def _message(kind: str) -> str:
    instant = """strftime(ts, '%Y-%m-%dT%H:%M:%S') || case
      when epoch_us(ts) % 1000000 = 0 then ''
      when epoch_us(ts) % 1000 = 0 then '.' || strftime(ts, '%g')
      else '.' || strftime(ts, '%f') end || 'Z'"""
    return f"""select '{kind}' as kind,
       '{{"timestamp":"' || {instant} || '","{kind}_window":' || {kind}_window::varchar || '}}' as value
from shifts"""


_MESSAGES = f"""{_shifts(LONG_HORIZON)}
{_message('higher')}
union all
{_message('lower')}"""

_VALIDATE = r"""with texts as (
  select to_json({'symbol': event_type, 'price': (value + 0.0)::varchar, 'timestamp': ts})::varchar as t, 'ticks' as origin
  from events
  union all select to_json({'symbol': event_type, 'price': (value + 0.0)::varchar, 'timestamp': ts})::varchar || tail, 'ticks' || tail
  from events, (values (']x'), (',0]'), ('],[0')) tails(tail)
  union all select props, 'events' from events
  union all select text, 'documents' from documents
  union all select text, 'conversations' from conversations
  union all select html, 'pages' from pages
  union all select text, 'benchmark' from benchmark
  union all select to_json(embedding)::varchar, 'embeddings' from embeddings
  union all select to_json({'symbol': o_orderstatus, 'price': o_orderpriority})::varchar, 'orders' from orders
  union all select to_json({'symbol': l_partkey, 'price': l_extendedprice})::varchar, 'lineitem' from lineitem),
judged as (
  select origin, t, case when json_valid(t) then t end as j from texts),
verdicts as (
  select origin, case
    when t is null or trim(t, E' \t\n\r') in ('', 'null', 'false', '""', '{}', '[]', '0') then 'empty'
    when j is null then 'not_json'
    when json_type(j) <> 'OBJECT' then 'not_object'
    when not (list_contains(json_keys(j), 'symbol') and list_contains(json_keys(j), 'price')) then 'missing_field'
    when try_cast(json_extract_string(j, '$.price') as double) is null then 'bad_price'
    else 'good' end as verdict,
    case when json_type(j) = 'OBJECT' and not isfinite(try_cast(json_extract_string(j, '$.price') as double))
         then 1 else 0 end as odd
  from judged)
select origin, verdict, count(*) as records, sum(odd)::bigint as non_finite from verdicts group by all"""

_NESTED = """select t as "timestamp", symbol, string_agg(win, ',' order by secs) as windows
from {table} group by all"""

ORACLE_SQL: dict[str, str] = {
    "tick_parse": _TICKS,
    "tick_publish": _TICKS,
    "tick_validate": _VALIDATE,
    "tick_stamp": "select event_id, true as stamped_now, ts as kept from events",
    "tick_second_price": _second_price(1),
    "tick_hour_price": _second_price(HOUR),
    "window_stats_default": _window_stats(LADDER),
    "window_stats_scaled": _window_stats(LADDER_SCALED),
    "window_stats_nested": f"with {_ladder(LADDER)} " + _NESTED.format(table="stats"),
    "window_stats_nested_values": _window_stats(LADDER),
    "window_stats_wire": _window_stats(LADDER_SCALED),
    "zscore_default": _zscores(LADDER, 1),
    "zscore_scaled": _zscores(LADDER_SCALED, HOUR),
    "zscore_joined": _zscores(LADDER_SCALED, HOUR),
    "zscore_nested": f"{_scores(LADDER_SCALED, HOUR)} " + _NESTED.format(table="scores"),
    "zscore_unnested": _DOCUMENTS,
    "route_counts": f"""{_scores(LADDER_SCALED, HOUR)}
select win as "window", count(*) as documents from scores group by win""",
    "price_shift_20s": _price_shift(20),
    "price_shift_7200s": _price_shift(LONG_HORIZON),
    "price_shift_split": _price_shift(LONG_HORIZON),
    "price_shift_rising": _price_shift(LONG_HORIZON, "event_id::double"),
    "price_shift_null_prices": _price_shift(LONG_HORIZON, "(case when value >= 50 then value end)"),
    "first_higher": _first("higher"),
    "first_lower": _first("lower"),
    "price_shift_messages": _MESSAGES,
    "stream_ingest": """select 'good' as outcome, count(*) as records from events
union all select 'missing_field', count(*) from events
union all select 'bad_price', count(*) from orders""",
    "stream_ingest_ticks": f"""select event_type as symbol, {_rounded('value')} as price, count(*) as records
from events group by all""",
    "stream_replay": """select 'good' as output, count(*) as records, count(*) as committed from events
union all select 'rejected', n, n from (select (select count(*) from events) + (select count(*) from orders) as n)""",
    "stream_hour_price": _second_price(HOUR),
    "stream_late_ticks": _second_price(HOUR),
    "stream_window_stats": _window_stats(LADDER_SCALED),
    "stream_window_stats_from_slots": _window_stats(LADDER_SCALED),
    "stream_zscore": _DOCUMENTS,
    "stream_zscore_chained": _DOCUMENTS,
    "stream_price_shift": _SHIFT_EVENTS,
    "stream_price_shift_eager": _SHIFT_EVENTS,
    "stream_price_shift_late": _LATE_SHIFTS,
    "stream_route": _DOCUMENTS,
}
