"""DuckDB text: the log views as common table expressions, and helpers for roll-ups."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import combinations

D5 = ("province_id", "city_id", "platform", "device_provider", "fw_version")
D2 = ("province_id", "city_id")

_AREA = "t.probe_id, t.province_id, t.city_id, t.platform, t.device_provider, t.fw_version"
_LINES = """from lineitem l join orders o on o.o_orderkey = l.l_orderkey
     join fx_terminal_info t on t.probe_id = 'p' || cast(o.o_custkey as varchar)"""
_EVENTS = "from events e join fx_terminal_info t on t.probe_id = 'p' || cast(e.user_id as varchar)"
_LINE_TIME = "l.l_shipdate + l.l_linenumber * interval '1' minute as event_time, l.l_orderkey * 8 + l.l_linenumber as seq"

VIEWS = {
    "fx_terminal_info": """
select 'p' || cast(c_custkey as varchar) as probe_id, 'd' || cast(c_custkey as varchar) as device_id,
       cast(c_nationkey as varchar) as province_id,
       cast(c_nationkey * 10 + c_custkey % 10 as varchar) as city_id,
       c_mktsegment as platform, 'dev' || cast(c_custkey % 7 as varchar) as device_provider,
       'fw' || cast(c_custkey % 3 as varchar) as fw_version, c_custkey as seq
from customer""",
    "fx_terminal_report": """
select t.probe_id, t.device_id, t.province_id, t.city_id, t.platform, t.device_provider,
       'fw' || cast(o.o_orderkey % 3 as varchar) as fw_version, o.o_orderdate as event_time, o.o_orderkey as seq
from orders o join fx_terminal_info t on t.probe_id = 'p' || cast(o.o_custkey as varchar)""",
    "fx_state": """
select 'p' || cast(user_id as varchar) as probe_id, 'h' || cast(event_id % 200 as varchar) as has_id,
       cast(event_id % 4 as varchar) as state, ts as event_time, event_id as seq
from events where event_type in ('view', 'signup')""",
    "fx_play_request": f"""
select t.probe_id || 's' || cast(l.l_orderkey as varchar) as has_id, t.probe_id,
       case when l.l_linenumber = 7 then '2' else t.province_id end as province_id,
       case when l.l_linenumber = 7 then '0' else t.city_id end as city_id,
       t.platform, t.device_provider, t.fw_version, cast(l.l_orderkey % 9 + 1 as varchar) as has_type,
       cast(l.l_quantity as bigint) * 60 as play_seconds, cast(l.l_linenumber as bigint) as freeze_count,
       case when l.l_returnflag = 'N' then cast(0 as bigint)
            else cast(floor(l.l_discount * 100 + 0.5) as bigint)
                 * (o.o_custkey % 4) * (o.o_custkey % 4) * (o.o_custkey % 4) * 30000 end as freeze_time,
       (cast(l.l_quantity as bigint) - 1) * 1100000 as latency,
       cast(floor(l.l_extendedprice) as bigint) as down_bytes,
       case when l.l_quantity = 1 then cast(0 as bigint) else cast(l.l_quantity as bigint) end as down_seconds,
       {_LINE_TIME} {_LINES}""",
    "fx_lag": f"""
select 'h' || cast(e.event_id % 200 as varchar) as has_id, {_AREA},
       cast(e.event_id % 17 + 1 as varchar) as export_id, e.ts as event_time, e.event_id as seq
{_EVENTS} where e.event_type = 'click'
union all
select 'h' || cast(e.event_id % 200 as varchar), {_AREA}, '1', e.ts, e.event_id + 10000000
{_EVENTS} where e.event_type = 'click' and e.event_id % 5 = 0""",
    "fx_play_fail": f"""
select t.probe_id, case when e.event_id % 11 = 0 then '2' else t.province_id end as province_id,
       case when e.event_id % 11 = 0 then '0' else t.city_id end as city_id, t.platform, t.device_provider,
       t.fw_version, cast(e.event_id % 9 + 1 as varchar) as has_type,
       cast(400 + e.event_id % 5 as varchar) as status_code, e.ts as event_time, e.event_id as seq
{_EVENTS} where e.event_type = 'error'""",
    "fx_play": f"""
select 'h' || cast(e.event_id as varchar) as has_id, {_AREA},
       cast(e.event_id % 9 + 1 as varchar) as has_type, e.ts as event_time {_EVENTS}""",
    "fx_epg": f"""
select {_AREA}, cast(l.l_linenumber % 3 + 1 as varchar) as page_type, cast(l.l_quantity as bigint) as requests,
       cast(floor(l.l_extendedprice) as bigint) * 30 as http_rsp_time,
       cast(l.l_quantity as bigint) - l.l_linenumber % 2 as page_suc_cnt, {_LINE_TIME} {_LINES}""",
    "fx_image": f"""
select {_AREA}, cast(l.l_quantity as bigint) - 1 as requests,
       case when l.l_quantity > 2 then cast(l.l_quantity as bigint) - 2 else cast(0 as bigint) end as suc_cnt,
       case when l.l_quantity > 5 then cast(l.l_quantity as bigint) - 5 else cast(0 as bigint) end as le3s_cnt,
       {_LINE_TIME} {_LINES}""",
    "fx_login": f"""
select {_AREA}, o.o_orderkey % 5 as pages,
       case when o.o_orderkey % 5 > 1 then o.o_orderkey % 5 - 1 else 0 end as suc_pages,
       o.o_orderdate as event_time, o.o_orderkey as seq
from orders o join fx_terminal_info t on t.probe_id = 'p' || cast(o.o_custkey as varchar)""",
    "fx_http_error": f"""
select {_AREA}, cast(400 + l.l_partkey % 6 as varchar) as http_rsp_code, cast(l.l_quantity as bigint) as cnt,
       {_LINE_TIME} {_LINES}""",
    "fx_event": f"""
select {_AREA}, cast(e.event_id % 16 + 1 as varchar) as event_id, cast(floor(e.value) as bigint) as cnt,
       e.ts as event_time, e.event_id as seq {_EVENTS}""",
}


def with_views(body: str, ctes: str = "") -> str:
    """``body`` with every log view it needs in front; ``ctes`` are further expressions of the query."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bfx_\w+", text):
            if name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(ctes + " " + body)
    parts = [f"{name} as ({VIEWS[name]})" for name in needed]
    if ctes:
        parts.append(ctes)
    return f"with {', '.join(parts)}\n{body}" if parts else body


def cube(source: str, dims: Sequence[str], aggregates: str, fixed: Sequence[str] = (), where: str = "true") -> str:
    """One GROUP BY fixed, CUBE(dims) query; empty input gives no rows."""
    keys = [*fixed, *[f"case when grouping({d}) = 1 then 'ALL' else {d} end as {d}" for d in dims]]
    group = ", ".join([*fixed, f"cube({', '.join(dims)})"])
    return (f"select {', '.join(keys)}, {aggregates} from {source} where {where} "
            f"group by {group} having count(*) > 0")


def levels(source: str, dims: Sequence[str], aggregates: str, fixed: Sequence[str] = (), where: str = "true") -> str:
    """The same roll-up as a union of one plain query per level."""
    queries = []
    for n in range(len(dims) + 1):
        for kept in combinations(dims, n):
            keys = [*fixed, *[d if d in kept else f"'ALL' as {d}" for d in dims]]
            group = ", ".join([*fixed, *kept])
            tail = f"group by {group}" if group else ""
            queries.append(f"select {', '.join(keys)}, {aggregates} from {source} where {where} {tail} "
                           "having count(*) > 0")
    return " union all ".join(queries)


def isum(expression: str, name: str) -> str:
    return f"cast(sum({expression}) as bigint) as {name}"


def minute(ts: str = "event_time") -> str:
    return f"strftime({ts}, '%Y%m%d%H%M')"


def bucket(minutes: int | str, ts: str = "event_time") -> str:
    return f"strftime(time_bucket(interval '{minutes} minutes', {ts}), '%Y%m%d%H%M')"


def rate4(part: str, whole: str) -> str:
    return f"round_even(cast({part} as double) / {whole}, 4)"
