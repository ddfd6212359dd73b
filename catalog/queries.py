"""Registered queries: each takes (spark, sf_dir) and runs over the whole tables of that folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.views import Views
from viewpulse.functions import rates as R
from viewpulse.functions import text as X
from viewpulse.functions import timecols as T
from viewpulse.model import D2, D5, HAS_TYPES, LOGS, SERIES_PREFIX
from viewpulse.operators import cube as C
from viewpulse.operators import enrich as E
from viewpulse.operators import parse as P
from viewpulse.operators import series as S
from viewpulse.plans import network, page, play, stall, terminal
from viewpulse.plans.jobs import run_terminal_count
from viewpulse.plans.snapshots import CounterSnapshots
from viewpulse.session import shared_path
from viewpulse.sinks.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ONE = "cast(count(*) as bigint)"
TYPES = "has_type in ('1','2','3','4','5','8','9')"
EVENTS = "event_id in ('1','2','3','4','6','7','8','9','10','11','12','13','14','15','16')"
DIMS5 = ", ".join(D5)


def register(name: str, oracle: str | None = None):
    """Register ``fn(views)`` under ``name``."""
    def wrap(fn: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def with_minute(df: DataFrame) -> DataFrame:
    return df.withColumn("minute", T.minute_label(F.col("event_time")))


def labelled(df: DataFrame, *times: str) -> DataFrame:
    """Times as twelve-digit text."""
    return df.withColumns({t: T.minute_label(F.col(t)) for t in times})


def latest(v: Views, distinct: bool = True) -> DataFrame:
    return E.latest_per_session(v.play_request.drop("seq"), distinct)


LATEST = """latest as (select distinct p.* exclude (seq) from fx_play_request p
  join (select has_id, max(event_time) as m from fx_play_request group by has_id) k
    on p.has_id = k.has_id and p.event_time = k.m)"""

# ---- parsing ------------------------------------------------------------------------------------------------------
_DAMAGE = {"type": "seq % 13 = 0", "length": "seq % 17 = 0", "blank": "seq % 19 = 0", "value": "seq % 23 = 0"}
_STRICT = {"terminal_info": (), "state": (), "play_request": (), "lag": (), "play_fail": (),
           "epg": ("blank", "value"), "image": ("blank", "value"), "login": ("blank", "value"),
           "http_error": ("blank", "value"), "event": ("blank", "value")}
_AREA = "probe_id, province_id, city_id, platform, device_provider, fw_version"
_SECOND = "strftime(event_time, '%Y%m%d%H%M%S') as event_time"
_PARSED = {
    "terminal_info": f"{_AREA}, device_id", "state": f"probe_id, has_id, state, {_SECOND}",
    "play_request": f"""has_id, {_AREA}, has_type, case when seq % 23 = 0 then 0 else play_seconds end as play_seconds,
        freeze_count, freeze_time, case when seq % 19 = 0 then 0 else latency end as latency, down_bytes,
        down_seconds, {_SECOND}""",
    "lag": f"has_id, {_AREA}, export_id, strftime(event_time, '%Y%m%d%H%M00') as event_time",
    "play_fail": f"{_AREA}, has_type, status_code, {_SECOND}",
    "epg": f"{_AREA}, page_type, requests, http_rsp_time, page_suc_cnt, {_SECOND}",
    "image": f"{_AREA}, requests, suc_cnt, le3s_cnt, {_SECOND}",
    "login": f"{_AREA}, pages, suc_pages",
    "http_error": f"{_AREA}, http_rsp_code, cnt",
    "event": f"{_AREA}, event_id, cnt, {_SECOND}",
}


def _parsed_columns(v: Views, log: str) -> list[Column]:
    names = [c for c in v.records(log).columns if c in LOGS[log].fields or c == "has_id"]
    return [T.stamp(F.col(c)).alias(c) if c == "event_time" else F.col(c) for c in names]


def _register_parsers() -> None:
    for log in LOGS:
        mode = "offline" if log in ("play_request", "image", "event", "epg") else "realtime"
        good = " and ".join(f"not ({_DAMAGE[d]})" for d in ("type", "length", *_STRICT[log]))

        def parse(v: Views, log: str = log) -> DataFrame:
            rows = P.parse_valid(v.raw_lines(log), log)
            return rows.select("seq", *_parsed_columns(v, log))

        register(f"parse_{log}", Q.with_views(f"select seq, {_PARSED[log]} from fx_{log} where {good}"))(parse)

        checked = ("blank", "value") if log == "play_request" else _STRICT[log]
        case = " ".join(f"when {_DAMAGE[d]} then '{d}'" for d in ("type", "length", *checked))

        def validate(v: Views, log: str = log, mode: str = mode) -> DataFrame:
            parsed = P.parse_log(v.raw_lines(log), log, mode)
            outcome = F.coalesce(F.col(P.REASON), F.lit("ok")).alias("outcome")
            return parsed.groupBy(outcome).agg(F.count(F.lit(1)).alias("lines"))

        register(f"validate_{log}", Q.with_views(
            f"select outcome, {ONE} as lines from (select case {case} else 'ok' end as outcome from fx_{log}) "
            "group by outcome"))(validate)


_register_parsers()


@register("parse_split", Q.with_views("""
select seq, case when seq % 17 = 0 then 1 else 16 end as n_fields,
       case when seq % 13 = 0 then '99' else '11' end as first_field,
       case when seq % 17 = 0 then null when seq % 23 = 0 then 'x' else cast(cnt as varchar) end as field_13,
       case when seq % 17 = 0 then null else '' end as last_field
from fx_event"""))
def parse_split(v: Views) -> DataFrame:
    fields = F.col("fields")
    lines = v.raw_lines("event").select("seq", X.split_fields(F.col("value")).alias("fields"))
    return lines.select("seq", F.size(fields).cast("int").alias("n_fields"), X.field_at(fields, 0).alias("first_field"),
                        X.field_at(fields, 13).alias("field_13"), X.field_at(fields, 15).alias("last_field"))


@register("filter_has_type", Q.with_views(f"""
select has_type, {ONE} as n, {Q.isum('play_seconds', 'play_seconds')} from fx_play_request where {TYPES}
group by has_type"""))
def filter_has_type(v: Views) -> DataFrame:
    rows = v.play_request.where(R.member(F.col("has_type"), HAS_TYPES))
    return rows.groupBy("has_type").agg(F.count(F.lit(1)).alias("n"), F.sum("play_seconds").alias("play_seconds"))


@register("rate_round4", Q.with_views("""
select seq, case when requests = 0 then null else round_even(cast(suc_cnt as double) / requests, 4) end as rate,
       case when requests = 0 then null
            else least(round_even(cast(suc_cnt as double) * 3 / requests, 4), 1.0) end as clamped,
       requests * 1234567 // 1000000 as seconds
from fx_image"""))
def rate_round4(v: Views) -> DataFrame:
    suc, all_ = F.col("suc_cnt"), F.col("requests")
    return v.image.select("seq", R.rate4(suc, all_).alias("rate"),
                          F.when(all_ != 0, R.clamp_to_one(R.rate4(suc * 3, all_))).alias("clamped"),
                          R.micros_to_seconds(all_ * 1234567).alias("seconds"))


@register("series_key", """
select c_custkey, 'EPG_RSP15R#' || c_mktsegment || '#' || cast(c_nationkey as varchar) as series,
       c_mktsegment as part_1, cast(c_nationkey as varchar) as part_2 from customer""")
def series_key(v: Views) -> DataFrame:
    key = X.series_key(SERIES_PREFIX["epg_mean"], ["c_mktsegment", F.col("c_nationkey").cast("string")], "15R")
    keyed = v.table("customer").select("c_custkey", key.alias("series"))
    return keyed.select("*", X.split_series_key(F.col("series"), 1).alias("part_1"),
                        X.split_series_key(F.col("series"), 2).alias("part_2"))


# ---- time ---------------------------------------------------------------------------------------------------------
@register("time_minute", f"select event_id, {Q.minute('ts')} as label from events")
def time_minute(v: Views) -> DataFrame:
    return v.table("events").select("event_id", T.minute_label(F.col("ts")).alias("label"))


@register("time_quarter", f"select event_id, {Q.bucket(15, 'ts')} as label, {Q.bucket(15, 'ts')} as of_text from events")
def time_quarter(v: Views) -> DataFrame:
    return v.table("events").select("event_id", T.bucket_label(F.col("ts"), 15).alias("label"),
                                    T.quarter_hour_of_label(T.minute_label(F.col("ts"))).alias("of_text"))


@register("time_hour", f"select event_id, {Q.bucket(60, 'ts')} as label from events")
def time_hour(v: Views) -> DataFrame:
    return v.table("events").select("event_id", T.bucket_label(F.col("ts"), 60).alias("label"))


_STAMP = "'%Y%m%d%H%M%S'"


@register("period_previous", f"""
select o_orderkey, strftime(o_orderdate - interval 30 minutes, {_STAMP}) as p_15min,
  strftime(o_orderdate - interval 1 hour, {_STAMP}) as p_hour, strftime(o_orderdate - interval 1 day, {_STAMP}) as p_day,
  strftime(o_orderdate - interval 7 days, {_STAMP}) as p_week,
  strftime(o_orderdate - interval 1 month, {_STAMP}) as p_month,
  strftime(o_orderdate - interval 3 months, {_STAMP}) as p_quarter,
  strftime(o_orderdate - interval 6 months, {_STAMP}) as p_halfyear,
  strftime(o_orderdate - interval 1 year, {_STAMP}) as p_year from orders""")
def period_previous(v: Views) -> DataFrame:
    ts = F.col("o_orderdate")
    periods = ("15MIN", "HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "HALFYEAR", "YEAR")
    return v.table("orders").select("o_orderkey", *[
        T.stamp(T.previous_period(ts, p)).alias(f"p_{p.lower()}") for p in periods])


@register("period_parse", """
select event_id, strftime(date_trunc('year', ts), '%Y%m%d%H%M%S') as of_year,
  strftime(date_trunc('month', ts), '%Y%m%d%H%M%S') as of_month,
  strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') as of_day, strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') as of_hour,
  strftime(date_trunc('minute', ts), '%Y%m%d%H%M%S') as of_minute, strftime(ts, '%Y%m%d%H%M%S') as of_second
from events""")
def period_parse(v: Views) -> DataFrame:
    text = T.stamp(F.col("ts"))
    names = {"year": 4, "month": 6, "day": 8, "hour": 10, "minute": 12, "second": 14}
    return v.table("events").select("event_id", *[
        T.stamp(T.appointed_time(F.substring(text, 1, n))).alias(f"of_{name}") for name, n in names.items()])


@register("period_label", """
select o_orderkey, strftime(o_orderdate, '%Y%m%d%H00') as hour_l, strftime(o_orderdate, '%Y%m%d0000') as day_l,
  strftime(date_trunc('week', o_orderdate), '%Y%m%d0000') as week_l, strftime(o_orderdate, '%Y%m000000') as month_l,
  strftime(date_trunc('quarter', o_orderdate), '%Y%m000000') as quarter_l,
  strftime(o_orderdate, '%Y') || case when month(o_orderdate) <= 6 then '01' else '07' end || '000000' as halfyear_l,
  strftime(o_orderdate, '%Y00000000') as year_l from orders""")
def period_label(v: Views) -> DataFrame:
    periods = ("HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "HALFYEAR", "YEAR")
    return v.table("orders").select("o_orderkey", *[
        T.period_label(F.col("o_orderdate"), p).alias(f"{p.lower()}_l") for p in periods])


@register("period_label_short", """
select o_orderkey, strftime(o_orderdate, '%Y%m%d%H') as hour_l, strftime(o_orderdate, '%Y%m%d') as day_l,
  strftime(o_orderdate, '%Y%m') || cast((day(o_orderdate) + isodow(date_trunc('month', o_orderdate)) - 2) // 7 + 1
    as varchar) as week_l, strftime(o_orderdate, '%Y%m') as month_l,
  strftime(date_trunc('quarter', o_orderdate), '%Y%m') as quarter_l,
  strftime(o_orderdate, '%Y') || case when month(o_orderdate) <= 6 then '01' else '07' end as halfyear_l,
  strftime(o_orderdate, '%Y') as year_l from orders""")
def period_label_short(v: Views) -> DataFrame:
    periods = ("HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "HALFYEAR", "YEAR")
    return v.table("orders").select("o_orderkey", *[
        T.period_label_short(F.col("o_orderdate"), p).alias(f"{p.lower()}_l") for p in periods])


@register("ts_to_epoch", """
select event_id, cast(epoch(date_trunc('second', ts)) * 1000 as bigint) as millis, cast(-1 as bigint) as unreadable
from events""")
def ts_to_epoch(v: Views) -> DataFrame:
    return v.table("events").select("event_id", T.epoch_millis(T.stamp(F.col("ts"))).alias("millis"),
                                    T.epoch_millis(F.col("event_type")).alias("unreadable"))


@register("ts_add", f"""
select o_orderkey, strftime(o_orderdate + interval 45 days, {_STAMP}) as plus_days,
  strftime(o_orderdate - interval 45 days, {_STAMP}) as minus_days,
  strftime(o_orderdate + interval 5 months, {_STAMP}) as plus_months from orders""")
def ts_add(v: Views) -> DataFrame:
    ts = F.col("o_orderdate")
    return v.table("orders").select("o_orderkey", T.stamp(T.add_days(ts, 45)).alias("plus_days"),
                                    T.stamp(T.add_days(ts, -45)).alias("minus_days"),
                                    T.stamp(T.add_months(ts, 5)).alias("plus_months"))


@register("ts_diff", """
select event_id, cast(abs(date_sub('hour', ts, timestamp '2024-01-15 12:00:00')) as bigint) as hours,
  cast(abs(date_sub('day', ts, timestamp '2024-01-15 12:00:00')) as bigint) as days,
  cast(abs(date_sub('second', ts, timestamp '2024-01-15 12:00:00')) as bigint) as seconds from events""")
def ts_diff(v: Views) -> DataFrame:
    base = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return v.table("events").select("event_id", *[
        T.difference(unit, F.col("ts"), base).alias(name)
        for unit, name in (("HOUR", "hours"), ("DAY", "days"), ("SECOND", "seconds"))])


@register("ts_second_of_day", f"""
select event_id, cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) as bigint) as seconds,
  strftime(date_trunc('second', ts), {_STAMP}) as rebuilt from events""")
def ts_second_of_day(v: Views) -> DataFrame:
    seconds = T.second_of_day(F.col("ts"))
    return v.table("events").select("event_id", seconds.alias("seconds"),
                                    T.stamp(T.from_second_of_day(F.col("ts"), seconds)).alias("rebuilt"))


# ---- joins and records --------------------------------------------------------------------------------------------
@register("latest_per_session", Q.with_views(
    "select * exclude (event_time), strftime(event_time, '%Y%m%d%H%M') as event_time from latest", LATEST))
def latest_per_session(v: Views) -> DataFrame:
    return labelled(latest(v), "event_time")


@register("enrich_terminal", Q.with_views(f"""
select s.seq, s.probe_id, s.state, {', '.join('t.' + d for d in D5)} from fx_state s
join fx_terminal_info t on t.probe_id = s.probe_id"""))
def enrich_terminal(v: Views) -> DataFrame:
    return E.enrich_terminal(v.state.select("seq", "probe_id", "state"), v.terminal_info)


_REPAIRED = """repaired as (
  select f.* exclude (province_id, city_id),
    case when f.province_id = '2' then coalesce(t.province_id, f.province_id) else f.province_id end as province_id,
    case when f.province_id = '2' then coalesce(t.city_id, f.city_id) else f.city_id end as city_id
  from {view} f left join fx_terminal_info t on t.probe_id = f.probe_id)"""


@register("repair_area", Q.with_views(
    "select seq, probe_id, province_id, city_id, has_type from repaired", _REPAIRED.format(view="fx_play_fail")))
def repair_area(v: Views) -> DataFrame:
    return E.repair_area(v.play_fail.select("seq", "probe_id", "province_id", "city_id", "has_type"), v.terminal_info)


@register("repair_area_shuffled", Q.with_views(
    "select seq, probe_id, province_id, city_id, has_type from repaired", _REPAIRED.format(view="fx_play_request")))
def repair_area_shuffled(v: Views) -> DataFrame:
    rows = v.play_request.select("seq", "probe_id", "province_id", "city_id", "has_type")
    return E.repair_area(rows, v.terminal_info, limit=0)


@register("union_logs", Q.with_views(
    f"select probe_id, {ONE} as n from (select probe_id from fx_play union all select probe_id from fx_play_fail "
    "union all select probe_id from fx_state) group by probe_id"))
def union_logs(v: Views) -> DataFrame:
    rows = E.union_logs(*[df.select("probe_id") for df in (v.play, v.play_fail, v.state)])
    return rows.groupBy("probe_id").agg(F.count(F.lit(1)).alias("n"))


@register("state_snapshot", Q.with_views("""
select probe_id, has_id, state, strftime(event_time, '%Y%m%d%H%M') as event_time from fx_state
qualify row_number() over (partition by probe_id order by event_time desc, has_id desc, state desc) = 1"""))
def state_snapshot(v: Views) -> DataFrame:
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    before = E.state_snapshot(v.state.where(F.col("event_time") < half))
    return labelled(E.state_snapshot(v.state.where(F.col("event_time") >= half), before), "event_time")


# ---- roll-ups -----------------------------------------------------------------------------------------------------
def _n() -> dict:
    return {"n": ("sum", F.lit(1).cast("bigint"))}


@register("cube_all_d2", Q.with_views(Q.levels("fx_play", D2, f"{ONE} as n")))
def cube_all_d2(v: Views) -> DataFrame:
    return C.cube_all(v.play, D2, _n())


_SUM_MAX = f"{ONE} as n, {Q.isum('down_bytes', 'down_bytes')}, max(latency) as top_latency"


def _play_measures() -> dict:
    return _n() | {"down_bytes": ("sum", F.col("down_bytes")), "top_latency": ("max", F.col("latency"))}


@register("cube_all_d5", Q.with_views(Q.levels("fx_play_request", D5, _SUM_MAX)))
def cube_all_d5(v: Views) -> DataFrame:
    return C.cube_all(v.play_request, D5, _play_measures(), pre_aggregate=False)


@register("cube_preagg", Q.with_views(Q.cube("fx_play_request", D5, _SUM_MAX)))
def cube_preagg(v: Views) -> DataFrame:
    return C.cube_all(v.play_request, D5, _play_measures())


@register("cube_all_minute", Q.with_views(
    Q.cube(f"(select *, {Q.minute()} as minute from fx_event)", D5, Q.isum("cnt", "count_sum"), ("minute", "event_id"))))
def cube_all_minute(v: Views) -> DataFrame:
    return C.cube_and_filter(with_minute(v.event), D5, ("minute", "event_id"), {"count_sum": ("sum", F.col("cnt"))})


def _additive(view: str, ids: dict[str, str], dims=D5) -> str:
    parts = ", ".join(f"count(distinct {column}) as {name}" for name, column in ids.items())
    cells = f"(select {', '.join(dims)}, {parts} from {view} group by {', '.join(dims)})"
    return Q.cube(cells, dims, ", ".join(Q.isum(name, name) for name in ids))


@register("distinct_additive", Q.with_views(_additive("fx_play_request", {"boxes": "probe_id"})))
def distinct_additive(v: Views) -> DataFrame:
    return C.additive_distinct_cube(v.play_request, D5, {"boxes": "probe_id"})


@register("distinct_exact", Q.with_views(Q.levels("fx_play_request", D5, "count(distinct probe_id) as boxes")))
def distinct_exact(v: Views) -> DataFrame:
    return C.exact_distinct_cube(v.play_request, D5, "boxes", "probe_id")


#: five standard errors of a sketch of 2^12 registers, and one box for the smallest cells
_HLL_ERROR = 5 * 1.04 / 2**6


@register("distinct_hll", Q.with_views(Q.levels(
    "fx_play_request", D5, "count(distinct probe_id) as boxes, true as near")))
def distinct_hll(v: Views) -> DataFrame:
    exact = C.exact_distinct_cube(v.play_request, D5, "boxes", "probe_id")
    estimate = C.sketch_distinct_cube(v.play_request, D5, "estimate", "probe_id", lg_config_k=12)
    near = F.abs(F.col("estimate") - F.col("boxes")) <= F.col("boxes") * _HLL_ERROR + 1
    return exact.join(estimate, list(D5)).select(*D5, "boxes", near.alias("near"))


_FIRST = """firsts as (select * from fx_lag
  qualify row_number() over (partition by date_trunc('minute', event_time), has_id, probe_id
                             order by event_time, seq) = 1)"""


@register("lag_cause_dense", Q.with_views(f"""
select g.*, c.export_id, cast(coalesce(r.lag_count, 0) as bigint) as lag_count
from (select distinct {DIMS5} from rolled) g
cross join (select cast(i as varchar) as export_id, i <> 16 as listed from range(1, 18) x(i)) c
left join rolled r on {' and '.join(f'r.{d} = g.{d}' for d in D5)} and r.export_id = c.export_id
where c.listed or r.lag_count is not null""",
    f"rolled as ({Q.cube('fx_lag', D5, ONE + ' as lag_count', ('export_id',))})"))
def lag_cause_dense(v: Views) -> DataFrame:
    return stall.dense_cause_counts(v.lag)


# ---- play metrics -------------------------------------------------------------------------------------------------
@register("play_users_plays", Q.with_views(Q.levels(
    "latest", D2, "count(distinct probe_id) as play_users, count(distinct has_id) as plays"), LATEST))
def play_users_plays(v: Views) -> DataFrame:
    return play.users_and_plays(latest(v))


@register("play_totals_offline", Q.with_views(
    _additive("latest", {"plays": "has_id", "play_users": "probe_id"}), LATEST))
def play_totals_offline(v: Views) -> DataFrame:
    return play.play_totals(latest(v, distinct=False))


_USABLE = f"{TYPES} and latency > 0 and latency <= 50000000"


@register("first_frame_minute", Q.with_views(Q.cube(
    f"(select *, {Q.minute()} as minute from latest)", D5,
    f"{ONE} as latency_count, {Q.isum('latency', 'latency_sum')}, "
    "cast(sum(latency) // count(*) as bigint) as latency_mean", ("minute",), _USABLE), LATEST))
def first_frame_minute(v: Views) -> DataFrame:
    return play.first_frame(with_minute(latest(v)))


@register("first_frame_offline", Q.with_views(Q.cube(
    "latest", D5, f"{Q.rate4('sum(latency)', 'count(*)')} as latency", (), _USABLE), LATEST))
def first_frame_offline(v: Views) -> DataFrame:
    return play.first_frame_mean(latest(v))


def _bands(dims) -> str:
    cols = ", ".join(dims)
    return f"""{LATEST}, banded as (
  select {cols}, probe_id, sum(freeze_time) as f, cast(sum(freeze_time) as double) / nullif(sum(down_seconds), 0) as q
  from latest where {TYPES} group by {cols}, probe_id)"""


_BANDS = """cast(count(*) filter (f = 0) as bigint) as normal_users,
  cast(count(*) filter (f <> 0 and q > 0 and q <= 10000) as bigint) as occasional_users,
  cast(count(*) filter (f <> 0 and q > 10000 and q <= 50000) as bigint) as more_users,
  cast(count(*) filter (f <> 0 and q > 50000) as bigint) as serious_users, cast(count(*) as bigint) as users"""


@register("stall_distribution_d2", Q.with_views(Q.cube("banded", D2, _BANDS), _bands(D2)))
def stall_distribution_d2(v: Views) -> DataFrame:
    return play.stall_distribution(latest(v), D2)


@register("stall_distribution_d5", Q.with_views(Q.cube("banded", D5, _BANDS), _bands(D5)))
def stall_distribution_d5(v: Views) -> DataFrame:
    return play.stall_distribution(latest(v, distinct=False), D5)


@register("stall_health", Q.with_views(f"""
select * replace (round(health, 10) as health) from (select *, more_users + serious_users as fault_users,
  1.0 - cast(serious_users as double) / users - cast(more_users as double) / users / 3
  - cast(occasional_users as double) / users / 10 as health from ({Q.cube('banded', D2, _BANDS)}))""", _bands(D2)))
def stall_health(v: Views) -> DataFrame:
    rows = play.stall_health(play.stall_distribution(latest(v), D2))
    return rows.withColumn("health", F.round("health", 10))


@register("stall_user_rate", Q.with_views(f"""
select {DIMS5}, more_users + serious_users as fault_users,
  {Q.rate4('(more_users + serious_users)', 'users')} as user_rate from ({Q.cube('banded', D5, _BANDS)})""", _bands(D5)))
def stall_user_rate(v: Views) -> DataFrame:
    return play.stall_user_rate(play.stall_distribution(latest(v), D5))


_COUNTERS = ("down_bytes", "play_seconds", "freeze_time", "freeze_count")


def _grown(dims, period: str = "month", days: int = 31) -> str:
    cols = ", ".join(dims)
    maxima = ", ".join(f"max({c}) as {c}" for c in _COUNTERS)
    before = ", ".join(
        f"{c} - coalesce((select max(b.{c}) from cells b where b.has_id = a.has_id and b.has_type = a.has_type "
        f"and b.p = a.before_p), 0) as {c}_delta" for c in _COUNTERS)
    return f"""cells as (
  select date_trunc('{period}', event_time) as p, {cols}, has_id, has_type, {maxima} from fx_play_request
  group by all),
prior as (select distinct has_id, has_type, p from cells),
linked as (select *, lag(p) over (partition by has_id, has_type order by p) as q from prior),
dated as (select a.*, case when epoch(a.p) - epoch(l.q) < 2 * {days} * 86400 then l.q end as before_p
  from cells a join linked l on l.has_id = a.has_id and l.has_type = a.has_type and l.p = a.p),
grown as (select a.*, strftime(a.p, '%Y%m%d%H%M') as parse_time, {before} from dated a)"""


def _increments(v: Views, dims=D5) -> DataFrame:
    grown = play.increments(v.play_request, "MONTH", dims)
    return grown.withColumn("parse_time", T.minute_label(F.col("period_start")))


@register("delta_prev_period", Q.with_views(
    f"select parse_time, {DIMS5}, has_id, has_type, down_bytes, play_seconds, freeze_time, freeze_count, "
    "cast(down_bytes_delta as bigint) as down_bytes_delta, cast(play_seconds_delta as bigint) as play_seconds_delta, "
    "cast(freeze_time_delta as bigint) as freeze_time_delta, cast(freeze_count_delta as bigint) as freeze_count_delta "
    "from grown", _grown(D5)))
def delta_prev_period(v: Views) -> DataFrame:
    return _increments(v).drop("period_start")


@register("traffic_delta", Q.with_views(
    Q.cube("grown", D5, Q.isum("down_bytes_delta", "down_bytes"), ("parse_time",)), _grown(D5)))
def traffic_delta(v: Views) -> DataFrame:
    return play.traffic(_increments(v), D5, ("parse_time",))


@register("traffic_delta_d2", Q.with_views(
    Q.levels("grown", D2, Q.isum("down_bytes_delta", "down_bytes"), ("parse_time",)), _grown(D2)))
def traffic_delta_d2(v: Views) -> DataFrame:
    return play.traffic(_increments(v, D2), D2, ("parse_time",))


@register("service_online_time", Q.with_views(
    Q.cube("grown", D5, Q.isum("play_seconds_delta", "play_seconds"), ("parse_time", "has_type")), _grown(D5)))
def service_online_time(v: Views) -> DataFrame:
    return play.service_online_time(_increments(v), D5, ("parse_time",))


@register("service_online_time_d2", Q.with_views(
    Q.levels("grown", D2, Q.isum("play_seconds_delta", "play_seconds"), ("parse_time", "has_type")), _grown(D2)))
def service_online_time_d2(v: Views) -> DataFrame:
    return play.service_online_time(_increments(v, D2), D2, ("parse_time",))


@register("traffic_incremental", Q.with_views(
    Q.cube("grown", D5, Q.isum("down_bytes_delta", "down_bytes"), ("parse_time",)), _grown(D5, "quarter", 93)))
def traffic_incremental(v: Views) -> DataFrame:
    """One run per quarter, each from its own rows and the snapshots of runs before it; every fifth run is done twice."""
    log = shared_path(v.spark, "play_log")  # the log by quarter, as runs find it: one join for all of them
    label = F.date_format(F.date_trunc("quarter", F.col("event_time")), "yyyyMM")
    v.play_request.withColumn("_quarter", label).write.partitionBy("_quarter").parquet(log)
    rows = v.spark.read.schema(v.play_request.schema.add("_quarter", "string")).parquet(log)
    quarter = F.date_trunc("quarter", F.col("event_time")).cast("timestamp_ntz")
    starts = [r["q"] for r in rows.select(quarter.alias("q")).distinct().sort("q").collect()]
    snapshots = CounterSnapshots(v.spark, shared_path(v.spark, "snapshots"), "QUARTER")

    def rows_of(start: datetime) -> DataFrame:
        own = F.col("_quarter") == f"{start:%Y%m}"
        return rows.where(own & (quarter == F.lit(start).cast("timestamp_ntz"))).drop("_quarter")

    grown = None
    for run, start in enumerate(starts):
        own = snapshots.increments(rows_of, start)
        if run % 5 == 4:
            own = snapshots.increments(rows_of, start)
        grown = own if grown is None else grown.unionByName(own)
    return play.traffic(grown.withColumn("parse_time", T.minute_label(F.col("period_start"))), D5, ("parse_time",))


@register("business_quality", Q.with_views(Q.cube(
    "grown", D5, "cast(trunc(cast(sum(freeze_time_delta) as decimal(38,0)) / 1000000) as bigint) as freeze_seconds, "
    f"{Q.isum('freeze_count_delta', 'freeze_count')}, {Q.isum('play_seconds_delta', 'play_seconds')}, "
    "count(distinct has_id) as plays", ("parse_time",)), _grown(D5)))
def business_quality(v: Views) -> DataFrame:
    return play.business_quality(_increments(v), D5, ("parse_time",))


@register("play_fail_minute", Q.with_views(
    Q.cube(f"(select *, {Q.minute()} as minute from fx_play_fail)", D5, f"{ONE} as fail_count", ("minute",))))
def play_fail_minute(v: Views) -> DataFrame:
    return play.failures(with_minute(v.play_fail))


@register("play_fail_d2", Q.with_views(Q.levels(
    "(select *, strftime(event_time, '%Y%m%d%H%M%S') as event_second from fx_play_fail)", D2, f"{ONE} as fail_count",
    ("event_second",))))
def play_fail_d2(v: Views) -> DataFrame:
    rows = v.play_fail.withColumn("event_second", T.stamp(F.col("event_time")))
    return play.failures(rows, D2, ("event_second",))


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("parse_time", T.period_label(F.col("event_time"), "DAY"))


_DAY = "strftime(event_time, '%Y%m%d0000') as parse_time"


def _join_on(a: str, b: str) -> str:
    return " and ".join(f"{a}.{c} = {b}.{c}" for c in ("parse_time", *D5))


def _session_cells(view: str, name: str) -> str:
    cells = (f"(select parse_time, {DIMS5}, count(distinct has_id) as c from (select *, {_DAY} from {view}) "
             f"group by parse_time, {DIMS5})")
    return Q.cube(cells, D5, Q.isum("c", name), ("parse_time",))


@register("play_success_rate", Q.with_views(f"""
select f.parse_time, {', '.join('f.' + d for d in D5)}, {Q.rate4('(p.plays - f.fails)', 'p.plays')} as play_succ_rate
from f join p on {_join_on('f', 'p')} where p.plays <> 0""",
    _REPAIRED.format(view="fx_play_fail") + ", f as ("
    + Q.cube(f"(select *, {_DAY} from repaired where {TYPES})", D5, f"{ONE} as fails", ("parse_time",))
    + f"), p as ({_session_cells('fx_play', 'plays')})"))
def play_success_rate(v: Views) -> DataFrame:
    fails = E.repair_area(v.play_fail, v.terminal_info)
    return play.play_success_rate(_day(fails), _day(v.play), D5, ("parse_time",))


# ---- stall metrics ------------------------------------------------------------------------------------------------
@register("natural_buffer_rate", Q.with_views(f"""
select l.parse_time, {', '.join('l.' + d for d in D5)}, l.stalled as stalled_plays,
  case when coalesce(p.plays, 0) = 0 then 0.0 else least({Q.rate4('l.stalled', 'p.plays')}, 1.0) end as buffer_rate
from l left join p on {_join_on('l', 'p')}""",
    f"l as ({_session_cells('fx_lag', 'stalled')}), p as ({_session_cells('fx_play', 'plays')})"))
def natural_buffer_rate(v: Views) -> DataFrame:
    return stall.natural_buffer_rate(_day(v.lag), _day(v.play), D5, ("parse_time",))


@register("lag_dedup", Q.with_views(
    "select seq, has_id, probe_id, export_id, strftime(event_time, '%Y%m%d%H%M') as minute from firsts", _FIRST))
def lag_dedup(v: Views) -> DataFrame:
    return with_minute(S.first_per_minute(v.lag)).select("seq", "has_id", "probe_id", "export_id", "minute")


def _register_lag_windows() -> None:
    for minutes in (1, 15, 60):
        def plays(v: Views, minutes: int = minutes) -> DataFrame:
            return labelled(stall.stalled_plays(S.first_per_minute(v.lag), minutes), "bucket")

        register(f"lag_plays_{minutes}m", Q.with_views(Q.cube(
            f"(select *, {Q.bucket(minutes)} as bucket from firsts)", D5, "count(distinct has_id) as lag_plays",
            ("bucket",)), _FIRST))(plays)


_register_lag_windows()

_CAUSES = f"""{Q.isum("case when export_id in ('2','5','6','8','11') then 1 else 0 end", 'operator_cnt')},
  {Q.isum("case when export_id in ('15') then 1 else 0 end", 'family_cnt')},
  {Q.isum("case when export_id in ('1','9','10','12') then 1 else 0 end", 'cdn_cnt')},
  {Q.isum("case when export_id in ('3','13','14') then 1 else 0 end", 'terminal_cnt')},
  {Q.isum("case when export_id in ('2','5','6','8','11','15','1','9','10','12','3','13','14') then 1 else 0 end",
          'cause_sum')}"""


@register("lag_cause_groups", Q.with_views(Q.cube("fx_lag", D5, _CAUSES)))
def lag_cause_groups(v: Views) -> DataFrame:
    return stall.cause_groups(v.lag)


@register("lag_cause_minute", Q.with_views(Q.cube(
    f"(select *, {Q.minute()} as minute from firsts)", D5, f"{ONE} as lag_count", ("minute", "export_id")), _FIRST))
def lag_cause_minute(v: Views) -> DataFrame:
    return stall.cause_counts(with_minute(S.first_per_minute(v.lag)), D5, ("minute",))


@register("lag_cause_d6", Q.with_views(Q.cube("fx_lag", (*D5, "export_id"), f"{ONE} as lag_count")))
def lag_cause_d6(v: Views) -> DataFrame:
    return stall.cause_counts_d6(v.lag)


@register("lag_cause_series", Q.with_views(f"""
select * from ({Q.cube(f'(select *, {Q.bucket(60)} as bucket from fx_lag)', D5, _CAUSES, ('bucket',))})
qualify row_number() over (partition by {DIMS5} order by bucket desc) <= 30"""))
def lag_cause_series(v: Views) -> DataFrame:
    return labelled(stall.cause_series(v.lag), "bucket")


# ---- page metrics -------------------------------------------------------------------------------------------------
_EPG_BANDS = ", ".join(Q.isum(f"case when {c} then requests else 0 end", f"band{i}") for i, c in enumerate((
    "http_rsp_time >= 0 and http_rsp_time < 100000", "http_rsp_time >= 100000 and http_rsp_time < 300000",
    "http_rsp_time >= 300000 and http_rsp_time < 2000000", "http_rsp_time >= 2000000"), 1))


@register("epg_bands_minute", Q.with_views(Q.cube(
    f"(select *, {Q.minute()} as minute from fx_epg)", D5, _EPG_BANDS, ("minute", "page_type"))))
def epg_bands_minute(v: Views) -> DataFrame:
    return page.epg_bands(with_minute(v.epg), D5, ("minute",))


@register("epg_bands", Q.with_views(Q.cube("fx_epg", D5, _EPG_BANDS, ("page_type",))))
def epg_bands(v: Views) -> DataFrame:
    return page.epg_bands(v.epg)


@register("epg_mean_minute", Q.with_views("select * from (" + Q.cube(
    f"(select *, {Q.minute()} as minute from fx_epg)", D5, f"{Q.isum('requests', 'requests')}, "
    "cast(sum(requests * http_rsp_time) // nullif(sum(requests), 0) as bigint) as mean_rsp_time",
    ("minute", "page_type")) + ") where requests <> 0"))
def epg_mean_minute(v: Views) -> DataFrame:
    return page.epg_mean(with_minute(v.epg), D5, ("minute",))


@register("detail_load_success", Q.with_views(f"select {DIMS5}, {Q.rate4('s', 'r')} as load_succ_rate from (" + Q.cube(
    "fx_epg", D5, "sum(page_suc_cnt) as s, sum(requests) as r", (), "page_type = '3'") + ") where r <> 0"))
def detail_load_success(v: Views) -> DataFrame:
    return page.detail_load_success(v.epg)


_IMAGE = "sum(suc_cnt) as s, sum(le3s_cnt) as f, sum(requests) as r"
_IMAGE_RATES = f"{Q.rate4('s', 'r')} as succ_rate, {Q.rate4('f', 'r')} as fast_rate"


@register("image_rates_minute", Q.with_views(f"select minute, {DIMS5}, {_IMAGE_RATES} from (" + Q.cube(
    f"(select *, {Q.minute()} as minute from fx_image)", D5, _IMAGE, ("minute",)) + ") where r <> 0"))
def image_rates_minute(v: Views) -> DataFrame:
    return page.image_rates(with_minute(v.image), D5, ("minute",))


@register("image_lattice_day", Q.with_views(Q.cube(
    "(select *, strftime(event_time, '%Y%m%d') as day from fx_image)", D5, Q.isum("requests", "requests"), ("day",))))
def image_lattice_day(v: Views) -> DataFrame:
    days = v.image.withColumn("day", F.date_format("event_time", "yyyyMMdd"))
    return C.cube_all(days, D5, {"requests": ("sum", F.col("requests"))}, ("day",), lattice=True)


@register("image_rates", Q.with_views(
    f"select {DIMS5}, {_IMAGE_RATES} from ({Q.cube('fx_image', D5, _IMAGE)}) where r <> 0"))
def image_rates(v: Views) -> DataFrame:
    return page.image_rates(v.image)


# ---- network metrics ----------------------------------------------------------------------------------------------
@register("event_trend_minute", Q.with_views(Q.cube(
    f"(select *, {Q.minute()} as minute from fx_event)", D5, Q.isum("cnt", "count_sum"), ("minute", "event_id"))))
def event_trend_minute(v: Views) -> DataFrame:
    return network.event_trend(with_minute(v.event))


@register("event_trend_d6", Q.with_views(
    Q.cube("fx_event", (*D5, "event_id"), Q.isum("cnt", "count_sum"), (), EVENTS)))
def event_trend_d6(v: Views) -> DataFrame:
    return network.event_trend_d6(v.event)


@register("http_errors_d2", Q.with_views(Q.levels("fx_http_error", D2, Q.isum("cnt", "total"), ("http_rsp_code",))))
def http_errors_d2(v: Views) -> DataFrame:
    return network.http_errors(v.http_error, D2)


@register("http_errors_d5", Q.with_views(Q.cube("fx_http_error", D5, Q.isum("cnt", "total"), ("http_rsp_code",))))
def http_errors_d5(v: Views) -> DataFrame:
    return network.http_errors(v.http_error, D5)


# ---- terminal metrics ---------------------------------------------------------------------------------------------
_ONLINE = "(select distinct t.* from fx_state s join fx_terminal_info t on t.probe_id = s.probe_id where s.state <> '0')"


@register("online_users_d2", Q.with_views(Q.levels(_ONLINE, D2, "count(distinct probe_id) as online_users")))
def online_users_d2(v: Views) -> DataFrame:
    return terminal.online_users(v.state, v.terminal_info, D2)


@register("online_users_d5", Q.with_views(Q.cube(_ONLINE, D5, "count(distinct probe_id) as online_users")))
def online_users_d5(v: Views) -> DataFrame:
    return terminal.online_users(v.state, v.terminal_info, D5)


@register("terminal_count", Q.with_views(_additive("current_reports", {"terminals": "device_id"}), """
current_reports as (select * from fx_terminal_report
  qualify row_number() over (partition by probe_id order by event_time desc, seq desc) = 1)"""))
def terminal_count(v: Views) -> DataFrame:
    return terminal.terminal_count(v.terminal_report)


_REPORTS_97 = """current_reports as (select * from fx_terminal_report where event_time < timestamp '1998-01-01'
  qualify row_number() over (partition by probe_id order by event_time desc, seq desc) = 1)"""
_LEVELS_97 = _additive("current_reports", {"terminals": "device_id"})


@register("terminal_count_job", Q.with_views(
    f"select province_id as provinceID, city_id as cityID, platform, device_provider as deviceProvider, fw_version as fwVersion, "
    f"terminals as userCount, '199700000000' as parseTime, 'YEAR' as period from ({_LEVELS_97})", _REPORTS_97))
def terminal_count_job(v: Views) -> DataFrame:
    """T_TERMINAL_COUNT as its job writes it for a year, twice."""
    out = shared_path(v.spark, "terminal_count")
    for _ in range(2):
        run_terminal_count(v.terminal_report, "YEAR", "1997", out)
    return read_table(v.spark, out, "T_TERMINAL_COUNT")


@register("login_success", Q.with_views(f"select {DIMS5}, {Q.rate4('s', 'r')} as succ_rate from (" + Q.cube(
    "fx_login", D5, "sum(suc_pages) as s, sum(pages) as r") + ") where r <> 0"))
def login_success(v: Views) -> DataFrame:
    return terminal.login_success(v.login)


# ---- series -------------------------------------------------------------------------------------------------------
def _tumbling(minutes: int) -> str:
    return Q.with_views(Q.cube(f"(select *, {Q.bucket(minutes)} as bucket from fx_play_fail)", D2,
                               f"{ONE} as fail_count", ("bucket",)))


def _tumble(v: Views, minutes: int) -> DataFrame:
    rows = v.play_fail.withColumn("bucket", T.bucket_label(F.col("event_time"), minutes))
    return play.failures(rows, D2, ("bucket",))


@register("tumbling_1m", _tumbling(1))
def tumbling_1m(v: Views) -> DataFrame:
    return _tumble(v, 1)


@register("tumbling_5m", _tumbling(5))
def tumbling_5m(v: Views) -> DataFrame:
    return _tumble(v, 5)


@register("series_last30", Q.with_views(f"""
select * from ({Q.cube(f'(select *, {Q.bucket(60)} as bucket from fx_play_fail)', D2, ONE + ' as fail_count',
                       ('bucket',))})
qualify row_number() over (partition by province_id, city_id order by bucket desc) <= 30"""))
def series_last30(v: Views) -> DataFrame:
    return S.last_points(_tumble(v, 60), D2, "bucket")


def _resolutions(view: str, aggregates: str, fixed=(), dims=D5) -> str:
    parts = [f"select cast({m} as int) as resolution, * from (" + Q.cube(
        f"(select *, {Q.bucket(m)} as bucket from {view})", dims, aggregates, ("bucket", *fixed)) + ")"
        for m in (1, 15, 60)]
    return Q.with_views(" union all ".join(parts))


@register("multires_fail", _resolutions("fx_play_fail", f"{ONE} as fail_count"))
def multires_fail(v: Views) -> DataFrame:
    rows = S.multi_resolution(v.play_fail, D5, {"fail_count": ("sum", F.lit(1).cast("bigint"))})
    return labelled(rows, "bucket")


@register("multires_event", _resolutions("fx_event", Q.isum("cnt", "count_sum"), ("event_id",)))
def multires_event(v: Views) -> DataFrame:
    return labelled(network.event_resolutions(v.event), "bucket")


def _categories() -> str:
    ids = [str(i) for i in range(1, 17) if i != 5]
    groups = {"terminal": "'3','13','14','15'", "operator": "'2','4','7','10','153','154','155'",
              "cdn": "'1','6','8','9','16','151'", "family": "'11','12'"}
    columns = [Q.isum(f"case when event_id = '{i}' then cnt else 0 end", f"event{i}") for i in ids]
    columns += [Q.isum(f"case when event_id in ({m}) then cnt else 0 end", g) for g, m in groups.items()]
    return _resolutions("fx_event", ", ".join(columns))


@register("event_category", _categories())
def event_category(v: Views) -> DataFrame:
    return labelled(network.event_categories(v.event), "bucket")


_IMAGE_RES = " union all ".join(
    f"select cast({m} as int) as resolution, bucket, {', '.join(D5)}, {_IMAGE_RATES} from (" + Q.cube(
        f"(select *, {Q.bucket(m)} as bucket from fx_image)", D5, _IMAGE, ("bucket",)) + ") where r <> 0"
    for m in (1, 15, 60))


@register("multires_image", Q.with_views(_IMAGE_RES))
def multires_image(v: Views) -> DataFrame:
    return labelled(page.image_resolutions(v.image, D5), "bucket")


@register("multires_epg", _resolutions(
    "fx_epg", f"{_EPG_BANDS}, {Q.isum('requests', 'requests')}, "
    "cast(sum(requests * http_rsp_time) // nullif(sum(requests), 0) as bigint) as mean_rsp_time", ("page_type",), D5))
def multires_epg(v: Views) -> DataFrame:
    return labelled(page.epg_resolutions(v.epg, D5), "bucket")


@register("retention_filter", Q.with_views(f"""
select resolution, strftime(bucket, '%Y%m%d%H%M') as bucket, {', '.join(D2)}, fail_count from (
  select *, max(bucket) over (partition by resolution) as newest from (
    {' union all '.join(f"select cast({m} as int) as resolution, * from (" + Q.cube(
        f"(select *, time_bucket(interval '{m} minutes', event_time) as bucket from fx_play_fail)", D2,
        ONE + " as fail_count", ("bucket",)) + ")" for m in (1, 15, 60))}))
where bucket >= newest - case resolution when 1 then interval 1 hour when 15 then interval 1 day
                                         else interval 7 days end"""))
def retention_filter(v: Views) -> DataFrame:
    rows = S.multi_resolution(v.play_fail, D2, {"fail_count": ("sum", F.lit(1).cast("bigint"))})
    return labelled(S.within_retention(rows), "bucket")


@register("online_state", Q.with_views("""
select strftime(d.day, '%Y%m%d0000') as parse_time, count(*) as online_boxes from days d
join (select distinct probe_id from fx_state) b on true
where exists (select 1 from fx_state s where s.probe_id = b.probe_id and s.state <> '0'
              and date_trunc('day', s.event_time) = d.day)
   or coalesce((select arg_max(s.state, (s.event_time, s.seq)) from fx_state s where s.probe_id = b.probe_id
                and s.event_time < d.day), '0') <> '0'
group by d.day""", """days as (select unnest(generate_series(
  (select date_trunc('day', min(event_time)) from fx_state), (select date_trunc('day', max(event_time)) from fx_state),
  interval 1 day)) as day)"""))
def online_state(v: Views) -> DataFrame:
    rows = S.online_at_periods(v.state, "DAY")
    return (rows.groupBy(T.minute_label(F.col("period_start")).alias("parse_time"))
            .agg(F.count(F.lit(1)).alias("online_boxes")))


@register("terminal_changes", Q.with_views("""
select probe_id, device_id, fw_version, seq, strftime(event_time, '%Y%m%d%H%M') as event_time from (
  select *, lag(fw_version) over w as before, row_number() over w as n from fx_terminal_report
  window w as (partition by probe_id order by event_time, seq))
where n = 1 or before is distinct from fw_version"""))
def terminal_changes(v: Views) -> DataFrame:
    columns = ["device_id", *D5]
    changes = S.changed_records(v.terminal_report, "probe_id", columns, ("event_time", "seq"))
    return labelled(changes.select("probe_id", "device_id", "fw_version", "seq", "event_time"), "event_time")


@register("online_users_hour", Q.with_views(f"""
select * from ({Q.cube(
    f"(select distinct t.*, {Q.bucket(60, 's.event_time')} as bucket from fx_state s "
    "join fx_terminal_info t on t.probe_id = s.probe_id where s.state <> '0')", D2,
    "count(distinct probe_id) as online_users", ("bucket",))}) where province_id <> 'ALL' and city_id = 'ALL'
qualify rank() over (partition by province_id, city_id order by bucket desc) = 1"""))
def online_users_hour(v: Views) -> DataFrame:
    states = v.state.withColumn("bucket", T.bucket_label(F.col("event_time"), 60))
    return S.hour_slice(terminal.online_users(states, v.terminal_info, D2, ("bucket",)), "bucket")


_LAG_MINUTES = Q.cube(f"(select *, {Q.minute()} as index_time from fx_lag)", D2, f"{ONE} as lag_count", ("index_time",))


@register("series_json", Q.with_views(
    f"select province_id, city_id, index_time, lag_count from ({_LAG_MINUTES}) "
    "qualify row_number() over (partition by province_id, city_id order by index_time desc) <= 30"))
def series_json(v: Views) -> DataFrame:
    rows = v.lag.withColumn("index_time", T.minute_label(F.col("event_time")))
    points = C.cube_all(rows, D2, {"lag_count": ("sum", F.lit(1).cast("bigint"))}, ("index_time",))
    lists = S.json_lists(S.last_points(points, D2), D2, ("index_time", "lag_count"))
    decoded = X.json_points(F.col("points"), "index_time string, lag_count bigint")
    return lists.select(*D2, F.inline(decoded))
