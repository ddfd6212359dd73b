"""Registered queries that pass the sample tables through files or a stream.

Each runs its stream over the whole table to the end (``availableNow``) below the shared folder of the session and
returns the committed rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.queries import _DAMAGE, _FIRST, _PARSED, _STRICT, D2, D5, DIMS5, ONE, _parsed_columns, register
from catalog.views import Views, raw_lines, write_sequence_files
from viewpulse.functions import timecols as T
from viewpulse.model import RESOLUTIONS
from viewpulse.operators import cube as C
from viewpulse.operators import parse as P
from viewpulse.session import shared_path, shuffles_removed
from viewpulse.sinks.keyed import BucketTable
from viewpulse.sources import logs, streams
from viewpulse.streaming import jobs as J
from viewpulse.streaming import merging as M
from viewpulse.streaming import presence as PR
from viewpulse.streaming import state as ST
from viewpulse.streaming import windows as W

NOW = J.Trigger()


class StreamViews(Views):
    """The log views with one base table read as a stream."""

    def __init__(self, views: Views, streamed: str):
        super().__init__(views.spark, views.sf_dir)
        self.streamed = streamed

    def table(self, name: str) -> DataFrame:
        if name == self.streamed:
            return streams.table_rows(self.spark, self.sf_dir, f"{name}.parquet")
        return super().table(name)


def committed(v: Views, rows: DataFrame, name: str) -> DataFrame:
    root = shared_path(v.spark, name)
    J.commit_rows(rows, root, name, NOW).awaitTermination()
    return v.spark.read.parquet(f"{root}/{name}")


_EVENT_ROWS = Q.with_views("select seq, {} from fx_event where {}".format(
    _PARSED["event"], " and ".join(f"not ({_DAMAGE[d]})" for d in ("type", "length", *_STRICT["event"]))))


@register("stream_source", _EVENT_ROWS)
def stream_source(v: Views) -> DataFrame:
    lines = StreamViews(v, "events").raw_lines("event")
    rows = P.parse_valid(lines, "event")
    return committed(v, rows, "stream_source").select("seq", *_parsed_columns(v, "event"))


#: bytes read per file of a micro-batch: as many tasks write and read it as it has files
ARRIVAL_BYTES = 4 * 1024 * 1024


def files_of(rows: DataFrame, parts: int) -> int:
    """Files of a micro-batch that holds one of ``parts`` equal shares of the rows."""
    return max(1, -(-C.read_bytes(rows) // (parts * ARRIVAL_BYTES)))


def arrivals(v: Views, rows: DataFrame, parts: int = 3) -> DataFrame:
    """All rows as a stream of several micro-batches in no order of time: most rows come late."""
    root, files = shared_path(v.spark, "arrivals"), files_of(rows, parts)
    with shuffles_removed(v.spark):
        rows.repartition(parts * files).write.parquet(root)
    return streams.table_rows(v.spark, root, max_files=files)


def merged(v: Views, job: M.MergeJob, rows: DataFrame, table: str, resolutions=None) -> DataFrame:
    """A merging job over :func:`arrivals` and what it has published in the end."""
    root = shared_path(v.spark, "merged")
    M.merging_query(v.spark, job, arrivals(v, rows), root, "job", NOW.options(), resolutions).awaitTermination()
    return J.merged_table(v.spark, root, table).withColumn("bucket", T.minute_label(F.col("bucket")))


@register("stream_progress", "select cast(count(*) as bigint) as input_rows, cast(8 as bigint) as batches from events")
def stream_progress(v: Views) -> DataFrame:
    root = shared_path(v.spark, "stream_progress")
    log = streams.ProgressLog(v.spark)
    query = J.commit_rows(arrivals(v, v.table("events"), 8), root, "progress", NOW)
    query.awaitTermination()
    found = log.report(query).agg(F.sum("input_rows").alias("input_rows"), F.sum("batches").alias("batches"))
    log.close()
    return found


@register("read_log_seqfile", _EVENT_ROWS.replace("select seq, ", "select "))
def read_log_seqfile(v: Views) -> DataFrame:
    path = f"{shared_path(v.spark, 'seqfile')}/2024/01/01/log-00-all"
    write_sequence_files(v.raw_lines("event"), path)
    lines = logs.read_period_files(v.spark, path.split("/2024/")[0], "log", "HOUR", datetime(2024, 1, 1))
    return P.parse_valid(lines, "event").select(*_parsed_columns(v, "event"))


@register("period_scan", Q.with_views("""
select event_id, cast(count(*) as bigint) as n, cast(sum(cnt) as bigint) as count_sum from fx_event
where event_time >= timestamp '2024-01-15' and event_time < timestamp '2024-01-22' group by event_id"""))
def period_scan(v: Views) -> DataFrame:
    path = f"{shared_path(v.spark, 'log_table')}/event"
    logs.write_log_table(v.event, path, "all", None)
    week = logs.read_log_table(v.spark, path, "WEEK", datetime(2024, 1, 17))
    return week.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("count_sum"))


def _ingested(log: str) -> str:
    good = " and ".join(f"not ({_DAMAGE[d]})" for d in ("type", "length", *_STRICT[log]))
    return Q.with_views(f"select {_PARSED[log]} from fx_{log} where {good}")


def ingested(v: Views, log: str) -> DataFrame:
    """Raw lines of one day's files through the ingest into the log table, and back as that day's rows."""
    root = shared_path(v.spark, f"ingest_{log}")
    write_sequence_files(v.raw_lines(log), f"{root}/raw/2024/01/17")
    day = datetime(2024, 1, 17)
    logs.ingest_period(v.spark, f"{root}/raw", log, log, "DAY", day, f"{root}/table", f"{root}/rejected")
    return logs.read_log_table(v.spark, f"{root}/table", "DAY", day).select(*_parsed_columns(v, log))


@register("ingest_login", _ingested("login"))
def ingest_login(v: Views) -> DataFrame:
    return ingested(v, "login")


@register("ingest_http_error", _ingested("http_error"))
def ingest_http_error(v: Views) -> DataFrame:
    return ingested(v, "http_error")


def _hours(*hours: int) -> str:
    good = " and ".join(f"not ({_DAMAGE[d]})" for d in ("type", "length", *_STRICT["event"]))
    return Q.with_views(f"""select hour(event_time) as hour, {ONE} as n, {Q.isum('cnt', 'count_sum')} from fx_event
      where {good} and hour(event_time) in ({', '.join(map(str, hours))}) group by 1""")


@register("ingest_two_hours", _hours(10, 11))
def ingest_two_hours(v: Views) -> DataFrame:
    """The files of two hours, one after the other, into one log table; the hours come from the times of the rows."""
    root = shared_path(v.spark, "two_hours")
    rows = v.records("event")
    for hour in (10, 11):
        write_sequence_files(raw_lines(rows.where(F.hour("event_time") == hour), "event"), f"{root}/raw/2024/01/17/event-{hour}-all")
        logs.ingest_period(v.spark, f"{root}/raw", "event", "event", "HOUR", datetime(2024, 1, 17, hour), f"{root}/table", f"{root}/rejected")
    table = logs.read_log_table(v.spark, f"{root}/table")
    return table.groupBy(F.hour("event_time").alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("count_sum"))


@register("ingest_straggler", Q.with_views(f"""
select strftime(event_time, '%Y%m%d%H') as hour, {ONE} as n, {Q.isum('cnt', 'count_sum')} from fx_event group by 1"""))
def ingest_straggler(v: Views) -> DataFrame:
    """Two units, each with rows of the other's hours; the first is written a second time."""
    path = f"{shared_path(v.spark, 'ingest_straggler')}/event"
    rows = v.event
    first = F.when(F.col("seq") % 50 == 0, F.hour("event_time") >= 12).otherwise(F.hour("event_time") < 12)
    for unit, part in (("first", first), ("second", ~first), ("first", first)):
        logs.write_log_table(rows.where(part), path, unit, None)
    table = logs.read_log_table(v.spark, path)
    return table.groupBy(F.date_format("event_time", "yyyyMMddHH").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("count_sum"))


@register("ingest_no_time", Q.with_views(f"""
select year(event_time) as year, page_type, {ONE} as n, {Q.isum('requests', 'requests')} from fx_epg
where not (seq % 13 = 0 or seq % 17 = 0 or seq % 19 = 0 or seq % 23 = 0) group by all"""))
def ingest_no_time(v: Views) -> DataFrame:
    """Every third line has no time and counts in the year of its files; other times are cut to the month (few folders)."""
    path = f"{shared_path(v.spark, 'ingest_no_time')}/epg"
    ends = v.epg.agg(F.min(F.year("event_time")).alias("low"), F.max(F.year("event_time")).alias("high")).first()
    years = range(ends["low"], ends["high"] + 1)
    found = None
    blank = v.epg.withColumn("year", F.year("event_time")).withColumn(
        "event_time", F.when(F.col("seq") % 3 != 0, F.date_trunc("month", "event_time").cast("timestamp_ntz")))
    for year in years:
        logs.ingest(raw_lines(blank.where(F.col("year") == year), "epg"), "epg", path, str(year), datetime(year, 1, 1))
    for year in years:
        rows = logs.read_log_table(v.spark, path, "YEAR", datetime(year, 6, 1)).withColumn("year", F.lit(year))
        found = rows if found is None else found.unionByName(rows)
    return found.groupBy("year", "page_type").agg(F.count(F.lit(1)).alias("n"), F.sum("requests").alias("requests"))


def _fail_cube(minutes: int, dims, where: str = "true") -> str:
    return Q.cube(f"(select *, {Q.bucket(minutes)} as bucket from fx_play_fail)", dims, f"{ONE} as fail_count", ("bucket",), where)


@register("stream_tumbling_5m", Q.with_views(_fail_cube(5, D2)))
def stream_tumbling_5m(v: Views) -> DataFrame:
    job = J.additive_job({"fail_count": ("sum", F.lit(1).cast("bigint"))}, lambda cells: {
        "fails": C.cube_all(cells, D2, {"fail_count": ("sum", F.col("fail_count"))}, ("bucket",))}, (), D2, 5, (5,))
    return merged(v, job, v.play_fail, "fails")


@register("stream_late_merged", Q.with_views(_fail_cube(60, D5)))
def stream_late_merged(v: Views) -> DataFrame:
    """The failure job with every arrival out of order: late rows are in their stored bucket at the end."""
    return merged(v, J.merge_jobs("play_fail")["play_fail"], v.play_fail, "play_fail_60m", (60,))


@register("stream_retention", Q.with_views(" union all ".join(
    f"select {m} as resolution, * from ({_fail_cube(m, D2)}) where strptime(bucket, '%Y%m%d%H%M') >= "
    f"(select max(time_bucket(interval '{m} minutes', event_time)) from fx_play_fail) - interval {keep}" for m, keep in RESOLUTIONS.items())))
def stream_retention(v: Views) -> DataFrame:
    """The failure tables with retention, rows in order of time, folded at the end as a running job does."""
    root = shared_path(v.spark, "retention")
    rows, files = v.play_fail, files_of(v.play_fail, 2)
    ends = rows.agg(F.min("event_time").alias("low"), F.max("event_time").alias("high")).first()
    middle = ends["low"] + (ends["high"] - ends["low"]) * 2 / 3
    for part in (rows.where(F.col("event_time") < F.lit(middle)), rows.where(F.col("event_time") >= F.lit(middle))):
        part.repartition(files).write.mode("append").parquet(f"{root}/in")
    M.merging_query(v.spark, J.merge_jobs("play_fail")["play_fail"], streams.table_rows(v.spark, f"{root}/in", max_files=files), root,
                    "fails", NOW.options(), None, RESOLUTIONS).awaitTermination()
    found = None
    for minutes, keep in RESOLUTIONS.items():
        table = BucketTable(v.spark, f"{root}/realtime_play_fail_d2_{minutes}m")
        table.compact(None, M.retained(table.read(), keep))
        own = table.read().withColumn("resolution", F.lit(minutes))
        found = own if found is None else found.unionByName(own)
    return found.withColumn("bucket", T.minute_label(F.col("bucket")))


@register("stream_distinct_users", Q.with_views(Q.cube(
    f"(select *, {Q.bucket(1440)} as bucket from fx_play)", D2, "count(distinct probe_id) as play_users", ("bucket",))))
def stream_distinct_users(v: Views) -> DataFrame:
    """State holds the boxes of each finest cell once; levels are counted from these."""
    def pairs(rows: DataFrame) -> DataFrame:
        return C.no_null_dims(rows, D2).where("probe_id is not null").select("bucket", *D2, "probe_id").distinct()
    job = M.MergeJob(1440, pairs, pairs, lambda current, buckets, m: {
        "users": C.exact_distinct_cube(M.within(current, buckets, m), D2, "play_users", "probe_id", ("bucket",))}, (1440,))
    return merged(v, job, v.play, "users")


@register("stream_http_errors", Q.with_views(Q.cube(
    f"(select *, {Q.bucket(5)} as bucket from fx_http_error)", D2, Q.isum("cnt", "total"), ("bucket", "http_rsp_code"))))
def stream_http_errors(v: Views) -> DataFrame:
    return merged(v, J.merge_jobs("http_error")["http_error"], v.http_error, "http_error")


_FIRST_STALLS = """firsts as (select * from fx_lag qualify row_number() over (
  partition by date_trunc('minute', event_time), has_id, probe_id order by event_time, export_id, province_id, city_id, platform,
    device_provider, fw_version) = 1)"""


@register("stream_lag_plays", Q.with_views(Q.cube(
    f"(select *, {Q.bucket(60)} as bucket from firsts)", D5, "count(distinct has_id) as lag_plays", ("bucket",)), _FIRST_STALLS))
def stream_lag_plays(v: Views) -> DataFrame:
    return merged(v, J.merge_jobs("lag")["lag"], v.lag, "lag_plays_60m", (60,))


@register("stream_lag_causes", Q.with_views("select * from (" + Q.cube(
    f"(select *, {Q.bucket(60)} as bucket from firsts)", D5, f"{ONE} as lag_count", ("bucket", "export_id"))
    + ")", _FIRST_STALLS))
def stream_lag_causes(v: Views) -> DataFrame:
    """Causes that occur; the table has zero rows for the others."""
    return merged(v, J.merge_jobs("lag")["lag"], v.lag, "lag_cause_60m", (60,)).where("lag_count > 0")


_LATEST_5M = f"""latest as (select distinct {Q.bucket(5)} as bucket, has_id, probe_id, {DIMS5}, event_time from fx_play_request
  qualify rank() over (partition by {Q.bucket(5)}, has_id order by event_time desc) = 1)"""


@register("stream_users_plays", Q.with_views(
    "select * from (" + Q.cube("latest", D2, "count(distinct probe_id) as play_users, count(distinct has_id) as plays", ("bucket",))
    + ") where plays > 0", _LATEST_5M))
def stream_users_plays(v: Views) -> DataFrame:
    return merged(v, J.merge_jobs("play_request")["play_request"], v.play_request, "users_plays")


@register("stream_lag_dedup", Q.with_views(
    f"select has_id, probe_id, {Q.minute()} as minute from firsts", _FIRST))
def stream_lag_dedup(v: Views) -> DataFrame:
    rows = W.first_per_minute(W.with_watermark(StreamViews(v, "events").lag))
    kept = committed(v, rows.select("has_id", "probe_id", "event_time"), "lag_first")
    return kept.select("has_id", "probe_id", T.minute_label(F.col("event_time")).alias("minute"))


_BOX_CELLS = f"""
cells as (select {Q.bucket(60)} as bucket, probe_id, bool_or(state <> '0') as seen_on,
                 arg_max(state, (event_time, seq)) <> '0' as now_on from fx_state group by all),
linked as (select *, coalesce(lag(now_on) over (partition by probe_id order by bucket), false) as was_on from cells),
changes as (select bucket, probe_id, cast(seen_on and not was_on as bigint) as newly_on,
                   cast(now_on as bigint) - cast(was_on as bigint) as net
            from linked where (seen_on and not was_on) or now_on <> was_on)"""


@register("stream_online_state", Q.with_views("select * from changes", _BOX_CELLS))
def stream_online_state(v: Views) -> DataFrame:
    """Changes per window and box with every arrival out of order."""
    root = shared_path(v.spark, "presence")
    PR.presence_query(v.spark, arrivals(v, v.state), root, NOW.options(), None, 60, (), ("event_time", "seq")).awaitTermination()
    return PR.PresenceTables(v.spark, root, ()).changes.read().withColumn("bucket", T.minute_label(F.col("bucket")))


_BOX_COUNTS = _BOX_CELLS + f""",
rolled as ({Q.cube("(select c.*, t.province_id, t.city_id from changes c join fx_terminal_info t on t.probe_id = c.probe_id)",
                   D2, f"{Q.isum('newly_on', 'newly_on')}, {Q.isum('net', 'net')}", ("bucket",))}),
summed as (select *, sum(net) over (partition by province_id, city_id order by bucket
                                    rows between unbounded preceding and current row) as held from rolled),
counted as (select bucket, province_id, city_id, cast(held - net + newly_on as bigint) as online_users, cast(held as bigint) as stay_on
            from summed)"""


def presence(v: Views, retention: str | None = None, parts: int = 3) -> str:
    """Folder of the state job run over all rows: out of order, or in the order of time where there is a retention."""
    root = shared_path(v.spark, "presence")
    if retention:
        ends = v.state.agg(F.min("event_time").alias("low"), F.max("event_time").alias("high")).first()
        rest, files = v.state, files_of(v.state, parts)
        for part in range(parts):
            until = F.lit(ends["low"] + (ends["high"] - ends["low"]) * (part + 1) / parts)
            own = F.col("event_time") <= until
            rest.where(own).repartition(files).write.mode("append").parquet(f"{root}/in")
            rest = rest.where(~own)
        stream = streams.table_rows(v.spark, f"{root}/in", max_files=files)
    else:
        stream = arrivals(v, v.state, parts)
    PR.presence_query(v.spark, stream, root, NOW.options(), v.terminal_info, 60, D2, ("event_time", "seq"), retention).awaitTermination()
    return root


@register("stream_online_counts", Q.with_views("select * from counted", _BOX_COUNTS))
def stream_online_counts(v: Views) -> DataFrame:
    """Boxes on per window and area with every arrival out of order: late records move the counts of later windows too."""
    return PR.current_online(v.spark, presence(v)).withColumn("bucket", T.minute_label(F.col("bucket")))


@register("stream_hour_slice", Q.with_views("""
select n.bucket, province_id, city_id, cast(sum(case when r.bucket = n.bucket then newly_on else net end) as bigint) as online_users,
       cast(sum(net) as bigint) as stay_on
from rolled r, (select max(c.bucket) as bucket from cells c join fx_terminal_info t on t.probe_id = c.probe_id) n
where province_id <> 'ALL' and city_id = 'ALL' group by all""", _BOX_COUNTS))
def stream_hour_slice(v: Views) -> DataFrame:
    """The newest window of all provinces from kept windows and carried sums alone."""
    root = presence(v, "1 day")
    tables = PR.PresenceTables(v.spark, root)
    tables.fold(None, tables.floor(None, "1 day", 60), 1)
    return PR.current_slice(v.spark, root).withColumn("bucket", T.minute_label(F.col("bucket")))


_GROWTH = f"""
cells as (select time_bucket(interval 1 day, event_time) as b, {', '.join(D2)}, has_id, has_type,
                 max(down_bytes) as down_bytes, max(play_seconds) as play_seconds from fx_play_request group by all),
sessions as (select b, has_id, has_type, max(down_bytes) as d, max(play_seconds) as p from cells group by all),
prior as (select *, lag(b) over w as b0, lag(d) over w as d0, lag(p) over w as p0 from sessions
          window w as (partition by has_id, has_type order by b))"""


@register("stream_increments", Q.with_views(f"""
select strftime(c.b, '%Y%m%d%H%M') as bucket, {', '.join('c.' + d for d in D2)}, c.has_id, c.has_type,
  cast(c.down_bytes - case when c.b - q.b0 < interval 2 days then q.d0 else 0 end as bigint) as down_bytes_delta,
  cast(c.play_seconds - case when c.b - q.b0 < interval 2 days then q.p0 else 0 end as bigint) as play_seconds_delta
from cells c join prior q on q.has_id = c.has_id and q.has_type = c.has_type and q.b = c.b""", _GROWTH))
def stream_increments(v: Views) -> DataFrame:
    job = J.growth_job(1440, 2 * 86_400, lambda grown: {"increments": grown.drop(*ST.COUNTERS)})
    return merged(v, job, v.play_request, "increments")


_SLICES = """sliced as (select *, (seq - min(seq) over ()) * 4 // (max(seq) over () - min(seq) over () + 1)
    + case when seq % 50 = 0 then 1 else 0 end as part
  from fx_play_fail)"""


@register("late_rows", Q.with_views("""
select seq, probe_id, strftime(event_time, '%Y%m%d%H%M') as event_time from sliced s
where event_time < (select max(event_time) from sliced e where e.part < s.part) - interval 1 hour""", _SLICES))
def late_rows(v: Views) -> DataFrame:
    root = shared_path(v.spark, "late")
    rows = v.play_fail
    ends = rows.agg(F.min("seq").alias("low"), F.max("seq").alias("high")).first()
    width = ends["high"] - ends["low"] + 1
    late = F.when(F.col("seq") % 50 == 0, 1).otherwise(0)
    arrival = F.floor((F.col("seq") - ends["low"]) * 4 / width) + late
    for part in range(5):  # all rows in five arrivals, every 50th row one arrival later
        rows.where(arrival == part).repartition(4, "seq").write.mode("append").parquet(f"{root}/in")
    stream = streams.table_rows(v.spark, f"{root}/in", max_files=4)
    J.late_query(v.spark, stream, root, "1 hour", NOW).awaitTermination()
    late = v.spark.read.parquet(f"{root}/late")
    return late.select("seq", "probe_id", T.minute_label(F.col("event_time")).alias("event_time"))
