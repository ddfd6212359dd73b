"""Streaming jobs, one per log.

Logs whose results come from sums, maxima, first or latest records run as :mod:`merging` jobs: the log is read once for all
resolutions, late rows are merged into their bucket, and every micro-batch publishes what it has touched.  On/off states of
boxes run as the job of :mod:`presence`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.streaming import StreamingQuery

from viewpulse.functions.timecols import minute_label
from viewpulse.model import D2, D5, LOGS, PERIOD_TTL_S, RESOLUTIONS, TERMINAL_INFO_COLUMNS
from viewpulse.operators.cube import Measures, cube_all, exact_distinct_cube, no_null_dims
from viewpulse.operators.enrich import enrich_terminal, latest_per_session, one_per_key
from viewpulse.operators.parse import parse_valid
from viewpulse.operators.series import cell_increments, last_points
from viewpulse.plans import network, page, play, stall, terminal
from viewpulse.sinks.keyed import BucketTable, KeyedTable, few
from viewpulse.streaming import merging as M
from viewpulse.streaming import state as ST
from viewpulse.streaming import windows as W
from viewpulse.streaming.presence import presence_query

Publish = Callable[[DataFrame], Mapping[str, DataFrame]]
BUCKET = ("bucket",)
#: micro-batches after which a keyed table is folded
FOLD = 50


@dataclass(frozen=True)
class Trigger:
    """``interval`` such as "5 minutes", or everything available once when it is None."""

    interval: str | None = None

    def options(self) -> dict:
        return {"processingTime": self.interval} if self.interval else {"availableNow": True}


def log_rows(lines: DataFrame, log: str, watermark: str = W.WATERMARK) -> DataFrame:
    """Valid rows of a line stream; logs without a time of their own carry the time they came in."""
    rows = parse_valid(lines, log)
    if "event_time" not in LOGS[log].fields:
        rows = rows.withColumn("event_time", F.col("ingest_time"))
    return W.with_watermark(rows, watermark)


def commit_rows(rows: DataFrame, root: str, name: str, trigger: Trigger) -> StreamingQuery:
    """First hop: append rows to ``root/name`` exactly once."""
    return (rows.writeStream.queryName(name).outputMode("append").format("parquet")
            .option("path", f"{root}/{name}").option("checkpointLocation", f"{root}/_checkpoints/{name}")
            .trigger(**trigger.options()).start())


def publish_rows(rows: DataFrame, root: str, name: str, publish: Publish, trigger: Trigger,
                 mode: str = "append") -> StreamingQuery:
    """Second hop: every result of a micro-batch goes to its own folder, which a replay overwrites."""
    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for table, result in publish(batch).items():
                result.write.mode("overwrite").parquet(f"{root}/realtime_{table}/level=delta/batch={number}")
        finally:
            batch.unpersist()

    return (rows.writeStream.queryName(name).outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", f"{root}/_checkpoints/{name}").trigger(**trigger.options()).start())


def late_query(spark: SparkSession, rows: DataFrame, root: str, delay: str, trigger: Trigger,
               name: str = "late") -> StreamingQuery:
    """Keep the rows that come in more than ``delay`` behind the newest time of earlier micro-batches.

    Windows drop such rows silently; here they are stored per micro-batch.  The newest time so far is stored as one row
    per micro-batch, and a replay looks at the batch before it, so it repeats its result.
    """
    newest = KeyedTable(spark, f"{root}/{name}_newest", ["event_time"])

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            earlier = newest.before(number)
            before = earlier.first()[0] if earlier is not None else None
            known = F.lit(before).cast("timestamp")
            running = F.greatest(F.max("event_time").cast("timestamp"), known)
            newest.write_batch(batch.agg(running.alias("event_time")).coalesce(1), number)
            late = W.late_rows(batch, known - F.expr(f"interval {delay}"))
            late.write.mode("overwrite").parquet(f"{root}/{name}/level=delta/batch={number}")
        finally:
            batch.unpersist()

    return (rows.writeStream.queryName(name).foreachBatch(write)
            .option("checkpointLocation", f"{root}/_checkpoints/{name}").trigger(**trigger.options()).start())


def realtime_table(spark: SparkSession, root: str, table: str, keys: Iterable[str]) -> DataFrame:
    """Current rows of a published table."""
    return KeyedTable(spark, f"{root}/realtime_{table}", list(keys)).read()


def realtime_series(spark: SparkSession, root: str, table: str, keys: Iterable[str], n: int = 30) -> DataFrame:
    """Newest points per series of a published table."""
    series = list(keys)
    return last_points(realtime_table(spark, root, table, [*series, "bucket"]), series, "bucket", n)


# ---- additive logs: minute cells, then resolutions ------------------------------------------------------------------
def _sums(names: Iterable[str]) -> Measures:
    return {name: ("sum", F.col(name)) for name in names}


def _fail_tables(cells: DataFrame) -> Mapping[str, DataFrame]:
    return {"play_fail": cube_all(cells, D5, _sums(["fail_count"]), BUCKET),
            "play_fail_d2": cube_all(cells, D2, _sums(["fail_count"]), BUCKET)}


def _event_tables(cells: DataFrame) -> Mapping[str, DataFrame]:
    trend = cube_all(cells, D5, _sums(["cnt"]), (*BUCKET, "event_id")).withColumnRenamed("cnt", "count_sum")
    return {"event": trend, "event_category": cube_all(cells, D5, network.category_measures(), BUCKET)}


def _image_tables(cells: DataFrame) -> Mapping[str, DataFrame]:
    return {"image": page.with_image_rates(cube_all(cells, D5, _sums(["requests", "suc", "le3s"]), BUCKET))}


def _epg_tables(cells: DataFrame) -> Mapping[str, DataFrame]:
    bands = [f"band{i}" for i in range(1, 5)]
    sums = cube_all(cells, D5, _sums([*bands, "rsp_sum", "requests"]), (*BUCKET, "page_type"))
    kept = (*BUCKET, "page_type", *D5)
    return {"epg_bands": sums.select(*kept, *bands), "epg_mean": page.with_epg_mean(sums.select(*kept, "rsp_sum", "requests"))}


def additive_job(measures: Measures, tables: Callable[[DataFrame], Mapping[str, DataFrame]], fixed: Iterable[str] = (),
                 dims: Iterable[str] = D5, minutes: int = 1, resolutions: Iterable[int] = tuple(RESOLUTIONS)) -> M.MergeJob:
    """Sums per cell; a late row is one more summand of its stored bucket."""
    keys = (*BUCKET, *fixed, *dims)

    def cells(rows: DataFrame) -> DataFrame:
        return no_null_dims(rows, list(dims)).groupBy(*keys).agg(*[F.sum(value).alias(name) for name, (_, value) in measures.items()])

    def merge(stored: DataFrame) -> DataFrame:
        return stored.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])

    return M.MergeJob(minutes, cells, merge, lambda current, buckets, m: tables(M.within(current, buckets, m)), tuple(resolutions))


# ---- stall behaviour ------------------------------------------------------------------------------------------------
_STALL = ("event_time", "export_id", *D5)


def _first_stalls(rows: DataFrame) -> DataFrame:
    """First record per minute, session and box, whichever micro-batch brings it."""
    first = rows.groupBy(*BUCKET, "has_id", "probe_id").agg(F.min(F.struct(*_STALL)).alias("_first"))
    return first.select(*BUCKET, "has_id", "probe_id", *[F.col("_first")[c].alias(c) for c in _STALL])


def _stall_tables(current: DataFrame, buckets: DataFrame, minutes: int) -> Mapping[str, DataFrame]:
    first = M.within(current, buckets, minutes)
    plays = exact_distinct_cube(first, D5, "lag_plays", "has_id", BUCKET)
    return {"lag_plays": plays, "lag_cause": stall.dense_cause_counts(first, D5, BUCKET)}


# ---- play requests --------------------------------------------------------------------------------------------------
_PLAY = ("has_id", "probe_id", *D5, "has_type", "freeze_time", "down_seconds", "latency", "play_seconds",
         "down_bytes", "event_time")


def _latest_plays(rows: DataFrame) -> DataFrame:
    """Latest record per session and window; state is bounded by sessions and the ties of their last moments."""
    return latest_per_session(rows.select(*BUCKET, *_PLAY), True, ("bucket", "has_id"))


def play_tables(latest: DataFrame) -> Mapping[str, DataFrame]:
    """Indicators of the latest record per session and window."""
    minute = latest.withColumn("minute", minute_label(F.col("event_time")))
    stalls = play.stall_distribution(latest, D2, BUCKET)
    return {"users_plays": play.users_and_plays(latest, D2, BUCKET),
            "first_frame": play.first_frame(minute, D5, ("bucket", "minute")),
            "stall": play.stall_health(stalls)}


def growth_tables(batch: DataFrame) -> Mapping[str, DataFrame]:
    return {"traffic": play.traffic(batch, D2, BUCKET), "service_time": play.service_online_time(batch, D2, BUCKET)}


def growth_job(minutes: int = 5, ttl: int = PERIOD_TTL_S["RT"],
               tables: Callable[[DataFrame], Mapping[str, DataFrame]] = growth_tables) -> M.MergeJob:
    """Growth of cumulative counters: maxima per window, session and area.

    A window subtracts the one before it, if that is younger than ``ttl`` seconds; so a late row also changes the windows up to
    ``ttl`` after its own, and these are published again.
    """
    keys = (*BUCKET, *D2, "has_id", "has_type")

    def maxima(rows: DataFrame) -> DataFrame:
        return no_null_dims(rows, D2).groupBy(*keys).agg(*[F.max(c).alias(c) for c in ST.COUNTERS])

    def publish(current: DataFrame, buckets: DataFrame, minutes: int) -> Mapping[str, DataFrame]:
        def around(first: int) -> DataFrame:
            steps = F.explode(F.sequence(F.lit(first), F.lit(ttl - 1), F.lit(minutes * 60)))
            return buckets.select("bucket", steps.alias("_step")).select(
                F.timestamp_seconds(F.unix_seconds("bucket") + F.col("_step")).alias("bucket")).distinct()
        near, changed = few(around(-ttl)), few(around(0))
        cells = current.join(near, "bucket", "left_semi").withColumn("_period", F.unix_seconds("bucket"))
        grown = cell_increments(cells, D2, ST.COUNTERS, ttl).withColumnRenamed("period_start", "bucket")
        return tables(grown.join(changed, "bucket", "left_semi"))

    def merge(stored: DataFrame) -> DataFrame:
        """Cells lie by session, as the increments need them; a micro-batch has stored one row per key."""
        return maxima(stored.repartition("has_id", "has_type"))

    return M.MergeJob(minutes, maxima, merge, publish, (minutes,))


def merge_jobs(log: str) -> Mapping[str, M.MergeJob]:
    """Merging jobs of a log by name; built on first use, as measures need a session."""
    builders = {
        "play_fail": lambda: {"play_fail": additive_job({"fail_count": ("sum", F.lit(1).cast("bigint"))}, _fail_tables)},
        "event": lambda: {"event": additive_job({"cnt": ("sum", F.col("cnt"))}, _event_tables, ("event_id",))},
        "image": lambda: {"image": additive_job(page.image_measures(), _image_tables)},
        "epg": lambda: {"epg": additive_job({**page.band_measures(), **page.mean_measures()}, _epg_tables, ("page_type",))},
        "http_error": lambda: {"http_error": additive_job({"cnt": ("sum", F.col("cnt"))}, lambda cells: {
            "http_error": network.http_errors(cells, D2, BUCKET)}, ("http_rsp_code",), D2, 5, (5,))},
        "lag": lambda: {"lag": M.MergeJob(1, _first_stalls, _first_stalls, _stall_tables)},
        "play_request": lambda: {
            "play_request": M.MergeJob(5, _latest_plays, _latest_plays,
                                       lambda current, buckets, m: play_tables(M.within(current, buckets, m, 5)), (5,)),
            "play_growth": growth_job()},
    }
    return builders[log]() if log in builders else {}


def merged_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Current rows of a table that a merging job publishes."""
    return BucketTable(spark, f"{root}/realtime_{table}").read()


# ---- boxes ----------------------------------------------------------------------------------------------------------
def changed_terminals(batch: DataFrame, table: KeyedTable, number: int | None = None) -> DataFrame:
    """Last report per box of a micro-batch where it differs from the one stored before micro-batch ``number``."""
    columns = [c for c in TERMINAL_INFO_COLUMNS if c != "probe_id"]
    order = [F.col("ingest_time")] if "ingest_time" in batch.columns else []
    latest = one_per_key(batch, "probe_id", columns, [*order, *[F.col(c) for c in columns]])
    if not table.exists(number):
        return latest
    # only the boxes of this batch matter: the stored table is cut down before it is compared
    stored = table.read(number).join(latest.select("probe_id"), "probe_id", "left_semi")
    record = F.struct(*columns)
    before = stored.select("probe_id", record.alias("_stored"))
    return (latest.join(before, "probe_id", "left")
            .where(~record.eqNullSafe(F.col("_stored"))).select("probe_id", *columns))


def terminal_query(spark: SparkSession, lines: DataFrame, root: str, trigger: Trigger) -> StreamingQuery:
    """Slowly changing terminal table, and the terminal count of the table after every micro-batch.

    A replay compares with the batches before its own and so writes the same changes again; every :data:`FOLD`
    micro-batches the earlier ones are folded.
    """
    def write(batch: DataFrame, number: int) -> None:
        table = KeyedTable(spark, f"{root}/terminal_info", ["probe_id"])
        table.compact_every(FOLD, number)
        table.write_batch(changed_terminals(batch, table, number), number)
        counts = count_terminals(table.read(number + 1))
        counts.write.mode("overwrite").parquet(f"{root}/realtime_terminal_count/level=delta/batch={number}")

    rows = parse_valid(lines, "terminal_info")
    return (rows.writeStream.queryName("terminal_info").foreachBatch(write)
            .option("checkpointLocation", f"{root}/_checkpoints/terminal_info").trigger(**trigger.options()).start())


def current_terminals(spark: SparkSession, root: str) -> DataFrame:
    return KeyedTable(spark, f"{root}/terminal_info", ["probe_id"]).read()


def count_terminals(current: DataFrame) -> DataFrame:
    return terminal.terminal_count(current.withColumn("seq", F.lit(0)), D5, ("seq",))


def terminal_counts(spark: SparkSession, root: str) -> DataFrame:
    """Counts published by the newest micro-batch."""
    return KeyedTable(spark, f"{root}/realtime_terminal_count", list(D5)).newest()


# ---- registry -------------------------------------------------------------------------------------------------------
STREAM_JOBS = ("play_request", "lag", "play_fail", "epg", "image", "event", "http_error", "state", "terminal_info")


def start(spark: SparkSession, job: str, lines: DataFrame, root: str, terminals: DataFrame | None = None,
          trigger: Trigger = Trigger(), watermark: str = W.WATERMARK, resolutions: Iterable[int] | None = None,
          retention: Mapping[int, str] | None = None) -> list[StreamingQuery]:
    """Start the queries of a job; ``retention`` bounds the tables of merging jobs and of the state job, for example with ``model.RESOLUTIONS``."""
    if job not in STREAM_JOBS:
        raise ValueError(f"job {job!r} is not one of {', '.join(STREAM_JOBS)}")
    if job == "terminal_info":
        return [terminal_query(spark, lines, root, trigger)]
    rows = log_rows(lines, job, watermark)
    if job == "state":
        if terminals is None:
            raise ValueError("the state job needs the terminal table")
        return [presence_query(spark, rows, root, trigger.options(), terminals,
                               retention=M.interval_for(retention, 5) if retention else None)]
    return [M.merging_query(spark, merge, rows, root, name, trigger.options(),
                            resolutions if len(merge.resolutions) > 1 else None, retention)
            for name, merge in merge_jobs(job).items()]


def run_available(spark: SparkSession, job: str, lines: DataFrame, root: str, terminals: DataFrame | None = None,
                  watermark: str = W.WATERMARK, resolutions: Iterable[int] = tuple(RESOLUTIONS),
                  retention: Mapping[int, str] | None = None) -> list[StreamingQuery]:
    """Process everything available now and stop."""
    queries = start(spark, job, lines, root, terminals, Trigger(), watermark, resolutions, retention)
    for query in queries:
        query.awaitTermination()
    return queries
