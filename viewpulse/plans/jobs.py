"""Batch jobs: task numbers to result tables, for one calendar period."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.model import D5
from viewpulse.operators.enrich import latest_per_session, repair_area
from viewpulse.plans import network, page, play, stall, terminal
from viewpulse.plans.snapshots import CounterSnapshots
from viewpulse.sinks.tables import to_contract, write_table
from viewpulse.sources import periods
from viewpulse.sources.logs import read_log_table


@dataclass
class Inputs:
    """What the metrics of one run may read.

    Frames that several metrics of a run need (latest records, increments: one row per session instead of one per log
    line) are persisted while the run lasts; a lost executor only means that its share is computed again.
    """

    rows: Callable[[], DataFrame]
    history: Callable[[], DataFrame]
    plays: Callable[[], DataFrame]
    terminals: DataFrame
    period: str
    start: datetime
    rows_of: Callable[[datetime], DataFrame] | None = None
    snapshots: CounterSnapshots | None = None
    dims: tuple[str, ...] = D5
    share: bool = False
    held: dict[str, DataFrame] = field(default_factory=dict)

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.held:
            frame = build()
            self.held[name] = frame.persist(StorageLevel.MEMORY_AND_DISK) if self.share else frame
        return self.held[name]

    def latest(self) -> DataFrame:
        return self._once("latest", lambda: latest_per_session(self.rows(), distinct=False))

    def grown(self) -> DataFrame:
        """Increments of this period; earlier periods are only read for the value before, as log or as snapshots."""
        if self.snapshots is not None:
            return self._once("grown", lambda: self.snapshots.increments(self.rows_of, self.start))
        start = F.lit(self.start).cast("timestamp_ntz")
        return self._once("grown", lambda: play.increments(self.history(), self.period, self.dims).where(
            F.col("period_start").cast("timestamp_ntz") == start))

    def release(self) -> None:
        if self.share:
            for frame in self.held.values():
                frame.unpersist()


Metric = Callable[[Inputs], DataFrame]

METRICS: dict[str, Metric] = {
    "T_STREAMUSER": lambda i: play.play_totals(i.latest()).drop("plays"),
    "T_FIRST_FRAME_INDEX": lambda i: play.first_frame_mean(i.latest()),
    "T_USER_LAG_DISTRIBUTION": lambda i: play.stall_distribution(i.latest(), D5).drop("users"),
    "T_USER_LAG": lambda i: play.stall_user_rate(play.stall_distribution(i.latest(), D5)),
    "T_DOWN_BYTES_INDEX": lambda i: play.traffic(i.grown()),
    "T_BUSINESS_ONLINE_DATA": lambda i: play.service_online_time(i.grown()),
    "T_BUSINESS_QUALITY": lambda i: play.business_quality(i.grown()),
    "T_STARTUSER": lambda i: terminal.online_users(i.rows(), i.terminals),
    "T_FAULT": lambda i: stall.cause_counts_d6(i.rows()),
    "T_PLAYUSER_CAUSE": lambda i: stall.cause_groups(i.rows()),
    "T_PLAY_LAG": lambda i: stall.natural_buffer_rate(i.rows(), latest_per_session(i.plays(), False)),
    "T_PLAY_SUCC_RATE": lambda i: play.play_success_rate(i.rows(), latest_per_session(i.plays(), False)),
    "T_EPG_DISTRIBUTION": lambda i: page.epg_bands(i.rows()),
    "T_DETAIL_LOAD_SUCC": lambda i: page.detail_load_success(i.rows()),
    "T_IMAGE_INDEX": lambda i: page.image_rates(i.rows()),
    "T_LOGIN_SUCC_INDEX": lambda i: terminal.login_success(i.rows()),
    "T_HTTP_ERROR_CODE": lambda i: network.http_errors(i.rows(), D5),
    "T_EVENT_TREND": lambda i: network.event_trend_d6(i.rows()),
}

_GROWTH = ("T_DOWN_BYTES_INDEX", "T_BUSINESS_ONLINE_DATA", "T_BUSINESS_QUALITY")
#: job -> task number -> result tables; the first number of a job runs all of them
TASKS: dict[str, dict[str, tuple[str, ...]]] = {
    "state": {"200": ("T_STARTUSER",), "201": (), "202": ("T_STARTUSER",)},
    "play_request": {
        "300": ("T_FIRST_FRAME_INDEX", "T_USER_LAG_DISTRIBUTION", "T_USER_LAG", *_GROWTH, "T_STREAMUSER"),
        "301": ("T_FIRST_FRAME_INDEX",), "305": ("T_USER_LAG_DISTRIBUTION", "T_USER_LAG"), "306": _GROWTH,
        "307": ("T_STREAMUSER",)},
    "lag": {"400": ("T_FAULT", "T_PLAYUSER_CAUSE", "T_PLAY_LAG"), "402": ("T_FAULT",), "403": ("T_PLAYUSER_CAUSE",),
            "404": ("T_PLAY_LAG",)},
    "play_fail": {"500": ("T_PLAY_SUCC_RATE",), "501": ("T_PLAY_SUCC_RATE",)},
    "epg": {"600": ("T_EPG_DISTRIBUTION", "T_DETAIL_LOAD_SUCC"), "602": ("T_EPG_DISTRIBUTION",),
            "603": ("T_DETAIL_LOAD_SUCC",)},
    "image": {"700": ("T_IMAGE_INDEX",), "701": ("T_IMAGE_INDEX",)},
    "login": {"900": ("T_LOGIN_SUCC_INDEX",), "901": ("T_LOGIN_SUCC_INDEX",)},
    "http_error": {"1000": ("T_HTTP_ERROR_CODE",), "1001": ("T_HTTP_ERROR_CODE",)},
    "event": {"1100": ("T_EVENT_TREND",)},
}


def tables_of(job: str, task: str | None = None) -> tuple[str, ...]:
    """Result tables of a task; without one, all tables of the job."""
    if job not in TASKS:
        raise ValueError(f"job {job!r} is not one of {', '.join(TASKS)}")
    tasks = TASKS[job]
    number = task or next(iter(tasks))
    if number not in tasks:
        raise ValueError(f"task {number!r} of {job} is not one of {', '.join(tasks)}")
    return tasks[number]


def inputs_of(spark: SparkSession, job: str, period: str, at: datetime, log_root: str, terminals: DataFrame,
              share: bool = False, num_partitions: int | None = None, snapshot_root: str | None = None) -> Inputs:
    """Readers of one run over the log tables below ``log_root`` (one per log name), areas repaired."""
    name = periods.check_period(period)

    def table(log: str, since: datetime | None = None, at: datetime = at) -> DataFrame:
        rows = read_log_table(spark, f"{log_root}/{log}", name, at, since)
        if num_partitions:
            rows = rows.repartition(num_partitions)
        return repair_area(rows, terminals) if "province_id" in rows.columns else rows

    return Inputs(rows=lambda: table(job), history=lambda: table(job, periods.lookback(name, at)),
                  plays=lambda: table("play_request"), terminals=terminals, period=name,
                  start=periods.period_bounds(name, at)[0], rows_of=lambda start: table(job, at=start),
                  snapshots=CounterSnapshots(spark, snapshot_root, name) if snapshot_root else None, share=share)


def plan_batch(inputs: Inputs, tables: Iterable[str], at: datetime) -> dict[str, DataFrame]:
    """Result frames in contract columns; nothing runs yet."""
    label = periods.label(inputs.period, at)
    return {t: to_contract(METRICS[t](inputs), t, inputs.period, label) for t in tables}


def run_batch(spark: SparkSession, job: str, period: str, at: datetime | str | None, log_root: str,
              terminals: DataFrame, out_root: str, task: str | None = None,
              num_partitions: int | None = None, snapshot_root: str | None = None) -> Iterable[str]:
    """Write the result tables of one run and return their names.

    ``at`` may be text (``yyyy[MM[dd[HH]]]``); without it the period before now is reported.  ``num_partitions``
    overrides the partition count of the input; by default the scan and adaptive execution decide.  With ``snapshot_root``
    the counters of sessions are kept there between runs, and the log of earlier periods is not read again.
    """
    when = periods.appointed(at) if isinstance(at, str) else at or periods.previous_time(period, datetime.now())
    tables = tables_of(job, task)
    inputs = inputs_of(spark, job, period, when, log_root, terminals, len(tables) > 1, num_partitions, snapshot_root)
    try:
        for table, result in plan_batch(inputs, tables, when).items():
            write_table(result, out_root, table)
    finally:
        inputs.release()
    return tables


def run_terminal_count(reports: DataFrame, period: str, at: datetime | str | None, out_root: str) -> str:
    """Write T_TERMINAL_COUNT of a period from the reports of boxes until its end (the current terminal table has one each).

    Reports without a time count as the oldest of their box.
    """
    when = periods.appointed(at) if isinstance(at, str) else at or periods.previous_time(period, datetime.now())
    timed = reports if "event_time" in reports.columns else reports.withColumn("event_time", F.lit(None).cast("timestamp_ntz"))
    ordered = timed if "seq" in timed.columns else timed.withColumn("seq", F.lit(0))
    end = F.lit(periods.period_bounds(period, when)[1]).cast("timestamp_ntz")
    known = ordered.where(F.col("event_time").isNull() | (F.col("event_time") < end))
    write_table(terminal_table(known, period, when), out_root, "T_TERMINAL_COUNT")
    return "T_TERMINAL_COUNT"


def terminal_table(reports: DataFrame, period: str, at: datetime) -> DataFrame:
    """T_TERMINAL_COUNT rows for a label."""
    return to_contract(terminal.terminal_count(reports), "T_TERMINAL_COUNT", period, periods.label(period, at))
