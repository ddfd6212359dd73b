"""Batch jobs end to end: raw lines, log tables, tasks, contracts, reruns."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from catalog.views import Views, raw_lines, write_sequence_files
from viewpulse.model import D5, TABLES
from viewpulse.operators.parse import parse_valid
from viewpulse.plans import jobs, network
from viewpulse.plans.snapshots import CounterSnapshots
from viewpulse.session import shared_path
from viewpulse.sinks.tables import read_table, to_contract, write_table
from viewpulse.sources import logs

PERIOD = {"state": ("MONTH", "202401"), "lag": ("WEEK", "20240101"), "event": ("DAY", "20240110"),
          "play_fail": ("HALFYEAR", "2024"), "play_request": ("QUARTER", "199803"), "epg": ("YEAR", "1998"),
          "image": ("MONTH", "199803"), "login": ("YEAR", "1998"), "http_error": ("YEAR", "1998")}


@pytest.fixture(scope="module")
def tables(spark, sf):
    """Log tables of all logs, with year-or-day partitions only as fine as the data needs."""
    views = Views(spark, sf)
    root = shared_path(spark, "logs")
    for log in jobs.TASKS:
        rows = getattr(views, log).drop("seq")
        if log == "play_request":  # plays of the failure log's time as well
            rows = rows.unionByName(views.play, allowMissingColumns=True)
        # few partitions keep the test quick: hours only where a test looks at them
        start = F.date_trunc("day" if log == "event" else "month", "event_time").cast("timestamp_ntz")
        nine = F.make_dt_interval(hours=F.lit(8) + F.when(F.hour("event_time") < 12, 0).otherwise(1))
        rows = rows.withColumn("event_time", start + nine if log == "event" else start)
        logs.write_log_table(rows, f"{root}/{log}", "all", None)
    return root, views.terminal_info


@pytest.mark.parametrize("job", sorted(jobs.TASKS))
def test_job_fills_its_tables(spark, tables, job):
    root, terminals = tables
    out = shared_path(spark, "out")
    period, at = PERIOD[job]
    names = jobs.run_batch(spark, job, period, at, root, terminals, out)
    assert names == jobs.tables_of(job)
    for name in names:
        rows = read_table(spark, out, name)
        assert rows.columns == list(TABLES[name].columns.values())
        first = rows.first()
        assert first["period"] == period and len(first["parseTime"]) == 12
    before = {n: read_table(spark, out, n).count() for n in names}
    jobs.run_batch(spark, job, period, at, root, terminals, out)
    assert before == {n: read_table(spark, out, n).count() for n in names}


def test_other_labels_survive_a_rerun(spark, tables):
    root, terminals = tables
    out = shared_path(spark, "out")
    for at in ("20240110", "20240111", "20240110"):
        jobs.run_batch(spark, "event", "DAY", at, root, terminals, out)
    labels = {r.parseTime for r in read_table(spark, out, "T_EVENT_TREND").select("parseTime").distinct().collect()}
    assert labels == {"202401100000", "202401110000"}


def test_snapshots_give_the_increments_of_the_log(spark, tables):
    """Runs in any order, first without the snapshots they look back at, and again with all."""
    root, terminals = tables
    plain, kept, snapshots = (shared_path(spark, n) for n in ("plain", "kept", "snapshots"))

    def traffic(out, at):
        rows = read_table(spark, out, "T_DOWN_BYTES_INDEX").where(F.col("parseTime") == f"{at}000000")
        return sorted(map(tuple, rows.collect()))

    for at in ("199804", "199803", "199804"):
        for out, kept_in in ((plain, None), (kept, snapshots)):
            jobs.run_batch(spark, "play_request", "MONTH", at, root, terminals, out, "306", snapshot_root=kept_in)
        assert traffic(plain, at) == traffic(kept, at) != []
    store = CounterSnapshots(spark, snapshots, "MONTH")
    assert store.kept() == {datetime(1998, m, 1) for m in (1, 2, 3, 4)}
    store.expire(datetime(1998, 4, 1))
    assert min(store.kept()) == min(store.looked_back_at(datetime(1998, 4, 1)))


def test_days_look_back_one_day(spark):
    store = CounterSnapshots(spark, shared_path(spark, "none"), "DAY")
    assert store.looked_back_at(datetime(2024, 3, 1)) == [datetime(2024, 2, 29)] and store.kept() == set()


def test_terminal_counts_of_reports_without_a_time(spark):
    ddl = "probe_id string, device_id string, province_id string, city_id string, platform string, device_provider string, fw_version string"
    boxes = spark.createDataFrame([("a", "d1", "1", "10", "p", "x", "f"), ("b", None, "1", "10", "p", "x", None)], ddl)
    out = shared_path(spark, "terminals")
    assert jobs.run_terminal_count(boxes, "DAY", "20240101", out) == "T_TERMINAL_COUNT"
    found = read_table(spark, out, "T_TERMINAL_COUNT")
    assert found.count() == 32 and {r["userCount"] for r in found.collect()} == {1}


def test_task_numbers():
    assert jobs.tables_of("lag", "403") == ("T_PLAYUSER_CAUSE",)
    assert jobs.tables_of("state", "201") == ()
    with pytest.raises(ValueError):
        jobs.tables_of("lag", "999")
    with pytest.raises(ValueError):
        jobs.tables_of("unknown")
    numbers = {n for tasks in jobs.TASKS.values() for n in tasks}
    assert numbers == {"200", "201", "202", "300", "301", "305", "306", "307", "400", "402", "403", "404", "500", "501",
                       "600", "602", "603", "700", "701", "900", "901", "1000", "1001", "1100"}


def test_period_scan_prunes_partitions(spark, tables):
    root, _ = tables
    day = logs.read_log_table(spark, f"{root}/event", "DAY", datetime(2024, 1, 10))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "dt#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    everything = logs.read_log_table(spark, f"{root}/event")
    low, high = datetime(2024, 1, 10), datetime(2024, 1, 11)
    assert day.count() == everything.where((F.col("event_time") >= F.lit(low)) & (F.col("event_time") < F.lit(high))).count()


def test_hours_keep_leading_zeros(spark, tables):
    root, _ = tables
    everything = logs.read_log_table(spark, f"{root}/event")
    hour = logs.read_log_table(spark, f"{root}/event", "HOUR", datetime(2024, 1, 10, 9))
    assert hour.count() == everything.where("date_format(event_time, 'yyyyMMddHH') = '2024011009'").count() > 0


def test_sequence_files_and_ingest(spark, sf):
    root = shared_path(spark, "seq")
    records = Views(spark, sf).event
    day = F.date_trunc("day", "event_time").cast("timestamp_ntz")
    lines = raw_lines(records.withColumn("event_time", day), "event")
    write_sequence_files(lines, f"{root}/raw/2024/01/17")
    found = logs.read_period_files(spark, f"{root}/raw", "probe", "WEEK", datetime(2024, 1, 18))
    logs.ingest(found, "event", f"{root}/event", "day", datetime(2024, 1, 1), f"{root}/refused")
    good = parse_valid(lines.select("value"), "event", "offline").count()
    assert logs.read_log_table(spark, f"{root}/event").count() == good
    assert spark.read.parquet(f"{root}/refused").count() == lines.count() - good


def test_contract_of_every_table(spark, sf):
    views = Views(spark, sf)
    total = to_contract(network.http_errors(views.http_error, D5), "T_HTTP_ERROR_CODE", "DAY", "202401010000")
    root = shared_path(spark, "one")
    write_table(total, root, "T_HTTP_ERROR_CODE")
    assert read_table(spark, root, "T_HTTP_ERROR_CODE").count() == total.count()
    reports = jobs.terminal_table(views.terminal_report, "DAY", datetime(2024, 1, 1))
    assert reports.columns == list(TABLES["T_TERMINAL_COUNT"].columns.values())
    fed = {t for tasks in jobs.TASKS.values() for names in tasks.values() for t in names} | {"T_TERMINAL_COUNT"}
    assert set(TABLES) - fed == {"T_SLICE_HEALTH"}
