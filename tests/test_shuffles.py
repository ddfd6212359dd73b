"""What roll-ups by time move between tasks: cells, as seldom as they can."""

import re
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catalog.queries import QUERIES
from catalog.stream_queries import arrivals
from catalog.views import Views
from viewpulse.functions.timecols import bucket_start
from viewpulse.operators import cube as C
from viewpulse.operators import series as S
from viewpulse.session import REMOVE_SHUFFLES, shared_path
from viewpulse.sinks import keyed
from viewpulse.streaming import jobs as J
from viewpulse.streaming import merging as M

BASE = datetime(2024, 1, 1, 10)


def exchanges(frame):
    """The different shuffles of a plan by their keys, without the numbers of columns."""
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return [re.sub(r"#\d+L?", "", line.split("hashpartitioning(")[1].split("), ")[0])
            for line in plan.splitlines() if "Exchange hashpartitioning(" in line]


@pytest.mark.parametrize("name, fixed", [("multires_epg", ["page_type"]), ("multires_image", [])])
def test_resolutions_move_one_minute_cells_only(spark, sf, name, fixed):
    """One shuffle makes the cells, three deal them out; none moves coarser cells or cells with a rolled-up dimension."""
    frame = QUERIES[name](spark, sf)
    keys = {tuple(re.sub(r", \d+$", "", k).split(", ")) for k in exchanges(frame)}
    cells = {k for k in keys if "_label" in k or "bucket" in k}
    finest = ("bucket", *fixed, "province_id", "city_id", "platform", "device_provider", "fw_version")
    assert cells == {finest, ("_label", "province_id"), ("_label", "city_id"), ("_label",)}
    assert "Expand" not in frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("resolutions", [(1, 15, 60), (1,), (15,), (10, 15)])
@pytest.mark.parametrize("n", [0, 2, 3, 5])
def test_resolutions_equal_one_cube_each(spark, n, resolutions):
    """Any number of dimensions and any resolutions, with missing values and values that read ALL."""
    dims = ["a", "b", "c", "d", "e"][:n]
    data = [(BASE + timedelta(minutes=7 * i % 130), "ALL" if i % 5 == 0 else f"a{i % 3}", None if i % 7 == 0 else f"b{i % 2}",
             f"c{i % 4}", "", f"e{i % 2}", None if i % 11 == 0 else str(i % 2), None if i % 6 == 0 else i) for i in range(60)]
    frame = spark.createDataFrame(data, "event_time timestamp, a string, b string, c string, d string, e string, k string, v bigint")
    got = S.multi_resolution(frame, dims, {"v": ("sum", F.col("v"))}, ("k",), dict.fromkeys(resolutions, "1 day"))
    assert got.columns == ["resolution", "bucket", "k", *dims, "v"]
    want = []
    for m in resolutions:
        rows = C.no_null_dims(frame, dims).withColumn("bucket", bucket_start(F.col("event_time"), m))
        cube = C.grouped_cube(rows, dims, ("bucket", "k"), [F.sum("v").alias("v")])
        want += [(m, *r) for r in cube.select("bucket", "k", *dims, "v").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_sessions_move_twice_before_they_are_counted(spark, sf):
    """To their cells and to their session; no part of the roll-up moves ids again or is read twice."""
    found = exchanges(QUERIES["business_quality"](spark, sf))
    ids = [k for k in found if re.search(r"\b(has_id|_id)\b", k)]
    assert len(ids) == 2 and re.fullmatch(r"has_id, \d+", ids[1] if ids[0].startswith("_period") else ids[0])
    cells = [k for k in found if "_lone" in k or k.startswith("parse_time")]
    assert len(cells) == 2


def test_increments_move_stored_cells_once(spark, rows):
    day = lambda n: BASE.replace(hour=0) + timedelta(days=n)
    stored = rows("bucket timestamp, province_id string, city_id string, has_id string, has_type string, down_bytes bigint, "
                  "play_seconds bigint",
                  [(day(0), "p", "c", "s", "1", 5, 1), (day(0), "p", "c", "s", "1", 7, 1), (day(1), "p", "c", "s", "1", 9, 4),
                   (day(9), "p", "c", "s", "1", 9, 4), (day(1), "p", "c", None, "1", 3, 3)])
    job = J.growth_job(1440, 2 * 86_400, lambda grown: {"increments": grown})
    result = job.publish(job.merge(stored), rows("bucket timestamp", [(day(0),)]), 1440)["increments"]
    moved = [k for k in exchanges(result) if "has_id" in k]
    assert [re.sub(r", \d+$", "", k) for k in moved] == ["has_id, has_type"]
    got = {(r.bucket, r.has_id, r.down_bytes_delta, r.play_seconds_delta) for r in result.collect()}
    assert got == {(day(0), "s", 7, 1), (day(1), "s", 2, 3), (day(1), None, 3, 3)}


def test_bucket_tables_are_read_where_they_lie(spark, monkeypatch):
    """Few buckets go to all tasks, so the rows of all batches do not move; many are joined by shuffle, with the same rows."""
    table = keyed.BucketTable(spark, shared_path(spark, "buckets"))
    for batch in range(3):
        table.write_batch(spark.range(batch, 100).selectExpr("id as bucket", f"{batch} as v"), batch)
    assert not any("batch" in k for k in exchanges(table.read()))
    want = sorted(map(tuple, table.read().collect()))
    assert want == [(0, 0), (1, 1)] + [(i, 2) for i in range(2, 100)]
    monkeypatch.setattr(keyed, "FEW_BUCKETS", 10)
    assert sorted(map(tuple, table.read().collect())) == want


def shuffle_files(spark):
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = store.getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_micro_batches_leave_no_shuffle_files(spark, sf):
    before, root, v = shuffle_files(spark), shared_path(spark, "tidy"), Views(spark, sf)
    job = J.merge_jobs("play_request")["play_request"]
    M.merging_query(spark, job, arrivals(v, v.play_request), root, "tidy", {"availableNow": True}).awaitTermination()
    limit = time.monotonic() + 5
    while (left := shuffle_files(spark) - before) and time.monotonic() < limit:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(REMOVE_SHUFFLES, None) is None, "frames of the session itself may be run again"
    assert J.merged_table(spark, root, "users_plays").count() > 0


def test_sessions_are_counted_where_they_were_merged(spark):
    """Two shuffles bring records to their session, once for each count; only boxes move again, to their cells and to their box."""
    window = f"timestamp '{BASE:%Y-%m-%d %H:%M:%S}' + make_dt_interval(0, 0, 5 * int(id % 2))"
    stored = spark.range(40).selectExpr(
        f"{window} as bucket", "string(id % 7) as has_id", "string(id % 3) as probe_id", *[f"string(id % 2) as {d}" for d in J.D5],
        "'1' as has_type", "id as freeze_time", "id as down_seconds", "id as latency", "id as play_seconds", "id as down_bytes",
        f"{window} as event_time")
    job = J.merge_jobs("play_request")["play_request"]
    result = job.publish(job.merge(stored), stored.select("bucket").distinct(), 5)["users_plays"]
    assert sum(bool(re.search(r"\b(has_id|_id)\b", k)) for k in exchanges(result)) == 4
    whole = result.where("province_id = 'ALL' and city_id = 'ALL'").collect()
    assert [(r.play_users, r.plays) for r in whole] == [(3, 7), (3, 7)]
