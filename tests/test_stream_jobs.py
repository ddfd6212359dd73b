"""Stream results equal batch results, whatever the order of arrival, also with repeated files, replays and restarts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catalog.views import Views, raw_lines
from viewpulse import model
from viewpulse.model import D2, D5
from viewpulse.operators import series as S
from viewpulse.operators.cube import exact_distinct_cube
from viewpulse.operators.parse import parse_valid
from viewpulse.session import shared_path
from viewpulse.sinks.keyed import BucketTable
from viewpulse.sources import hadoop, streams
from viewpulse.streaming import jobs as J
from viewpulse.streaming import merging as M
from viewpulse.streaming import presence as PR


def write_slices(lines, path, slices=3):
    """Lines in time order, one file after the other."""
    bounds = lines.agg(F.min("seq"), F.max("seq")).first()
    step = (bounds[1] - bounds[0]) // slices + 1
    for i in range(slices):
        low = bounds[0] + i * step
        (lines.where((F.col("seq") >= low) & (F.col("seq") < low + step)).select("value")
         .coalesce(1).write.mode("append").text(path))


@pytest.fixture(scope="module")
def views(spark, sf):
    return Views(spark, sf)


def ordered_lines(views, log):
    """Raw lines whose seq follows the event time."""
    from pyspark.sql import Window
    numbered = views.records(log).withColumn("seq", F.row_number().over(Window.orderBy("event_time", "seq")))
    return raw_lines(numbered, log)


def as_set(frame, columns):
    return {tuple(r) for r in frame.select(*columns).collect()}


def test_play_fail_stream_equals_batch(spark, views):
    root = shared_path(spark, "fail")
    lines = ordered_lines(views, "play_fail")
    write_slices(lines, f"{root}/in")
    log = streams.ProgressLog(spark)
    queries = J.run_available(spark, "play_fail", streams.text_lines(spark, f"{root}/in", 1), root,
                              resolutions=(1, 60))
    batch_rows = parse_valid(lines, "play_fail")
    key = ("bucket", *D5)
    for minutes in (1, 60):
        table = J.merged_table(spark, root, f"play_fail_{minutes}m")
        expected = S.multi_resolution(batch_rows, D5, {"fail_count": ("sum", F.lit(1).cast("bigint"))},
                                      resolutions={minutes: "1 day"})
        columns = (*key, "fail_count")
        got = as_set(table, columns)
        assert got == as_set(expected, columns) and len(got) == table.count()
    tail = J.realtime_series(spark, root, "play_fail_1m", D5)
    assert tail.groupBy(*D5).count().agg(F.max("count")).first()[0] <= 30
    assert log.report(*queries).first()["batches"] >= 3
    log.close()
    # a second run finds nothing new and changes nothing
    before = as_set(J.merged_table(spark, root, "play_fail_60m"), (*key, "fail_count"))
    J.run_available(spark, "play_fail", streams.text_lines(spark, f"{root}/in", 1), root, resolutions=(1, 60))
    assert before == as_set(J.merged_table(spark, root, "play_fail_60m"), (*key, "fail_count"))


BASE = datetime(2024, 1, 1, 10)
FAILS = ", ".join(f"{d} string" for d in D5) + ", event_time timestamp"


def fails_at(spark, *minutes):
    return spark.createDataFrame([("p", "c", "f", "v", "w", BASE + timedelta(minutes=m)) for m in minutes], FAILS)


def run_fails(spark, root, **settings):
    rows = streams.table_rows(spark, f"{root}/in", max_files=1)
    M.merging_query(spark, J.merge_jobs("play_fail")["play_fail"], rows, root, "fails", J.Trigger().options(), **settings).awaitTermination()


def whole_series(spark, root, minutes):
    whole = J.merged_table(spark, root, f"play_fail_{minutes}m").where(F.expr(" and ".join(f"{d} = 'ALL'" for d in D5)))
    return {int((r["bucket"] - BASE).total_seconds() // 60): r["fail_count"] for r in whole.collect()}


def test_late_rows_join_their_bucket_and_replays_change_nothing(spark):
    root = shared_path(spark, "late")
    for minutes in ((0, 0, 1), (5 * 24 * 60,), (0, 1, 61)):  # five days ahead, then late rows
        fails_at(spark, *minutes).coalesce(1).write.mode("append").parquet(f"{root}/in")
        run_fails(spark, root)
    want = {1: {0: 3, 1: 2, 61: 1, 7200: 1}, 60: {0: 5, 60: 1, 7200: 1}}
    assert {m: whole_series(spark, root, m) for m in want} == want
    # the last micro-batch was not acknowledged: it runs again
    hadoop.remove(spark, [f"{root}/_checkpoints/fails/commits/2"])
    run_fails(spark, root)
    assert {m: whole_series(spark, root, m) for m in want} == want


def test_tables_are_folded_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(M, "FOLD", 3)
    root = shared_path(spark, "bounded")
    steps = [0, 1, 2, 200, 201, 3, 400, 401, 402, 403, 404, 405]
    for minute in steps:
        fails_at(spark, minute).coalesce(1).write.mode("append").parquet(f"{root}/in")
    keep = {1: "1 hour", 15: "2 hours", 60: "3 hours"}
    run_fails(spark, root, retention=keep)
    assert spark.read.parquet(f"{root}/fails_expired").count() == 0  # minute 3 came when 200 was the newest: 3 hours reach it
    for minutes, reach in ((1, 60), (15, 120), (60, 180)):
        table = BucketTable(spark, f"{root}/realtime_play_fail_{minutes}m")
        assert len(table._complete("delta")) <= 2 * M.FOLD + 1 and len(table._complete("base")) <= 2
        got = {b: n for b, n in whole_series(spark, root, minutes).items() if b >= 405 // minutes * minutes - reach}
        want = {}
        for m in steps:
            bucket = m // minutes * minutes
            if bucket >= 405 // minutes * minutes - reach:
                want[bucket] = want.get(bucket, 0) + 1
        assert got == want
    cells = M.MergedTable(spark, f"{root}/fails_cells", J.merge_jobs("play_fail")["play_fail"].merge)
    assert cells.read().agg(F.min("bucket")).first()[0] >= BASE + timedelta(minutes=180)
    fails_at(spark, 0).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run_fails(spark, root, retention=keep)
    assert spark.read.parquet(f"{root}/fails_expired").count() == 1


def test_progress_counts_all_micro_batches(spark):
    root = shared_path(spark, "progress")
    spark.range(150).repartitionByRange(150, "id").write.parquet(f"{root}/in")
    files = len(hadoop.matching(spark, f"{root}/in/part-*"))
    log = streams.ProgressLog(spark)
    query = (streams.table_rows(spark, f"{root}/in", max_files=1).writeStream.format("noop")
             .option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    found = log.report(query).first()
    log.close()
    assert files > 100 and (found["batches"], found["input_rows"]) == (files, 150)


def test_lag_stream_drops_repeats(spark, views):
    root = shared_path(spark, "lag")
    lines = ordered_lines(views, "lag")
    write_slices(lines, f"{root}/in")
    write_slices(lines.where("seq % 3 = 0"), f"{root}/in")  # repeated lines, late
    J.run_available(spark, "lag", streams.text_lines(spark, f"{root}/in", 2), root, resolutions=(60,))
    rows = parse_valid(lines, "lag")
    once = rows.dropDuplicates(["event_time", "has_id", "probe_id"])
    expected = exact_distinct_cube(once.withColumn("bucket", F.date_trunc("hour", "event_time")), D5, "lag_plays",
                                   "has_id", ("bucket",))
    columns = ("bucket", *D5, "lag_plays")
    assert as_set(J.merged_table(spark, root, "lag_plays_60m"), columns) == as_set(expected, columns)
    causes = J.merged_table(spark, root, "lag_cause_60m")
    total = causes.where(F.expr(" and ".join(f"{d} = 'ALL'" for d in D5)))
    assert total.agg(F.sum("lag_count")).first()[0] == once.count()


def presence_by_hand(records, terminals, minutes=5):
    """(bucket, province) -> (online, stay_on) of all cities, by walking through the records of each box."""
    area, boxes, steps = {r["probe_id"]: r["province_id"] for r in terminals}, {}, {}
    for r in records:
        if r["probe_id"] in area:
            start = r["event_time"] - timedelta(minutes=r["event_time"].minute % minutes, seconds=r["event_time"].second,
                                                microseconds=r["event_time"].microsecond)
            boxes.setdefault(r["probe_id"], {}).setdefault(start, []).append((r["event_time"], r["has_id"], r["state"]))
    for box, windows in boxes.items():
        on = False
        for start in sorted(windows):
            seen, now = any(s != "0" for _, _, s in windows[start]), max(windows[start])[2] != "0"
            step = steps.setdefault((area[box], start), [0, 0, 0])
            step[0] += seen and not on
            step[1] += now - on
            step[2] += (seen and not on) or now != on
            on = now
    out, held = {}, {}
    for province, start in sorted(steps):
        newly, net, touched = steps[province, start]
        if touched:
            before = held.get(province, 0)
            held[province] = before + net
            out[start, province] = (before + newly, before + net)
    return out


@pytest.mark.parametrize("retention", [None, model.RESOLUTIONS])
def test_state_stream_equals_a_walk_through_the_records(spark, views, retention, monkeypatch):
    """Two slices; with retention and folding at every micro-batch the windows that are kept have the same counts."""
    monkeypatch.setattr(PR, "FOLD", 1)
    root = shared_path(spark, "state")
    lines = ordered_lines(views, "state")
    write_slices(lines, f"{root}/in", 3)
    J.run_available(spark, "state", streams.text_lines(spark, f"{root}/in", 1), root, terminals=views.terminal_info, retention=retention)
    want = presence_by_hand(parse_valid(lines, "state").collect(), views.terminal_info.collect())
    counts = PR.current_online(spark, root).where("province_id <> 'ALL' and city_id = 'ALL'")
    got = {(r["bucket"], r["province_id"]): (r["online_users"], r["stay_on"]) for r in counts.collect()}
    if retention:
        windows = parse_valid(lines, "state").select("probe_id", M.window_start(F.col("event_time"), 5)).distinct().count()
        assert PR.PresenceTables(spark, root).cells.read().count() < windows
        assert 0 < len(got) < len(want) and got.items() <= want.items()
        assert spark.read.parquet(f"{root}/state_expired").count() == 0
    else:
        assert got == want


def test_late_states_move_later_counts(spark):
    """A late record turns the box off before a window that had found it on; a replay changes nothing."""
    root = shared_path(spark, "late_state")
    base = datetime(2024, 1, 1)
    terminals = spark.createDataFrame([("a", "1", "10"), ("b", "1", "11")], "probe_id string, province_id string, city_id string")
    ddl = "event_time timestamp, probe_id string, has_id string, state string"
    batches = [[(0, "a", "1"), (10, "a", "1"), (10, "b", "1")], [(5, "a", "0"), (20, "b", "0"), (20, "unknown", "1")], [(20, "b", "2")]]

    def run():
        PR.presence_query(spark, streams.table_rows(spark, f"{root}/in", max_files=1), root, J.Trigger().options(), terminals).awaitTermination()
        counts = PR.current_online(spark, root).where("province_id = '1' and city_id = 'ALL'")
        return {(r["bucket"] - base).seconds // 60: (r["online_users"], r["stay_on"]) for r in counts.collect()}

    seen = []
    for rows in batches:
        spark.createDataFrame([(base + timedelta(minutes=m), box, "h", state) for m, box, state in rows], ddl) \
            .coalesce(1).write.mode("append").parquet(f"{root}/in")
        seen.append(run())
    assert seen == [{0: (1, 1), 10: (2, 2)}, {0: (1, 1), 5: (1, 0), 10: (2, 2), 20: (2, 1)}, {0: (1, 1), 5: (1, 0), 10: (2, 2)}]
    tables = PR.PresenceTables(spark, root)
    before = sorted(map(tuple, tables.changes.written(1).collect()))
    assert before == sorted(map(tuple, tables.differences(1).collect()))


def test_moved_boxes_leave_their_area(spark):
    base = datetime(2024, 1, 1)
    ddl = "bucket timestamp, probe_id string, seen_on int, last struct<event_time: timestamp, state: string>, province_id string"
    cells = spark.createDataFrame([(base, "a", 1, (base, "1"), "x"), (base + timedelta(hours=1), "a", 1, (base, "1"), "y"),
                                   (base + timedelta(hours=2), "a", 0, (base, "0"), "y")], ddl)
    got = {(r["bucket"].hour, r["province_id"]): (r["newly_on"], r["net"]) for r in PR.changes_of(cells, ("province_id",)).collect()}
    assert got == {(0, "x"): (1, 1), (1, "y"): (1, 1), (1, "x"): (0, -1), (2, "y"): (0, -1)}


def test_play_request_stream(spark, views):
    root = shared_path(spark, "play")
    lines = ordered_lines(views, "play_request")
    write_slices(lines, f"{root}/in", 2)
    J.run_available(spark, "play_request", streams.text_lines(spark, f"{root}/in", 1), root)
    rows = parse_valid(lines, "play_request").withColumn("bucket", M.window_start(F.col("event_time"), 5))
    last = rows.groupBy("bucket", "has_id").agg(F.max("event_time").alias("event_time"))
    expected = exact_distinct_cube(rows.join(last, ["bucket", "has_id", "event_time"]), D2, "plays", "has_id", ("bucket",))
    columns = ("bucket", *D2, "plays")
    assert as_set(J.merged_table(spark, root, "users_plays"), columns) == as_set(expected, columns)
    # increments written out: the window before counts where it is less than ten minutes older
    cells = rows.groupBy("bucket", *D2, "has_id", "has_type").agg(F.max("down_bytes").alias("b")).collect()
    held = {}
    for r in cells:
        key = (r["has_id"], r["has_type"], r["bucket"])
        held[key] = max(held.get(key, 0), r["b"])
    want = {}
    for r in cells:
        before = held.get((r["has_id"], r["has_type"], r["bucket"] - timedelta(minutes=5)), 0)
        want[r["bucket"]] = want.get(r["bucket"], 0) + r["b"] - before
    traffic = J.merged_table(spark, root, "traffic").where("province_id = 'ALL' and city_id = 'ALL'")
    assert {r["bucket"]: r["down_bytes"] for r in traffic.collect()} == want


def test_terminal_stream_upserts(spark, views):
    root = shared_path(spark, "terminals")
    base = views._boxes().withColumnRenamed("_key", "seq")
    lines = raw_lines(base, "terminal_info")
    lines.select("value").coalesce(1).write.text(f"{root}/in")
    J.run_available(spark, "terminal_info", streams.text_lines(spark, f"{root}/in"), root)
    first = J.current_terminals(spark, root)
    assert first.count() == parse_valid(lines, "terminal_info").count()
    moved = raw_lines(base.where("seq % 10 = 1").withColumn("fw_version", F.lit("fw9")), "terminal_info")
    same = raw_lines(base.where("seq % 10 = 2"), "terminal_info")
    moved.unionByName(same).select("value").coalesce(1).write.mode("append").text(f"{root}/in")
    J.run_available(spark, "terminal_info", streams.text_lines(spark, f"{root}/in"), root)
    changed = parse_valid(moved, "terminal_info").count()
    assert spark.read.parquet(f"{root}/terminal_info/level=delta/batch=1").count() == changed
    current = J.current_terminals(spark, root)
    assert current.where("fw_version = 'fw9'").count() == changed
    assert current.count() == first.count()
    from viewpulse.sinks.keyed import KeyedTable
    table = KeyedTable(spark, f"{root}/terminal_info", ["probe_id"])
    assert table.compact() == 1 and table.read().count() == first.count()
    whole = J.terminal_counts(spark, root).where(F.expr(" and ".join(f"{d} = 'ALL'" for d in D5)))
    assert whole.first()["terminals"] == first.count()


def test_previous_value_and_gap(spark):
    """Second window subtracts, a window after the limit counts whole."""
    root = shared_path(spark, "growth")
    base = datetime(2024, 1, 1)
    ddl = "has_id string, has_type string, province_id string, city_id string, down_bytes bigint, " \
          "play_seconds bigint, event_time timestamp"
    points = [(0, 100, 10), (5, 150, 30), (30, 400, 50), (600, 1, 1)]
    for minute, size, seconds in points:
        spark.createDataFrame([("h", "1", "p", "c", size, seconds, base + timedelta(minutes=minute))], ddl) \
            .coalesce(1).write.mode("append").parquet(f"{root}/in")
    from viewpulse.streaming import state as ST
    from viewpulse.streaming import windows as W
    stream = ST.increments_stream(W.with_watermark(streams.table_rows(spark, f"{root}/in", max_files=1), "1 minute"))
    J.commit_rows(stream, root, "out", J.Trigger()).awaitTermination()
    got = {r["bucket"]: (r["down_bytes_delta"], r["play_seconds_delta"])
           for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {base: (100, 10), base + timedelta(minutes=5): (50, 20), base + timedelta(minutes=30): (400, 50)}


@pytest.mark.parametrize("log, table, keys, measure", [
    ("event", "event_60m", ("event_id",), "count_sum"), ("epg", "epg_bands_60m", ("page_type",), "band3"),
    ("image", "image_60m", (), "succ_rate"), ("http_error", "http_error", ("http_rsp_code",), "total")])
def test_additive_streams_equal_batch(spark, views, log, table, keys, measure):
    """Lines with an arrival time, in two files; windows equal the batch form."""
    from viewpulse.plans import network, page
    root = shared_path(spark, log)
    records = views.records(log)
    lines = raw_lines(records, log).join(records.select("seq", F.col("event_time").alias("ingest_time")), "seq")
    lines = lines.withColumn("ingest_time", F.col("ingest_time").cast("timestamp"))
    middle = lines.approxQuantile("seq", [0.5], 0.0)[0]
    for part in (lines.where(F.col("seq") <= middle), lines.where(F.col("seq") > middle)):
        part.select("value", "ingest_time").coalesce(1).write.mode("append").parquet(f"{root}/in")
    J.run_available(spark, log, streams.table_rows(spark, f"{root}/in", max_files=1), root, resolutions=(60,))
    rows = J.log_rows(lines, log)
    minutes, dims = (5, D2) if log == "http_error" else (60, D5)
    rows = rows.withColumn("bucket", F.window("event_time", f"{minutes} minutes").start)
    expected = {
        "event": lambda: network.event_trend(rows, D5, ("bucket",)),
        "epg": lambda: page.epg_bands(rows, D5, ("bucket",)),
        "image": lambda: page.image_rates(rows, D5, ("bucket",)),
        "http_error": lambda: network.http_errors(rows, D2, ("bucket",)),
    }[log]()
    columns = ("bucket", *dims, *keys, measure)
    want = as_set(expected, columns)
    assert as_set(J.merged_table(spark, root, table), columns) == want and want


def test_arrivals_have_files_for_many_tasks(spark, tmp_path, monkeypatch):
    """A micro-batch is written and read as several files, their number grows with the input; every row arrives once."""
    import catalog.stream_queries as S
    from catalog.views import Views

    spark.range(3000).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert S.files_of(rows, 3) == 1
    monkeypatch.setattr(S, "ARRIVAL_BYTES", S.C.read_bytes(rows) // 6)
    assert S.files_of(rows, 3) in (2, 3)
    seen = []
    query = S.arrivals(Views(spark, str(tmp_path)), rows).writeStream.foreachBatch(
        lambda batch, number: seen.append((batch.count(), batch.rdd.getNumPartitions()))).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(seen) == 3 and sum(n for n, _ in seen) == 3000
