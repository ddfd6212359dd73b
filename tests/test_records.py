"""Lookups, latest records, increments, changes, series: small exact cases and hot keys."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from viewpulse.operators import enrich as E
from viewpulse.operators import series as S

BASE = datetime(2024, 1, 1)


def at(minutes):
    return BASE + timedelta(minutes=minutes)


def test_lookup_join_both_ways(rows):
    facts = rows("probe_id string, n bigint", [("hot", i) for i in range(500)] + [("a", 1), ("none", 2)])
    boxes = rows("probe_id string, province_id string", [("hot", "1"), ("a", "2"), ("other", "3")])
    small = E.lookup_join(facts, boxes, "probe_id")
    large = E.lookup_join(facts, boxes, "probe_id", limit=0)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.select(small.columns).collect()))
    assert small.count() == 501
    assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()


def test_hot_box_is_salted(rows):
    facts = rows("probe_id string, n bigint", [("hot", i) for i in range(2000)])
    salted = facts.withColumn("s", F.pmod(F.xxhash64(*facts.columns), F.lit(E.SALTS)))
    assert salted.groupBy("s").count().agg(F.max("count")).first()[0] < 300


def test_repair_area(rows):
    facts = rows("probe_id string, province_id string, city_id string",
                 [("a", "2", "0"), ("b", "2", "0"), ("a", "5", "51"), ("c", None, "9")])
    boxes = rows("probe_id string, province_id string, city_id string", [("a", "7", "71"), ("c", "8", "81")])
    want = [("a", "5", "51"), ("a", "7", "71"), ("b", "2", "0"), ("c", None, "9")]
    for limit in (E.BROADCAST_BYTES, 0):
        got = sorted((tuple(r) for r in E.repair_area(facts, boxes, limit).collect()), key=str)
        assert got == sorted(want, key=str)


def test_latest_keeps_ties(rows):
    data = [("h", at(0), 1), ("h", at(5), 2), ("h", at(5), 3), ("h", at(5), 3), ("g", at(1), 9)]
    frame = rows("has_id string, event_time timestamp, v bigint", data)
    assert sorted(r.v for r in E.latest_per_session(frame).collect()) == [2, 3, 9]
    assert sorted(r.v for r in E.latest_per_session(frame, distinct=False).collect()) == [2, 3, 3, 9]


def test_copies_and_hot_session(rows):
    """A session with a third of the rows, and as many equal rows: whole and right."""
    data = ([("hot", at(i % 50), i) for i in range(400)] + [("copy", at(7), 1)] * 400
            + [(f"h{i}", at(i), i) for i in range(400)])
    frame = rows("has_id string, event_time timestamp, v bigint", data)
    latest = {(r.has_id, r.v) for r in E.latest_per_session(frame).collect()}
    assert {v for h, v in latest if h == "hot"} == {i for i in range(400) if i % 50 == 49}
    assert [v for h, v in latest if h == "copy"] == [1]
    assert len(latest) == 8 + 1 + 400


def test_increments(rows):
    def hour(h, minute=0):
        return BASE + timedelta(hours=h, minutes=minute)
    data = [("p", "h", "1", hour(0), 10), ("p", "h", "1", hour(0, 30), 40), ("p", "h", "1", hour(1), 70),
            ("p", "h", "1", hour(4), 100), ("p", "h", "1", hour(5), 60)]
    frame = rows("province_id string, has_id string, has_type string, event_time timestamp, down_bytes bigint", data)
    def grown(reset):
        out = S.period_increments(frame, "HOUR", ("province_id",), ("down_bytes",), reset=reset)
        return [r.down_bytes_delta for r in out.orderBy("period_start").collect()]
    assert grown("raw") == [40, 30, 100, -40]      # the gap before hour 4 lets the value count whole
    assert grown("full") == [40, 30, 100, 60]      # a counter that went down counts whole


def test_increments_add_up(rows):
    data = [("p", f"h{i}", "1", BASE + timedelta(hours=h), 10 * h + i) for i in range(5) for h in range(6)]
    frame = rows("province_id string, has_id string, has_type string, event_time timestamp, down_bytes bigint", data)
    out = S.period_increments(frame, "HOUR", ("province_id",), ("down_bytes",))
    total = {r.has_id: r.s for r in out.groupBy("has_id").agg(F.sum("down_bytes_delta").alias("s")).collect()}
    assert total == {f"h{i}": 50 + i for i in range(5)}


def test_changed_records_across_days(rows):
    states = ["a", "a", "b", "b", "a", None, None, "c"]
    data = [("x", s, BASE + timedelta(hours=9 * i), i) for i, s in enumerate(states)]
    frame = rows("probe_id string, fw string, event_time timestamp, seq bigint", data)
    changes = S.changed_records(frame, "probe_id", ["fw"], ("event_time", "seq"))
    assert sorted(r.seq for r in changes.collect()) == [0, 2, 4, 5, 7]


def test_series_limit(rows):
    points = rows("k string, index_time string, v bigint", [("a", f"{i:03}", i) for i in range(31)] + [("b", "000", 1)])
    out = {(r.k, r.index_time): r.v for r in S.last_points(points, ["k"]).collect()}
    assert len(out) == 31 and ("a", "000") not in out and out["b", "000"] == 1


def test_first_per_minute(rows):
    data = [("h", "p", at(0), 2), ("h", "p", at(0), 1), ("h", "p", at(1), 3), ("h", "q", at(0), 4)]
    frame = rows("has_id string, probe_id string, event_time timestamp, seq bigint", data)
    assert sorted(r.seq for r in S.first_per_minute(frame).collect()) == [1, 3, 4]


def test_online_state(rows):
    def day(d):
        return BASE + timedelta(days=d, hours=1)
    data = [("a", "1", day(0), 1), ("a", "0", day(3), 2), ("b", "0", day(1), 3), ("c", "1", day(2), 4),
            ("c", "0", day(2), 5), ("z", "0", day(4), 6)]
    frame = rows("probe_id string, state string, event_time timestamp, seq bigint", data)
    out = {(r.period_start.day - 1, r.probe_id) for r in S.online_at_periods(frame, "DAY").collect()}
    assert out == {(0, "a"), (1, "a"), (2, "a"), (3, "a"), (2, "c")}


def test_retention(rows):
    data = [(1, at(0)), (1, at(59)), (1, at(61)), (15, at(0)), (15, at(1500))]
    frame = rows("resolution int, bucket timestamp", data)
    assert sorted(tuple(r) for r in S.within_retention(frame).collect()) == \
        [(1, at(59)), (1, at(61)), (15, at(1500))]
    fixed = S.within_retention(frame, now=F.lit(at(60)))
    assert sorted(r.bucket for r in fixed.where("resolution = 1").collect()) == [at(0), at(59), at(61)]


def test_snapshot_carries_over(rows):
    ddl = "probe_id string, has_id string, state string, event_time timestamp"
    before = rows(ddl, [("a", "h", "1", at(0)), ("b", "h", "1", at(9))])
    now = rows(ddl, [("a", "h2", "0", at(5)), ("b", "h", "0", at(2))])
    assert sorted((r.probe_id, r.state) for r in E.state_snapshot(now, before).collect()) == [("a", "0"), ("b", "1")]
