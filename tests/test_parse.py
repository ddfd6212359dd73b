"""Hand-made lines: good, short, wrong type, blank, bad number, trailing empties, limits, reserved word."""

import pytest
from pyspark.sql import functions as F

from viewpulse.model import DELIMITER, LOGS
from viewpulse.operators import parse as P


def line(log, width=None, **changes):
    layout = LOGS[log]
    fields = [""] * (width or layout.length)
    fields[0] = layout.code
    for name, (position, kind) in layout.fields.items():
        if position < len(fields):
            fields[position] = {"time": "20240101123000"}.get(kind, "7")
    for position in layout.needed("realtime") + layout.needed("offline"):
        if position < len(fields) and not fields[position]:
            fields[position] = "7"
    for name, value in changes.items():
        fields[int(name[1:]) if name[0] == "p" and name[1:].isdigit() else layout.fields[name][0]] = value
    return DELIMITER.join(fields)


def reasons(rows, log, lines, mode="realtime"):
    frame = rows("value string", [(v,) for v in lines])
    return [r[0] for r in P.parse_log(frame, log, mode).select(P.REASON).collect()]


@pytest.mark.parametrize("log", sorted(LOGS))
def test_accept_and_limits(rows, log):
    good = line(log)
    short = DELIMITER.join(good.split(DELIMITER)[:-1])
    other = line(log, p0="99")
    more = good + DELIMITER + DELIMITER
    assert reasons(rows, log, [good, short, other, more, "", LOGS[log].code]) == \
        [None, "length", "type", None, "type", "length"]


@pytest.mark.parametrize("log", sorted(k for k, v in LOGS.items() if v.required))
def test_required_fields(rows, log):
    layout = LOGS[log]
    lines = [line(log, **{f"p{p}": " "}) for p in layout.required]
    assert set(reasons(rows, log, lines)) == {"blank"}


def test_numbers(rows):
    assert reasons(rows, "epg", [line("epg", requests="x"), line("epg", page_suc_cnt="x")]) == ["value", None]
    assert reasons(rows, "epg", [line("epg", page_suc_cnt="x")], "offline") == ["value"]
    plays = [line("play_request", latency="x"), line("play_request", event_time="2024")]
    assert reasons(rows, "play_request", plays) == [None, "value"]
    assert reasons(rows, "play_request", plays, "offline") == ["value", "value"]


def test_reserved_word(rows):
    assert reasons(rows, "login", [line("login", platform="ALL"), line("login", platform="")]) == ["reserved", "blank"]


def test_values(rows):
    frame = rows("value string", [(line("play_request", probe_id=" box ", session_part="s1", down_bytes="12"),)])
    row = P.parse_valid(frame, "play_request").first()
    assert (row.has_id, row.probe_id, row.down_bytes) == ("boxs1", "box", 12)
    lag = P.parse_valid(rows("value string", [(line("lag", event_time="20240101123059"),)]), "lag")
    assert lag.select(F.date_format("event_time", "HHmmss")).first()[0] == "123000"


def test_rejects_keep_the_line(rows):
    parsed = P.parse_log(rows("value string", [("bad",), (line("login"),)]), "login")
    assert [tuple(r) for r in P.rejected_rows(parsed).collect()] == [("bad", "type")]
    assert P.valid_rows(parsed).count() == 1


def test_split_is_planned_once(rows):
    frame = rows("value string", [(line("epg"),)])
    plan = P.parse_valid(frame, "epg")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
