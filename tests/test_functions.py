"""Scalar, band and calendar functions at their edges."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from viewpulse.functions import rates as R
from viewpulse.functions import text as X
from viewpulse.functions import timecols as T
from viewpulse.sources import periods as P


def one(frame):
    return frame.first()[0]


def values(rows, ddl, data, column):
    return [r[0] for r in rows(ddl, data).select(column).collect()]


def test_round_half_even_and_zero_whole(rows):
    got = values(rows, "a double", [(0.00005,), (0.00015,), (0.00025,), (1.23456,)], R.round4(F.col("a")))
    assert got == [0.0, 0.0002, 0.0002, 1.2346]
    assert values(rows, "a bigint, b bigint", [(1, 0), (1, 3)], R.rate4(F.col("a"), F.col("b"))) == [None, 0.3333]
    assert values(rows, "a double", [(0.5,), (1.5,)], R.clamp_to_one(F.col("a"))) == [0.5, 1.0]
    assert values(rows, "a bigint", [(1_999_999,), (-1_999_999,)], R.micros_to_seconds(F.col("a"))) == [1, -1]


def test_stall_band_edges(rows):
    data = [(0, 10), (0, 0), (1, 0), (10_000, 1), (10_001, 1), (50_000, 1), (50_001, 1), (100_000, 10)]
    got = values(rows, "f bigint, s bigint", data, R.stall_band(F.col("f"), F.col("s")))
    assert got == [0, 0, None, 1, 2, 2, 3, 1]


def test_latency_edges(rows):
    data = [(-1,), (0,), (99_999,), (100_000,), (299_999,), (300_000,), (1_999_999,), (2_000_000,)]
    assert values(rows, "t bigint", data, R.epg_band(F.col("t"))) == [None, 1, 1, 2, 2, 3, 3, 4]
    cap = [(0,), (1,), (50_000_000,), (50_000_001,)]
    assert values(rows, "t bigint", cap, R.in_range(F.col("t"))) == [False, True, True, False]


def test_health_range(rows):
    data = [(10, 0, 0, 0), (10, 10, 0, 0), (10, 0, 9, 1), (0, 0, 0, 0)]
    got = values(rows, "u bigint, s bigint, m bigint, o bigint", data,
                 R.health(F.col("u"), F.col("s"), F.col("m"), F.col("o")))
    assert got[0] == 1.0 and got[1] == 0.0 and abs(got[2] - 0.69) < 1e-12 and got[3] is None


def test_text_helpers(rows):
    assert values(rows, "v string", [("12",), ("x",), ("",), (None,)], X.lenient_long(F.col("v"))) == [12, 0, 0, 0]
    assert values(rows, "v string", [(" ",), (None,), (" a",)], X.is_blank(F.col("v"))) == [True, True, False]
    line = rows("v string", [("1\x7f\x7f2\x7f\x7f",)])
    assert one(line.select(F.size(X.split_fields(F.col("v"))))) == 5
    assert one(rows("a string, b string", [("x", "y")]).select(X.series_key("P", ["a", "b"], "R15"))) == "PR15#x#y"


@pytest.mark.parametrize("text, expected", [
    ("2024", datetime(2024, 1, 1)), ("202403", datetime(2024, 3, 1)), ("20240305", datetime(2024, 3, 5)),
    ("2024030506", datetime(2024, 3, 5, 6)), ("20240305060708", datetime(2024, 3, 5, 6, 7, 8))])
def test_appointed_time(rows, text, expected):
    assert one(rows("v string", [(text,)]).select(T.appointed_time(F.col("v")).cast("timestamp_ntz"))) == expected
    assert P.appointed(text) == expected


def test_stamp_parsing(rows):
    data = [("20240101123045",), ("202401011230",), ("2024010112",), ("20241301000000",), ("",)]
    got = values(rows, "v string", data, F.date_format(T.parse_stamp(F.col("v")), "HHmmss"))
    assert got == ["123045", "123000", None, None, None]
    assert values(rows, "v string", [("bad",)], T.epoch_millis(F.col("v"))) == [-1]


def test_quarter_hour_text(rows):
    data = [("202401010000",), ("202401010014",), ("202401010015",), ("202401010059",), ("2024010100xx",)]
    got = values(rows, "v string", data, T.quarter_hour_of_label(F.col("v")))
    assert got == ["202401010000", "202401010000", "202401010015", "202401010045", None]


@pytest.mark.parametrize("period, label, short", [
    ("HOUR", "202408150900", "2024081509"), ("DAY", "202408150000", "20240815"), ("WEEK", "202408120000", "2024083"),
    ("MONTH", "202408000000", "202408"), ("QUARTER", "202407000000", "202407"),
    ("HALFYEAR", "202407000000", "202407"), ("YEAR", "202400000000", "2024")])
def test_period_labels(rows, period, label, short):
    at = datetime(2024, 8, 15, 9, 41)
    frame = rows("t timestamp_ntz", [(at,)])
    assert one(frame.select(T.period_label(F.col("t"), period))) == label == P.label(period, at)
    assert one(frame.select(T.period_label_short(F.col("t"), period))) == short
    start, end = P.period_bounds(period, at)
    assert start <= at < end
    assert one(frame.select(T.period_start(F.col("t"), period).cast("timestamp_ntz"))) == start


def test_path_patterns():
    at = datetime(2024, 2, 28, 9, 41)
    assert P.path_patterns("log", "HOUR", at) == ["/2024/02/28/log-09-*"]
    assert P.path_patterns("log", "15MIN", at) == ["/2024/02/28/log-09-30-15minute*"]
    assert P.path_patterns("log", "DAY", at) == ["/2024/02/28/"]
    assert P.path_patterns("log", "WEEK", at) == ["/2024/02/{26,27,28,29}/", "/2024/03/{01,02,03}/"]
    assert P.path_patterns("log", "MONTH", at) == ["/2024/02/*/"]
    assert P.path_patterns("log", "QUARTER", at) == ["/2024/{01,02,03}/*/"]
    assert P.path_patterns("log", "HALFYEAR", datetime(2024, 9, 1)) == ["/2024/{07,08,09,10,11,12}/*/"]
    assert P.path_patterns("log", "YEAR", at) == ["/2024/*/*/"]
    with pytest.raises(ValueError):
        P.check_period("PEAK")


def test_previous_time():
    assert P.label("MONTH", P.previous_time("MONTH", datetime(2024, 3, 31, 5))) == "202402000000"
    assert P.label("WEEK", P.previous_time("WEEK", datetime(2024, 1, 3))) == "202312250000"
    assert P.previous_time("15MIN", datetime(2024, 1, 1, 0, 10)) == datetime(2023, 12, 31, 23, 40)
