"""Calendar columns: buckets, period labels and differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = "yyyyMMddHHmmss"
_TRUNC = {"HOUR": "hour", "DAY": "day", "WEEK": "week", "MONTH": "month", "QUARTER": "quarter", "YEAR": "year"}
#: Java-style width of the significant part of a period label
_LABEL_WIDTH = {"YEAR": 4, "HALFYEAR": 6, "QUARTER": 6, "MONTH": 6, "WEEK": 8, "DAY": 8, "HOUR": 10, "15MIN": 12}


def parse_stamp(text: Column) -> Column:
    """``yyyyMMddHHmm[ss]`` to a timestamp; null when shorter or not a time."""
    padded = F.rpad(F.substring(text, 1, 14), 14, "0")
    return F.when(F.length(text) >= 12, F.try_to_timestamp(padded, F.lit(STAMP)))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP)


def minute_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm")


def bucket_start(ts: Column, minutes: int) -> Column:
    """Start of the 1-, 15- or 60-minute bucket."""
    if minutes == 1:
        return F.date_trunc("minute", ts)
    if minutes == 60:
        return F.date_trunc("hour", ts)
    if 60 % minutes:
        raise ValueError(f"{minutes} minutes do not divide an hour")
    hour = F.date_trunc("hour", ts)
    return hour + F.make_dt_interval(mins=F.minute(ts) - F.minute(ts) % minutes)


def bucket_label(ts: Column, minutes: int) -> Column:
    return minute_label(bucket_start(ts, minutes))


def quarter_hour_of_label(label: Column) -> Column:
    """Quarter-hour label of a minute label given as text."""
    minute = F.substring(label, 11, 2).try_cast("int")
    quarter = F.format_string("%02d", minute - minute % 15)
    return F.when(minute.between(0, 59), F.concat(F.substring(label, 1, 10), quarter))


def period_start(ts: Column, period: str) -> Column:
    """First moment of the calendar period; weeks start on Monday."""
    if period in _TRUNC:
        return F.date_trunc(_TRUNC[period], ts)
    if period == "HALFYEAR":
        return F.date_trunc("month", ts - F.make_ym_interval(months=(F.month(ts) - 1) % 6))
    if period == "15MIN":
        return bucket_start(ts, 15)
    raise ValueError(f"unknown period {period!r}")


def period_label(ts: Column, period: str) -> Column:
    """Twelve-digit label of the period, zero below it (YEAR -> ``yyyy00000000``)."""
    width = _LABEL_WIDTH[period]
    digits = F.substring(minute_label(period_start(ts, period)), 1, width)
    if period in ("MONTH", "QUARTER", "HALFYEAR", "YEAR", "WEEK", "DAY", "HOUR"):
        return F.rpad(digits, 12, "0")
    return digits


def period_label_short(ts: Column, period: str) -> Column:
    """Label without zero fill; a week is month plus week of month."""
    if period == "WEEK":
        first = F.date_trunc("month", ts)
        offset = (F.dayofweek(first) + 5) % 7
        week = F.floor((F.dayofmonth(ts) + offset - 1) / 7) + 1
        return F.concat(F.date_format(ts, "yyyyMM"), week.cast("string"))
    if period == "15MIN":
        return F.date_format(ts, "yyyyMMddHH")
    return F.substring(minute_label(period_start(ts, period)), 1, _LABEL_WIDTH[period])


def previous_period(ts: Column, period: str) -> Column:
    """The time one period back; a 15-minute run looks 30 minutes back."""
    steps = {
        "15MIN": F.make_dt_interval(mins=F.lit(30)),
        "HOUR": F.make_dt_interval(hours=F.lit(1)),
        "DAY": F.make_dt_interval(days=F.lit(1)),
        "WEEK": F.make_dt_interval(days=F.lit(7)),
        "MONTH": F.make_ym_interval(months=F.lit(1)),
        "QUARTER": F.make_ym_interval(months=F.lit(3)),
        "HALFYEAR": F.make_ym_interval(months=F.lit(6)),
        "YEAR": F.make_ym_interval(years=F.lit(1)),
    }
    return ts - steps[period]


def appointed_time(text: Column) -> Column:
    """``yyyy[MM[dd[HH[mm[ss]]]]]`` to a timestamp; omitted month and day are 1, omitted time is 0."""
    fill = F.lit("00000101000000")
    padded = F.concat(text, F.substring(fill, F.length(text) + 1, F.lit(14)))
    return F.try_to_timestamp(padded, F.lit(STAMP))


def epoch_millis(text: Column, pattern: str = STAMP) -> Column:
    """Epoch milliseconds of a time text, -1 when it cannot be read."""
    return F.coalesce(F.unix_millis(F.try_to_timestamp(text, F.lit(pattern))), F.lit(-1).cast("bigint"))


def add_days(ts: Column, days: int) -> Column:
    return ts + F.make_dt_interval(days=F.lit(days))


def add_months(ts: Column, months: int) -> Column:
    return ts + F.make_ym_interval(months=F.lit(months))


def difference(unit: str, a: Column, b: Column) -> Column:
    """Absolute whole difference in ``HOUR``, ``DAY`` or ``SECOND`` units."""
    return F.abs(F.timestamp_diff(unit, a, b))


def second_of_day(ts: Column) -> Column:
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("bigint")


def from_second_of_day(base: Column, seconds: Column) -> Column:
    return F.date_trunc("day", base) + F.make_dt_interval(secs=seconds)
