"""Calendar periods on the driver side: bounds, file patterns and partition filters."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewpulse.model import PERIOD_TTL_S, PERIODS

_MONTHS = {"MONTH": 1, "QUARTER": 3, "HALFYEAR": 6, "YEAR": 12}
_SPANS = {"15MIN": timedelta(minutes=15), "HOUR": timedelta(hours=1), "DAY": timedelta(days=1),
          "WEEK": timedelta(days=7)}


def check_period(period: str) -> str:
    name = period.upper()
    if name not in PERIODS:
        raise ValueError(f"period {period!r} is not one of {', '.join(PERIODS)}")
    return name


def add_months(at: datetime, months: int) -> datetime:
    """Month arithmetic for the first day of a month."""
    index = at.year * 12 + at.month - 1 + months
    return at.replace(year=index // 12, month=index % 12 + 1)


def period_bounds(period: str, at: datetime) -> tuple[datetime, datetime]:
    """First moment of the period holding ``at`` and first moment after it; weeks start on Monday."""
    name = check_period(period)
    day = at.replace(hour=0, minute=0, second=0, microsecond=0)
    if name in _MONTHS:
        width = _MONTHS[name]
        start = day.replace(day=1, month=(at.month - 1) // width * width + 1)
        return start, add_months(start, width)
    if name == "WEEK":
        start = day - timedelta(days=day.weekday())
    elif name == "DAY":
        start = day
    else:
        minute = at.minute - at.minute % 15 if name == "15MIN" else 0
        start = day.replace(hour=at.hour, minute=minute)
    return start, start + _SPANS[name]


def previous_time(period: str, now: datetime) -> datetime:
    """The time a run at ``now`` reports on: inside the period before (30 minutes back for 15MIN)."""
    name = check_period(period)
    if name == "15MIN":
        return now - timedelta(minutes=30)
    start, _ = period_bounds(name, now)
    return start - timedelta(microseconds=1)


def appointed(text: str) -> datetime:
    """``yyyy[MM[dd[HH[mm[ss]]]]]``; omitted month and day are 1, omitted time is 0."""
    return datetime.strptime(text + "00000101000000"[len(text):], "%Y%m%d%H%M%S")


def label(period: str, at: datetime) -> str:
    """Twelve-digit label of the period, zero below it."""
    name = check_period(period)
    start, _ = period_bounds(name, at)
    width = {"YEAR": 4, "HALFYEAR": 6, "QUARTER": 6, "MONTH": 6, "WEEK": 8, "DAY": 8, "HOUR": 10, "15MIN": 12}[name]
    return start.strftime("%Y%m%d%H%M")[:width].ljust(12, "0")


def path_patterns(prefix: str, period: str, at: datetime) -> list[str]:
    """Globs below a log root laid out ``/yyyy/MM/dd/<prefix>-HH-...`` that hold the period."""
    name = check_period(period)
    start, end = period_bounds(name, at)
    if name == "YEAR":
        return [f"/{start:%Y}/*/*/"]
    if name in _MONTHS:
        months = [add_months(start, i) for i in range(_MONTHS[name])]
        names = ",".join(f"{m:%m}" for m in months)
        return [f"/{start:%Y}/{{{names}}}/*/" if len(months) > 1 else f"/{start:%Y/%m}/*/"]
    if name == "WEEK":
        days: dict[str, list[str]] = {}
        for i in range(7):
            day = start + timedelta(days=i)
            days.setdefault(f"{day:%Y/%m}", []).append(f"{day:%d}")
        return [f"/{month}/{{{','.join(d)}}}/" for month, d in days.items()]
    if name == "DAY":
        return [f"/{start:%Y/%m/%d}/"]
    quarter = f"{start:%M}-15minute" if name == "15MIN" else ""
    return [f"/{start:%Y/%m/%d}/{prefix}-{start:%H}-{quarter}*"]


def partition_filter(start: datetime, end: datetime, moment: Column) -> Column:
    """Rows of [start, end) in a table partitioned by ``dt`` (yyyyMMdd) and ``hr`` (HH).

    The conditions on the partition columns prune directories; the one on ``moment`` cuts inside an hour.
    """
    last = end - timedelta(microseconds=1)
    days = F.col("dt").between(f"{start:%Y%m%d}", f"{last:%Y%m%d}")
    if start.date() == last.date():
        days = days & F.col("hr").between(f"{start:%H}", f"{last:%H}")
    return days & (moment >= F.lit(start).cast("timestamp_ntz")) & (moment < F.lit(end).cast("timestamp_ntz"))


def lookback(period: str, at: datetime) -> datetime:
    """Earliest time whose counters may still count as the previous value of the period."""
    start, _ = period_bounds(period, at)
    return start - timedelta(seconds=PERIOD_TTL_S[check_period(period)])
