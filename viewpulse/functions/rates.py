"""Ratios, rounding and value bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewpulse.model import EPG_BANDS_US, FIRST_FRAME_CAP_US, STALL_BANDS_US_PER_S


def round4(value: Column) -> Column:
    """Four decimals, half to even."""
    return F.bround(value, 4)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; null for a zero whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rate4(part: Column, whole: Column) -> Column:
    return round4(ratio(part, whole))


def clamp_to_one(rate: Column) -> Column:
    return F.least(rate, F.lit(1.0))


def _divided(multiple: Column, by: Column) -> Column:
    """Quotient of a whole number and one that divides it, exact over the range of bigint."""
    return (multiple.cast("decimal(20,0)") / by.cast("decimal(20,0)")).cast("bigint")


def whole_mean(total: Column, count: Column) -> Column:
    """Mean cut to a whole number, exact beyond 2^53; null for a zero count."""
    by = F.nullif(count, F.lit(0))
    return _divided(total - F.pmod(total, by), by)


def micros_to_seconds(micros: Column) -> Column:
    """Whole seconds, cut towards zero as integer division does."""
    return _divided(micros - micros % 1_000_000, F.lit(1_000_000))


def in_range(value: Column, cap: int = FIRST_FRAME_CAP_US) -> Column:
    """``0 < value <= cap``."""
    return (value > 0) & (value <= cap)


def member(value: Column, accepted: Sequence[str]) -> Column:
    return value.isin(*accepted)


def stall_band(freeze: Column, seconds: Column) -> Column:
    """0 normal, 1 occasional, 2 more, 3 serious; null when the ratio is undefined and something froze."""
    _, low, high = STALL_BANDS_US_PER_S
    value = ratio(freeze, seconds)
    return (F.when(freeze == 0, 0)
            .when((value > 0) & (value <= low), 1)
            .when((value > low) & (value <= high), 2)
            .when(value > high, 3))


def epg_band(micros: Column) -> Column:
    """1..4 by response time; null for a negative time."""
    first, second, third = EPG_BANDS_US
    return (F.when(micros < 0, None).when(micros < first, 1).when(micros < second, 2)
            .when(micros < third, 3).otherwise(4))


def health(users: Column, serious: Column, more: Column, occasional: Column) -> Column:
    """Share of healthy users: serious users weigh 1, more 1/3, occasional 1/10; null without users."""
    return (F.lit(1.0) - ratio(serious, users) - ratio(more, users) / 3 - ratio(occasional, users) / 10)
