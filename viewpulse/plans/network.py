"""Network events and HTTP errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.functions import rates as R
from viewpulse.model import D2, D5, EVENT_CATEGORIES, EVENT_IDS, RESOLUTIONS
from viewpulse.operators.cube import Measures, cube_all
from viewpulse.operators.series import multi_resolution


def accepted_events(events: DataFrame, accepted: Sequence[str] = EVENT_IDS) -> DataFrame:
    return events.where(R.member(F.col("event_id"), accepted))


def event_trend(events: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ("minute",)) -> DataFrame:
    """Events per id, id always grouped."""
    return cube_all(events, dims, {"count_sum": ("sum", F.col("cnt"))}, (*fixed, "event_id"))


def event_trend_d6(events: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = (),
                   accepted: Sequence[str] = EVENT_IDS) -> DataFrame:
    """Events with the id as a further roll-up dimension; accepted ids only."""
    return cube_all(accepted_events(events, accepted), (*dims, "event_id"), {"count_sum": ("sum", F.col("cnt"))}, fixed)


def category_measures(ids: Sequence[str] = EVENT_IDS) -> Measures:
    """One column per event id and per category: conditional sums instead of a pivot, one pass."""
    def of(*members: str):
        return F.when(F.col("event_id").isin(*members), F.col("cnt")).otherwise(0).cast("bigint")
    per_id = {f"event{i}": ("sum", of(i)) for i in ids}
    return per_id | {name: ("sum", of(*members)) for name, members in EVENT_CATEGORIES.items()}


def event_categories(events: DataFrame, dims: Sequence[str] = D5,
                     resolutions: dict[int, str] = RESOLUTIONS) -> DataFrame:
    """Wide event counts and category totals at 1, 15 and 60 minutes."""
    return multi_resolution(events, dims, category_measures(), (), resolutions)


def event_resolutions(events: DataFrame, dims: Sequence[str] = D5,
                      resolutions: dict[int, str] = RESOLUTIONS) -> DataFrame:
    return multi_resolution(events, dims, {"count_sum": ("sum", F.col("cnt"))}, ("event_id",), resolutions)


def http_errors(errors: DataFrame, dims: Sequence[str] = D2, fixed: Sequence[str] = ()) -> DataFrame:
    """Errors per status code."""
    return cube_all(errors, dims, {"total": ("sum", F.col("cnt"))}, (*fixed, "http_rsp_code"))
