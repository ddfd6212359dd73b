"""Play requests and play failures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.functions import rates as R
from viewpulse.model import D2, D5, FIRST_FRAME_CAP_US, HAS_TYPES
from viewpulse.operators.cube import (
    additive_distinct_cube, cube_all, exact_distinct_cube, no_null_dims,
)
from viewpulse.operators.series import period_increments

#: counters of a session that only grow
COUNTERS = ("down_bytes", "play_seconds", "freeze_time", "freeze_count")


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def accepted_types(df: DataFrame, accepted: Sequence[str] = HAS_TYPES) -> DataFrame:
    return df.where(R.member(F.col("has_type"), accepted))


def users_and_plays(latest: DataFrame, dims: Sequence[str] = D2, fixed: Sequence[str] = ()) -> DataFrame:
    """Distinct boxes and sessions, exact at every level; input is the latest record per session."""
    keys = (*fixed, *dims)
    none = F.lit(0).cast("bigint")
    users = exact_distinct_cube(latest, dims, "play_users", "probe_id", fixed).withColumn("plays", none)
    plays = exact_distinct_cube(latest, dims, "plays", "has_id", fixed).withColumn("play_users", none)
    return (users.unionByName(plays).groupBy(*keys).agg(F.sum("play_users").alias("play_users"), F.sum("plays").alias("plays"))
            .where("plays > 0"))


def play_totals(latest: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Sessions and stream users per finest cell, summed upwards."""
    return additive_distinct_cube(latest, dims, {"plays": "has_id", "play_users": "probe_id"}, fixed)


def first_frame(latest: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ("minute",),
                cap: int = FIRST_FRAME_CAP_US, accepted: Sequence[str] = HAS_TYPES) -> DataFrame:
    """Count, sum and whole mean of the first-frame latency."""
    usable = accepted_types(latest, accepted).where(R.in_range(F.col("latency"), cap))
    sums = cube_all(usable, dims, {"latency_count": ("sum", _one()), "latency_sum": ("sum", F.col("latency"))}, fixed)
    return sums.withColumn("latency_mean", R.whole_mean(F.col("latency_sum"), F.col("latency_count")))


def first_frame_mean(latest: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = (),
                     cap: int = FIRST_FRAME_CAP_US, accepted: Sequence[str] = HAS_TYPES) -> DataFrame:
    """Mean first-frame latency to four places."""
    sums = first_frame(latest, dims, fixed, cap, accepted)
    return sums.select(*fixed, *dims, R.rate4(F.col("latency_sum"), F.col("latency_count")).alias("latency"))


def stall_distribution(latest: DataFrame, dims: Sequence[str] = D2, fixed: Sequence[str] = (),
                       accepted: Sequence[str] = HAS_TYPES) -> DataFrame:
    """Users per stall band: frozen microseconds per downloaded second, summed per box."""
    users = (no_null_dims(accepted_types(latest, accepted), dims).groupBy(*fixed, *dims, "probe_id")
             .agg(F.sum("freeze_time").alias("_freeze"), F.sum("down_seconds").alias("_seconds")))
    band = users.withColumn("_band", R.stall_band(F.col("_freeze"), F.col("_seconds")))
    names = ("normal_users", "occasional_users", "more_users", "serious_users")
    measures = {name: ("sum", F.when(F.col("_band") == i, 1).otherwise(0).cast("bigint"))
                for i, name in enumerate(names)}
    return cube_all(band, dims, measures | {"users": ("sum", _one())}, fixed)


def stall_health(distribution: DataFrame) -> DataFrame:
    """Stalled users (more and serious) and the health figure."""
    users, serious = F.col("users"), F.col("serious_users")
    more, occasional = F.col("more_users"), F.col("occasional_users")
    return distribution.select("*", (serious + more).alias("fault_users"),
                               R.health(users, serious, more, occasional).alias("health"))


def stall_user_rate(distribution: DataFrame) -> DataFrame:
    """Stalled users and their share of all users."""
    fault = F.col("serious_users") + F.col("more_users")
    measures = ("normal_users", "occasional_users", "more_users", "serious_users", "users")
    kept = [c for c in distribution.columns if c not in measures]
    return distribution.select(*kept, fault.alias("fault_users"), R.rate4(fault, F.col("users")).alias("user_rate"))


def increments(plays: DataFrame, period: str, dims: Sequence[str] = D5, reset: str = "raw") -> DataFrame:
    """Per session, type and period: growth of the cumulative counters."""
    return period_increments(no_null_dims(plays, dims), period, dims, COUNTERS, reset=reset)


def traffic(grown: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Downloaded bytes of the period."""
    return cube_all(grown, dims, {"down_bytes": ("sum", F.col("down_bytes_delta"))}, fixed)


def service_online_time(grown: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Play seconds of the period by service type."""
    return cube_all(grown, dims, {"play_seconds": ("sum", F.col("play_seconds_delta"))}, (*fixed, "has_type"))


def business_quality(grown: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Frozen seconds, freezes and play seconds of the period, and exact distinct plays."""
    sums = exact_distinct_cube(grown, dims, "plays", "has_id", fixed, {
        "_freeze": ("sum", F.col("freeze_time_delta")), "freeze_count": ("sum", F.col("freeze_count_delta")),
        "play_seconds": ("sum", F.col("play_seconds_delta"))})
    return sums.select(*fixed, *dims, R.micros_to_seconds(F.col("_freeze")).alias("freeze_seconds"),
                       "freeze_count", "play_seconds", "plays")


def failures(fails: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ("minute",)) -> DataFrame:
    """Failed plays; all service types."""
    return cube_all(fails, dims, {"fail_count": ("sum", _one())}, fixed)


def play_success_rate(fails: DataFrame, plays: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = (),
                      accepted: Sequence[str] = HAS_TYPES) -> DataFrame:
    """(plays - failures) / plays where both exist.

    Both counts are brought to cells and stacked, so one cube serves both and no pair of cubes has to be joined.
    """
    failed = (no_null_dims(accepted_types(fails, accepted), dims).groupBy(*fixed, *dims)
              .agg(F.count(F.lit(1)).alias("_fails")).withColumn("_plays", F.lit(0).cast("bigint")))
    both = failed.unionByName(session_cells(plays, dims, fixed, "_plays").withColumn("_fails", _zero()))
    sums = cube_all(both, dims, {"_fails": ("sum", "_fails"), "_plays": ("sum", "_plays")}, fixed)
    return (sums.where("_fails > 0 and _plays > 0")
            .select(*fixed, *dims, R.rate4(F.col("_plays") - F.col("_fails"), F.col("_plays")).alias("play_succ_rate")))


def session_cells(df: DataFrame, dims: Sequence[str], fixed: Sequence[str], name: str) -> DataFrame:
    """Distinct sessions per finest cell."""
    return (no_null_dims(df, dims).select(*fixed, *dims, "has_id").where("has_id is not null").distinct()
            .groupBy(*fixed, *dims).agg(F.count(F.lit(1)).alias(name)))
