"""Stall behaviour: stalled plays, buffering rate and causes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.functions import rates as R
from viewpulse.functions.timecols import bucket_start
from viewpulse.model import D5, DENSE_CAUSES, SERIES_POINTS, STALL_CAUSES
from viewpulse.operators.cube import cube_all, dense_counts, exact_distinct_cube
from viewpulse.operators.series import last_points
from viewpulse.plans.play import session_cells


def natural_buffer_rate(lags: DataFrame, plays: DataFrame, dims: Sequence[str] = D5,
                        fixed: Sequence[str] = ()) -> DataFrame:
    """Stalled plays over all plays, at most 1, and 0 where plays are missing."""
    stalled = session_cells(lags, dims, fixed, "_stalled").withColumn("_plays", F.lit(0).cast("bigint"))
    played = session_cells(plays, dims, fixed, "_plays").withColumn("_stalled", F.lit(0).cast("bigint"))
    sums = cube_all(stalled.unionByName(played), dims, {"_stalled": ("sum", "_stalled"), "_plays": ("sum", "_plays")},
                    fixed)
    rate = F.coalesce(R.clamp_to_one(R.rate4(F.col("_stalled"), F.col("_plays"))), F.lit(0.0))
    rate = F.when(F.col("_plays") == 0, 0.0).otherwise(rate)
    return sums.where("_stalled > 0").select(*fixed, *dims, F.col("_stalled").alias("stalled_plays"),
                                             rate.alias("buffer_rate"))


def stalled_plays(first: DataFrame, minutes: int, dims: Sequence[str] = D5) -> DataFrame:
    """Distinct stalled sessions per bucket; input holds the first record per minute, session and box."""
    bucketed = first.withColumn("bucket", bucket_start(F.col("event_time"), minutes))
    return exact_distinct_cube(bucketed, dims, "lag_plays", "has_id", ("bucket",))


def cause_groups(lags: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Stalls per cause group; the total counts grouped causes only."""
    measures = {f"{group}_cnt": ("sum", F.when(F.col("export_id").isin(*ids), 1).otherwise(0).cast("bigint"))
                for group, ids in STALL_CAUSES.items()}
    sums = cube_all(lags, dims, measures, fixed)
    total = sum((F.col(name) for name in measures), F.lit(0).cast("bigint"))
    return sums.withColumn("cause_sum", total)


def cause_counts(lags: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Stalls per cause, cause always grouped."""
    return cube_all(lags, dims, {"lag_count": ("sum", F.lit(1).cast("bigint"))}, (*fixed, "export_id"))


def dense_cause_counts(lags: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = (),
                       weight: Column | None = None) -> DataFrame:
    """As :func:`cause_counts`, with zero rows for known causes a key has not seen; ``weight``: stalls of a row."""
    return dense_counts(lags, dims, "export_id", DENSE_CAUSES, "lag_count", fixed, weight)


def cause_counts_d6(lags: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Stalls with the cause as a further roll-up dimension."""
    return cube_all(lags, (*dims, "export_id"), {"lag_count": ("sum", F.lit(1).cast("bigint"))}, fixed)


def cause_series(lags: DataFrame, minutes: int = 60, dims: Sequence[str] = D5, n: int = SERIES_POINTS) -> DataFrame:
    """Newest points of the cause-group series."""
    bucketed = lags.withColumn("bucket", bucket_start(F.col("event_time"), minutes))
    return last_points(cause_groups(bucketed, dims, ("bucket",)), dims, "bucket", n)
