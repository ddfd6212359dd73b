"""Boxes: switched-on users, terminal counts and logins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.functions import rates as R
from viewpulse.model import D5
from viewpulse.operators.cube import additive_distinct_cube, cube_all
from viewpulse.operators.enrich import BROADCAST_BYTES, enrich_terminal, one_per_key

OFF = "0"


def switched_on(states: DataFrame) -> DataFrame:
    return states.where(F.col("state") != OFF)


def online_users(states: DataFrame, terminals: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = (),
                 limit: int = BROADCAST_BYTES) -> DataFrame:
    """Distinct boxes that were on.

    The boxes are reduced to one row each before the lookup, so the join never sees a busy box twice; and as the lookup
    gives each box one cell, the counts add up exactly over the levels.
    """
    boxes = switched_on(states).select(*fixed, "probe_id").distinct()
    placed = enrich_terminal(boxes, terminals, dims, limit)
    return cube_all(placed, dims, {"online_users": ("sum", F.lit(1).cast("bigint"))}, fixed)


def terminal_count(reports: DataFrame, dims: Sequence[str] = D5,
                   order: Sequence[str] = ("event_time", "seq")) -> DataFrame:
    """Devices of the current terminal table: the last report of each box counts."""
    current = one_per_key(reports, "probe_id", ["device_id", *dims], [F.col(c) for c in order])
    return additive_distinct_cube(current, dims, {"terminals": "device_id"})


def login_success(logins: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Successful over attempted logins; no row without attempts."""
    sums = cube_all(logins, dims, {"_suc": ("sum", F.col("suc_pages")), "_all": ("sum", F.col("pages"))}, fixed)
    return sums.where("_all <> 0").select(*fixed, *dims, R.rate4(F.col("_suc"), F.col("_all")).alias("succ_rate"))
