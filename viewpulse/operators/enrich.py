"""Terminal lookup, unknown-area repair, latest records and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from viewpulse.model import D2, D5, UNKNOWN_PROVINCE

#: a lookup whose planned size is above this is joined by shuffle
BROADCAST_BYTES = 64 * 1024 * 1024
#: copies of the lookup in the shuffled join, so that one box may own a third of the facts
SALTS = 16
#: room left for decompression: planned sizes of file scans are bytes on disk
_EXPANSION = 4


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; an upper estimate for scans, filters and joins without column statistics."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return planned_bytes(df) * _EXPANSION <= limit


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner",
                limit: int = BROADCAST_BYTES, salts: int = SALTS) -> DataFrame:
    """Join facts to a lookup holding one row per key.

    The lookup is broadcast only when its size is checked to be small.  Otherwise both sides shuffle on (key, salt): the
    salt comes from the fact row itself, so it is the same when a task is rerun, and the facts of a hot key spread over
    ``salts`` partitions.
    """
    if is_small(lookup, limit):
        return facts.join(F.broadcast(lookup), key, how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def one_per_key(lookup: DataFrame, key: str, columns: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Last record per key; ``order`` is ascending and must be total for a stable choice."""
    ranked = Window.partitionBy(key).orderBy(*[c.desc() for c in order or [F.col(c) for c in columns]])
    return (lookup.select("*", F.row_number().over(ranked).alias("_rn")).where("_rn = 1")
            .select(key, *columns))


def enrich_terminal(facts: DataFrame, terminals: DataFrame, columns: Sequence[str] = D5,
                    limit: int = BROADCAST_BYTES) -> DataFrame:
    """Inner lookup by box: adds ``columns``; facts of unknown boxes are dropped."""
    kept = [c for c in facts.columns if c not in columns]
    return lookup_join(facts.select(*kept), terminals.select("probe_id", *columns), "probe_id", "inner", limit)


def repair_area(facts: DataFrame, terminals: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of the unknown province take province and city from the lookup; boxes it lacks keep their values.

    With a small lookup this is one broadcast pass.  With a large one only the unknown rows are shuffled; rows whose
    area is known never move.
    """
    columns = facts.columns
    area = terminals.select("probe_id", *[F.col(d).alias(f"_{d}") for d in D2])
    unknown = F.col("province_id") == UNKNOWN_PROVINCE
    repaired = [F.when(unknown, F.coalesce(F.col(f"_{c}"), F.col(c))).otherwise(F.col(c)).alias(c)
                if c in D2 else F.col(c) for c in columns]
    if is_small(area, limit):
        return facts.join(F.broadcast(area), "probe_id", "left").select(*repaired)
    known = facts.where(~F.coalesce(unknown, F.lit(False)))
    fixed = lookup_join(facts.where(unknown), area, "probe_id", "left", limit).select(*repaired)
    return known.unionByName(fixed)


def latest_per_session(plays: DataFrame, distinct: bool = True, key: Sequence[str] = ("has_id",),
                       time: str = "event_time") -> DataFrame:
    """The rows of each session at its last time, ties kept; ``distinct`` removes equal rows.

    One scan: the rank limit is applied before the shuffle as well, so a session holding a third of all rows sends the
    rows of its last times only.
    """
    last = Window.partitionBy(*key).orderBy(F.col(time).desc())
    latest = (plays.where(F.col(time).isNotNull()).withColumn("_rank", F.rank().over(last)).where("_rank <= 1")
              .select(*plays.columns))
    return latest.distinct() if distinct else latest


def state_snapshot(states: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Last state record per box; ``previous`` is the snapshot carried over from the period before."""
    columns = ["probe_id", "has_id", "state", "event_time"]
    rows = states.select(*columns)
    if previous is not None:
        rows = rows.unionByName(previous.select(*columns))
    order = [F.col("event_time"), F.col("has_id"), F.col("state")]
    return one_per_key(rows, "probe_id", columns[1:], order)


def union_logs(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
