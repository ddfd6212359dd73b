"""Streams without a closing time: partial results are stored per key, merged whenever they come, and published again.

A micro-batch reduces its rows to cells (sums, maxima, first or latest records per key) and stores them as one delta of a
:class:`MergedTable`.  Then the buckets it has touched are read from the table and their results published anew.  Rows may
come as late and in whatever order they like; the newest windows are published as they stand, so nothing waits for a
window to close, and a finite stream needs no flush.  A replayed micro-batch overwrites its own delta and results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewpulse.model import RESOLUTIONS
from viewpulse.session import REMOVE_SHUFFLES, passing_session
from viewpulse.sinks.keyed import BucketTable, MergedTable, few

#: micro-batches after which a table is folded
FOLD = 50


def window_start(ts: Column, minutes: int) -> Column:
    """Start of the window of any number of minutes, as a timestamp."""
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(minutes * 60)))


def within(current: DataFrame, buckets: DataFrame, minutes: int, grain: int | None = None) -> DataFrame:
    """Cells of the given buckets of a resolution, with ``bucket`` brought to it.

    The buckets of one micro-batch are few, as many as the windows it has rows of.  Where the resolution is the ``grain`` of
    the cells they keep their bucket, and with it the place they were merged at.
    """
    if minutes != grain:
        current = current.withColumn("bucket", window_start(F.col("bucket"), minutes))
    return current.join(few(buckets), "bucket", "left_semi")


@dataclass(frozen=True)
class MergeJob:
    """``minutes``: grain of the cells.  ``cells``: rows with ``bucket`` to cells.  ``merge``: cells of several micro-batches to
    one per key.  ``publish``: results of the touched buckets, by table name without the resolution; it gets all current
    cells, the buckets and the minutes of the resolution, so that it may look at earlier buckets too (and at later ones that
    change with them)."""

    minutes: int
    cells: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    publish: Callable[[DataFrame, DataFrame, int], Mapping[str, DataFrame]]
    resolutions: tuple[int, ...] = tuple(RESOLUTIONS)

    def suffix(self, minutes: int) -> str:
        return f"_{minutes}m" if len(self.resolutions) > 1 else ""


def merging_query(spark: SparkSession, job: MergeJob, rows: DataFrame, root: str, name: str, trigger: dict,
                  resolutions: Iterable[int] | None = None, retention: Mapping[int, str] | None = None) -> StreamingQuery:
    """Run a job over a stream with ``event_time``.

    With ``retention`` (minutes of a resolution to an interval) results older than it, counted back from the newest bucket,
    go when tables are folded, and so do the cells that no kept result needs.  Rows that come in older than that are stored
    in ``name_expired``, as there is nothing left to merge them with.

    What a micro-batch shuffles is removed when the write that needed it has ended.
    """
    spark = passing_session(spark)
    table = MergedTable(spark, f"{root}/{name}_cells", job.merge)
    chosen = tuple(job.resolutions if resolutions is None else resolutions)

    def write(batch: DataFrame, number: int) -> None:
        batch.sparkSession.conf.set(REMOVE_SHUFFLES, "true")  # the session of this stream alone
        own = job.cells(batch.withColumn("bucket", window_start(F.col("event_time"), job.minutes)))
        kept = None
        if retention and table.exists(number):
            newest = table.read(number).agg(F.max("bucket")).first()[0]
            oldest = [F.lit(newest) - F.expr(f"interval {interval_for(retention, m)}") for m in chosen]
            floor = window_start(F.least(*oldest) if len(oldest) > 1 else oldest[0], max(chosen))
            kept = F.col("bucket") >= floor
            own.where(~kept).write.mode("overwrite").parquet(f"{root}/{name}_expired/level=delta/batch={number}")
            own = own.where(kept)
        table.compact_every(FOLD, number, kept)
        table.write_batch(own, number)
        touched = table.written(number).select("bucket").distinct()
        current = table.read(number + 1)
        for minutes in chosen:
            buckets = touched.select(window_start(F.col("bucket"), minutes).alias("bucket")).distinct()
            for kind, result in job.publish(current, buckets, minutes).items():
                out = BucketTable(spark, f"{root}/realtime_{kind}{job.suffix(minutes)}")
                if retention and out.exists(number):
                    out.compact_every(FOLD, number, retained(out.read(number), interval_for(retention, minutes)))
                else:
                    out.compact_every(FOLD, number)
                out.write_batch(result, number)

    return (rows.writeStream.queryName(name).foreachBatch(write)
            .option("checkpointLocation", f"{root}/_checkpoints/{name}").trigger(**trigger).start())


def interval_for(retention: Mapping[int, str], minutes: int) -> str:
    """The retention of the next resolution that is not finer."""
    return retention[min((m for m in retention if m >= minutes), default=max(retention))]


def retained(table: DataFrame, interval: str) -> Column:
    """Whether a bucket is at most ``interval`` older than the newest of the table."""
    newest = table.agg(F.max("bucket")).first()[0]
    return F.col("bucket") >= F.lit(newest) - F.expr(f"interval {interval}")
