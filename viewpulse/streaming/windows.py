"""Event-time windows behind a watermark, in-stream dedup and late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WATERMARK = "1 hour"


def with_watermark(rows: DataFrame, delay: str = WATERMARK, time: str = "event_time") -> DataFrame:
    """Event time as a timestamp (watermarks refuse the zone-less type), with a watermark."""
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def window_cells(rows: DataFrame, minutes: int, keys: Sequence[str], aggregates: Sequence[Column],
                 time: str = "event_time") -> DataFrame:
    """One row per window and key; in append mode all rows of a window come out together when it closes."""
    cells = rows.groupBy(F.window(time, f"{minutes} minutes"), *keys).agg(*aggregates)
    names = [c for c in cells.columns if c not in ("window", *keys)]
    return cells.select(F.col("window.start").alias("bucket"), *keys, *names)


def first_per_minute(rows: DataFrame) -> DataFrame:
    """First arrival per (minute, session, box); repeats inside the watermark are dropped."""
    minute = F.date_trunc("minute", F.col("event_time"))
    return (rows.withColumn("_minute", minute)
            .dropDuplicatesWithinWatermark(["_minute", "has_id", "probe_id"]).drop("_minute"))


def late_rows(batch: DataFrame, limit: Column, time: str = "event_time") -> DataFrame:
    """Rows of a micro-batch older than the watermark ``limit``: windows no longer take them."""
    return batch.where(F.col(time) < limit)
