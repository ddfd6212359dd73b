"""Counters of sessions kept between batch runs, so that a run reads the log of its own period only.

One folder per period holds the greatest counters per session, type and area.  Increments of a period come from its folder and
from those that its earlier values may lie in; a rerun writes its folder again.  A period that has never been run is made
up from the log when a later one needs it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.model import D5, PERIOD_TTL_S
from viewpulse.operators.cube import no_null_dims
from viewpulse.operators.series import cell_increments, period_cells
from viewpulse.plans.play import COUNTERS
from viewpulse.sources import periods
from viewpulse.sources.hadoop import matching, remove


class CounterSnapshots:
    def __init__(self, spark: SparkSession, root: str, period: str, dims: Sequence[str] = D5):
        self.spark = spark
        self.period = periods.check_period(period)
        self.root = f"{root.rstrip('/')}/{self.period}"
        self.dims = list(dims)

    def _folder(self, start: datetime) -> str:
        return f"{self.root}/start={start:%Y%m%d%H%M}"

    def kept(self) -> set[datetime]:
        """First moments of the periods with a finished folder."""
        found = matching(self.spark, f"{self.root}/start=*/_SUCCESS")
        return {datetime.strptime(path.split("/")[-2].split("=")[1], "%Y%m%d%H%M") for path in found}

    def looked_back_at(self, start: datetime) -> list[datetime]:
        """First moments of the earlier periods whose values still count for the one that begins at ``start``."""
        out, moment = [], start
        while True:
            moment, _ = periods.period_bounds(self.period, moment - timedelta(microseconds=1))
            if (start - moment).total_seconds() >= PERIOD_TTL_S[self.period]:
                return out
            out.append(moment)

    def store(self, rows: DataFrame, start: datetime) -> None:
        """Keep the counters of the period that begins at ``start``; ``rows`` are its log rows and no others."""
        cells = period_cells(no_null_dims(rows, self.dims), self.period, self.dims, COUNTERS)
        cells.write.mode("overwrite").parquet(self._folder(start))

    def increments(self, rows_of: Callable[[datetime], DataFrame], start: datetime) -> DataFrame:
        """Increments of the period that begins at ``start``, after its counters have been stored.

        ``rows_of`` gives the log rows of the period that begins at a time; it is asked for this one and for those
        looked back at that have no folder.
        """
        before, kept = self.looked_back_at(start), self.kept()
        for moment in (*[b for b in before if b not in kept], start):
            self.store(rows_of(moment), moment)
        cells = self.spark.read.parquet(*[self._folder(m) for m in (*before, start)])
        grown = cell_increments(cells, self.dims, COUNTERS, PERIOD_TTL_S[self.period])
        return grown.where(F.col("period_start").cast("timestamp_ntz") == F.lit(start).cast("timestamp_ntz"))

    def expire(self, start: datetime) -> None:
        """Remove the folders that neither the period beginning at ``start`` nor a later one looks back at."""
        needed = min([start, *self.looked_back_at(start)])
        remove(self.spark, [self._folder(m) for m in self.kept() if m < needed])
