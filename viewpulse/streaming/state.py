"""Keyed state that SQL cannot express: previous-period values.

The processor sits behind a windowed aggregate, so a key hands over one small row per window however busy it is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from viewpulse.model import D2, PERIOD_TTL_S
from viewpulse.operators.cube import no_null_dims
from viewpulse.session import use_keyed_state
from viewpulse.streaming.windows import window_cells

COUNTERS = ("down_bytes", "play_seconds")

# the processor travels with the query, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _batch(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The few rows of one key in one micro-batch, oldest window first."""
    return pd.concat(list(rows), ignore_index=True).sort_values("bucket", kind="stable")


class PreviousValue(StatefulProcessor):
    """Cumulative counters to increments: subtract the value of the last window younger than the limit.

    A timer in event time drops the value of a session once no later window can use it, so state holds the sessions of
    the last ``ttl_s`` seconds only.
    """

    def __init__(self, ttl_s: int, dims: Sequence[str], counters: Sequence[str] = COUNTERS):
        self.ttl_s = ttl_s
        self.dims = list(dims)
        self.counters = list(counters)

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join(f"{c} bigint" for c in self.counters)
        self.handle = handle
        self.last = handle.getValueState("last", f"bucket_s bigint, {fields}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _batch(rows)
        held = self.last.get() if self.last.exists() else None
        out = []
        for bucket, group in frame.groupby("bucket", sort=True):
            seconds = int(bucket.timestamp())
            if held is not None and not 0 < seconds - held[0] < self.ttl_s:
                held = None
            for row in group.to_dict("records"):
                grown = {c: int(row[c]) - (int(held[i + 1]) if held is not None else 0)
                         for i, c in enumerate(self.counters)}
                out.append({"bucket": bucket, **{d: row[d] for d in self.dims}, "has_id": key[0], "has_type": key[1],
                            **{f"{c}_delta": v for c, v in grown.items()}})
            held = (seconds, *[int(group[c].max()) for c in self.counters])
        self.last.update(held)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((held[0] + self.ttl_s) * 1000)
        yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def increments_stream(plays: DataFrame, minutes: int = 5, dims: Sequence[str] = D2,
                      ttl_s: int = PERIOD_TTL_S["RT"]) -> DataFrame:
    """Growth of the cumulative counters per window, session and type (append mode)."""
    use_keyed_state(plays.sparkSession)
    maxima = [F.max(c).alias(c) for c in COUNTERS]
    cells = window_cells(no_null_dims(plays, dims), minutes, (*dims, "has_id", "has_type"), maxima)
    text = ", ".join(f"{d} string" for d in dims)
    schema = f"bucket timestamp, {text}, has_id string, has_type string, " + ", ".join(
        f"{c}_delta bigint" for c in COUNTERS)
    return cells.groupBy("has_id", "has_type").transformWithStateInPandas(
        PreviousValue(ttl_s, dims), outputStructType=schema, outputMode="Append", timeMode="EventTime")
