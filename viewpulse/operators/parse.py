"""Raw log lines to typed rows, with a reason on every rejected line.

Everything is a column expression: the split happens once per line, the checks and casts stay in generated code, and
later filters and projections reach the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.functions import text as X
from viewpulse.functions.timecols import parse_stamp
from viewpulse.model import ALL, D5, LOGS, LogLayout

REASON = "reject_reason"


def _cast(fields: Column, position: int, kind: str) -> Column:
    raw = X.field_at(fields, position)
    if kind == "count":
        return X.lenient_long(raw)
    if kind == "long":
        return X.strict_long(raw)
    if kind in ("time", "any_time"):
        return parse_stamp(raw)
    return F.coalesce(raw, F.lit(""))


def reject_reason(fields: Column, layout: LogLayout, mode: str = "realtime") -> Column:
    """Why a line is refused, null for a good one."""
    reason = (F.when(X.field_at(fields, 0) != layout.code, "type")
              .when(F.size(fields) < layout.length, "length"))
    blanks = [X.is_blank(X.field_at(fields, p)) for p in layout.needed(mode)]
    if blanks:
        reason = reason.when(reduce(Column.__or__, blanks), "blank")
    strict = [(column, position, layout.kind(column, mode)) for column, (position, _) in layout.fields.items()]
    bad = [_cast(fields, position, kind).isNull() for _, position, kind in strict if kind in ("long", "time")]
    if bad:
        reason = reason.when(reduce(Column.__or__, bad), "value")
    dims = [X.field_at(fields, layout.fields[d][0]) == ALL for d in D5 if d in layout.fields]
    if dims:
        reason = reason.when(reduce(Column.__or__, dims), "reserved")
    return reason


def parse_log(lines: DataFrame, log: str, mode: str = "realtime", column: str = "value") -> DataFrame:
    """Parse every line of ``column``; keeps other columns, adds the typed fields, the line and ``reject_reason``."""
    layout = LOGS[log]
    fields = F.col("_fields")
    kept = [F.col(c) for c in lines.columns]
    typed = [_cast(fields, position, layout.kind(name, mode)).alias(name)
             for name, (position, _) in layout.fields.items()]
    # a generator is a fence for the optimizer: without it the split would be copied into every check and cast
    parsed = (lines.select(*kept, F.explode(F.array(X.split_fields(F.col(column)))).alias("_fields"))
              .select(*kept, *typed, reject_reason(fields, layout, mode).alias(REASON)))
    if log == "play_request":
        parsed = parsed.withColumn("has_id", X.session_id(F.col("probe_id"), F.col("session_part")))
    if log == "lag":
        parsed = parsed.withColumn("event_time", F.date_trunc("minute", "event_time"))
    return parsed


def valid_rows(parsed: DataFrame, column: str = "value") -> DataFrame:
    return parsed.where(F.col(REASON).isNull()).drop(REASON, column)


def rejected_rows(parsed: DataFrame, column: str = "value") -> DataFrame:
    return parsed.where(F.col(REASON).isNotNull()).select(column, REASON)


def parse_valid(lines: DataFrame, log: str, mode: str = "realtime") -> DataFrame:
    return valid_rows(parse_log(lines, log, mode))
