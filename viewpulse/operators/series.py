"""Time series of indicators: bounded length, resolutions, retention, increments, changes and on/off state."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from viewpulse.functions.timecols import bucket_start, period_start
from viewpulse.model import ALL, PERIOD_TTL_S, RESOLUTIONS, SERIES_POINTS
from viewpulse.operators.cube import LATTICE_TIMES, Measures, no_null_dims, numbered_levels, place_partitions


def last_points(points: DataFrame, key: Sequence[str], time: str = "index_time",
                n: int = SERIES_POINTS) -> DataFrame:
    """Newest ``n`` points of every series; the rank limit is applied map-side before the shuffle."""
    newest = Window.partitionBy(*key).orderBy(F.col(time).desc())
    return points.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n).drop("_rn")


def json_lists(points: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One JSON list per series, oldest point first; meant for series already cut by :func:`last_points`."""
    point = F.struct(*columns)
    return (points.groupBy(*key)
            .agg(F.to_json(F.array_sort(F.collect_list(point))).alias("points")))


def hour_slice(points: DataFrame, time: str = "index_time") -> DataFrame:
    """Per province (all cities): the points of that province's newest label."""
    area = points.where((F.col("province_id") != "ALL") & (F.col("city_id") == "ALL"))
    newest = Window.partitionBy("province_id", "city_id").orderBy(F.col(time).desc())
    return area.withColumn("_rk", F.rank().over(newest)).where("_rk = 1").drop("_rk")


def first_per_minute(lags: DataFrame, order: Sequence[str] = ("event_time", "seq")) -> DataFrame:
    """First record per (minute, session, box) wins.  The limit runs map-side, so repeats do not pile up."""
    minute = F.date_trunc("minute", F.col("event_time"))
    first = Window.partitionBy("_minute", "has_id", "probe_id").orderBy(*order)
    return (lags.withColumn("_minute", minute).withColumn("_rn", F.row_number().over(first))
            .where("_rn = 1").drop("_rn", "_minute"))


def multi_resolution(df: DataFrame, dims: Sequence[str], measures: Measures, fixed: Sequence[str] = (),
                     resolutions: Mapping[int, str] = RESOLUTIONS) -> DataFrame:
    """Sums per 1-, 15- and 60-minute bucket, long form with a ``resolution`` column.

    Each log row is read and shuffled once, at one-minute cells, and only those are shuffled on: the cells of a bucket of the
    coarsest resolution come together, so that coarser cells and all levels are summed where they lie.  Rates belong after
    this step.
    """
    df, chosen = no_null_dims(df, dims), sorted(resolutions)
    coarsest = chosen[-1] if all(chosen[-1] % m == 0 for m in chosen) else 60
    finest = (df.withColumn("bucket", bucket_start(F.col("event_time"), 1))
              .groupBy("bucket", *fixed, *dims)
              .agg(*[_sum(how, value).alias(name) for name, (how, value) in measures.items()]))
    labelled = finest.withColumn("_label", bucket_start(F.col("bucket"), coarsest))
    out = None
    for own in _resolution_levels(labelled, dims, fixed, measures, chosen):
        out = own if out is None else out.unionByName(own)
    return out.select("resolution", "bucket", *fixed, *dims, *measures)


def _resolution_levels(cells: DataFrame, dims: Sequence[str], fixed: Sequence[str], names: Iterable[str],
                       resolutions: Sequence[int]) -> Iterator[DataFrame]:
    """All levels of one-minute cells at each resolution, in parts.

    Cells come together by their ``_label`` and the first dimension, so that a label spreads over as many tasks as that has
    values; the levels with this dimension are summed there.  For those without it the cells go on without it, and so on
    down to three dimensions, which have few cells a label and need no such spread.
    """
    sums = [F.sum(name).alias(name) for name in names]
    left, times, met = list(dims), 1, cells
    while True:
        spread = left[:1] if len(left) > 3 else []
        placed = met.repartition(place_partitions(met, times), "_label", *spread)
        # the label stays a key: by it Spark knows that equal cells lie together
        here = placed if left == list(dims) else placed.groupBy("_label", "bucket", *fixed, *left).agg(*sums)
        rolled = [F.lit(ALL).alias(d) for d in dims if d not in left]
        for minutes in resolutions:
            own = here if minutes == 1 else (here.withColumn("bucket", bucket_start(F.col("bucket"), minutes))
                                             .groupBy("_label", "bucket", *fixed, *left).agg(*sums))
            expanded = [d for d in left if d not in spread]
            if expanded:
                own = (numbered_levels(own, expanded).groupBy("_label", "bucket", *fixed, *left, "_level").agg(*sums))
            yield own.select(F.lit(minutes).alias("resolution"), "bucket", *fixed, *left, *rolled, *names)
        if not spread:
            return
        # all cells differ before a dimension is gone: the second round reads what the first has read
        met = (met if left == list(dims) else here).drop(*spread)
        left, times = left[1:], times * LATTICE_TIMES


def _sum(how: str, value: Column | str) -> Column:
    if how != "sum":
        raise ValueError("resolutions merge sums only")
    return F.sum(value)


def within_retention(points: DataFrame, bucket: str = "bucket", resolution: str = "resolution",
                     resolutions: Mapping[int, str] = RESOLUTIONS, now: Column | None = None) -> DataFrame:
    """Drop buckets older than the retention of their resolution, counted back from ``now``.

    Without ``now`` the newest bucket of each resolution counts: a handful of rows, joined back by broadcast.
    """
    if now is not None:
        limits = F.coalesce(*[F.when(F.col(resolution) == r, now - F.expr(f"interval {keep}"))
                              for r, keep in resolutions.items()])
        return points.where(F.col(bucket) >= limits)
    newest = points.where(F.col(resolution).isin(*resolutions)).groupBy(resolution).agg(F.max(bucket).alias("_newest"))
    keep = F.coalesce(*[F.when(F.col(resolution) == r, F.col("_newest") - F.expr(f"interval {k}"))
                        for r, k in resolutions.items()])
    # one row per resolution, at most len(resolutions) of them
    oldest = newest.select(resolution, keep.alias("_oldest"))
    return (points.join(F.broadcast(oldest), resolution).where(F.col(bucket) >= F.col("_oldest"))
            .drop("_oldest"))


def period_increments(df: DataFrame, period: str, dims: Sequence[str], counters: Sequence[str],
                      key: Sequence[str] = ("has_id", "has_type"), time: str = "event_time",
                      reset: str = "raw") -> DataFrame:
    """Cumulative counters to increments per period.

    The counter of a session in a period is its maximum.  The increment subtracts the session's latest earlier value
    that is younger than twice the period; after a longer gap the whole value counts again.  ``reset='full'`` counts the
    whole value as well when a counter went down; ``raw`` keeps the negative difference.

    The maximum combines map-side, so a window partition holds one row per session, period and area, however many log
    rows the session wrote.  Rows lie by the first key alone, so that what is counted per session later needs no further shuffle.
    """
    cells = period_cells(df, period, dims, counters, key, time).repartition(key[0])
    return cell_increments(cells, dims, counters, PERIOD_TTL_S[period], key, reset)


def period_cells(df: DataFrame, period: str, dims: Sequence[str], counters: Sequence[str],
                 key: Sequence[str] = ("has_id", "has_type"), time: str = "event_time") -> DataFrame:
    """Greatest counters per ``_period`` (its start in seconds), session and area."""
    start = period_start(F.col(time), period)
    return (df.withColumn("_period", F.unix_seconds(start.cast("timestamp")))
            .groupBy("_period", *dims, *key)
            .agg(*[F.max(c).alias(c) for c in counters]))


def cell_increments(cells: DataFrame, dims: Sequence[str], counters: Sequence[str], ttl: int,
                    key: Sequence[str] = ("has_id", "has_type"), reset: str = "raw") -> DataFrame:
    """The increments of :func:`period_increments` for cells that hold the maxima of each ``_period`` (its start in seconds)."""
    earlier = Window.partitionBy(*key).orderBy("_period").rangeBetween(-(ttl - 1), -1)
    before = {c: F.max(F.struct(F.col("_period"), F.col(c))).over(earlier)[c] for c in counters}
    held = cells.select("*", *[value.alias(f"_{c}") for c, value in before.items()])
    out = []
    for c in counters:
        change = F.col(c) - F.coalesce(F.col(f"_{c}"), F.lit(0))
        if reset == "full":
            change = F.when(F.col(c) < F.col(f"_{c}"), F.col(c)).otherwise(change)
        out.append(change.cast("bigint").alias(f"{c}_delta"))
    return held.select(F.timestamp_seconds("_period").alias("period_start"), *dims, *key, *counters, *out)


def changed_records(reports: DataFrame, key: str, columns: Sequence[str], order: Sequence[str],
                    bucket: Column | None = None) -> DataFrame:
    """Reports whose ``columns`` differ from the report before (the first report of a key counts as a change).

    Done in two levels so that no task has to sort the whole history of one busy key: inside time buckets first (by
    default days), then between the last record of a bucket and the first of the next, one row per key and bucket.
    """
    bucket = F.date_trunc("day", F.col(order[0])) if bucket is None else bucket
    df = reports.withColumn("_bucket", bucket).withColumn("_record", F.struct(*columns))
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    marked = df.select("*", F.lag("_record").over(inside).alias("_previous"),
                       (F.row_number().over(inside) == 1).alias("_first"))
    lasts = (df.groupBy(key, "_bucket").agg(F.max_by("_record", F.struct(*order)).alias("_last")))
    across = Window.partitionBy(key).orderBy("_bucket")
    carried = lasts.select(key, "_bucket", F.lag("_last").over(across).alias("_carried"))
    firsts = (marked.where("_first").join(carried, [key, "_bucket"])
              .where(~F.col("_record").eqNullSafe(F.col("_carried"))))
    later = marked.where(~F.col("_first") & ~F.col("_record").eqNullSafe(F.col("_previous")))
    kept = reports.columns
    return later.select(*kept).unionByName(firsts.select(*kept))


def online_in_periods(states: DataFrame, period_of: Column, order: Sequence[str] = ("event_time", "seq"),
                      off: str = "0") -> DataFrame:
    """Boxes that were on at any time of a period: on at its start, or switched on inside it.

    A box stays on over periods without records.  Output: one row per box and run of periods
    (``first_period`` .. ``until_period``, the latter null while still on, exclusive).
    """
    df = states.withColumn("_p", period_of)
    # one row per box and period: was there an on-record, and the last state of the period
    per_period = (df.groupBy("probe_id", "_p")
                  .agg(F.max(F.when(F.col("state") != off, 1).otherwise(0)).alias("_seen_on"),
                       F.max_by("state", F.struct(*order)).alias("_last")))
    line = Window.partitionBy("probe_id").orderBy("_p")
    with_before = per_period.select("*", F.lag("_last").over(line).alias("_before"),
                                    F.lead("_p").over(line).alias("_next"))
    was_on = F.coalesce(F.col("_before") != off, F.lit(False))
    here = with_before.where((F.col("_seen_on") == 1) | was_on)
    stays = F.col("_last") != off
    return here.select("probe_id", F.col("_p").alias("first_period"), F.col("_next").alias("next_record"),
                       stays.alias("stays_on"))


def online_at_periods(states: DataFrame, period: str = "DAY", order: Sequence[str] = ("event_time", "seq"),
                      off: str = "0") -> DataFrame:
    """(period_start, probe_id) for every period between the first and the last of the data in which a box was on."""
    start = period_start(F.col("event_time"), period)
    runs = online_in_periods(states, start, order, off)
    end = states.agg(F.max(start)).scalar()
    step = {"HOUR": "interval 1 hour", "DAY": "interval 1 day", "WEEK": "interval 7 days",
            "MONTH": "interval 1 month", "QUARTER": "interval 3 months", "HALFYEAR": "interval 6 months",
            "YEAR": "interval 1 year", "15MIN": "interval 15 minutes"}[period]
    until = F.when(~F.col("stays_on"), F.col("first_period")) \
        .when(F.col("next_record").isNull(), end) \
        .otherwise(F.col("next_record") - F.expr(step))
    return runs.select(F.explode(F.sequence("first_period", until, F.expr(step))).alias("period_start"),
                         "probe_id")
