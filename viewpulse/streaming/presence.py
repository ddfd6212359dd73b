"""On/off state of boxes as a merging stream: late records count in their window, and nothing waits for a window to close.

A cell holds of a window and a box whether it was seen on, and its last record.  Cells follow each other per box, so a new
cell may also change what the next one meant.  A micro-batch therefore works out the changes of its boxes from the cells
before it and from the cells with it, and stores the difference: rows that add up to the changes of all cells.  Roll-ups
of the differences add up in the same way, so no history is read to bring a count up to date.

With ``retention`` what is older goes when tables are folded: of cells the newest per box stays, of changes nothing, and of
counts one carried sum per area (its ``bucket`` is null).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.streaming import StreamingQuery

from viewpulse.model import D2
from viewpulse.operators.cube import cube_all
from viewpulse.operators.enrich import enrich_terminal
from viewpulse.plans.terminal import OFF
from viewpulse.sinks.keyed import Keep, MergedTable
from viewpulse.streaming.merging import FOLD, window_start

STEPS = ("newly_on", "net")


def state_cells(rows: DataFrame, minutes: int, order: Sequence[str]) -> DataFrame:
    """One row per window and box; the last record is the greatest by ``order``, then by state."""
    seen = F.max(F.when(F.col("state") != OFF, 1).otherwise(0)).alias("seen_on")
    return (rows.withColumn("bucket", window_start(F.col("event_time"), minutes)).groupBy("bucket", "probe_id")
            .agg(seen, F.max(F.struct(*order, "state")).alias("last")))


def merge_cells(cells: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Cells of several micro-batches to one; the area comes with the last record."""
    merged = cells.groupBy("bucket", "probe_id").agg(F.max("seen_on").alias("seen_on"), F.max(F.struct("last", *dims)).alias("_m"))
    return merged.select("bucket", "probe_id", "seen_on", *[F.col("_m")[c].alias(c) for c in ("last", *dims)])


def changes_of(cells: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Per window, box and area: seen on anew (0/1) and change of the state kept (-1/0/1); unchanged boxes have no row.

    A box that moves while it is on leaves its old area and is seen anew in the other.
    """
    line = Window.partitionBy("probe_id").orderBy("bucket")
    area = F.struct(*dims) if dims else F.struct(F.lit(0).alias("_everywhere"))
    placed = cells.select("bucket", "probe_id", (F.col("seen_on") == 1).alias("_seen"), area.alias("_area"),
                          (F.col("last.state") != OFF).alias("_on"))
    known = placed.select("*", F.lag(F.when(F.col("_on"), F.col("_area"))).over(line).alias("_was"))
    stays = F.col("_was").eqNullSafe(F.col("_area"))

    def step(area: str, newly: Column, net: Column) -> Column:
        return F.struct(F.col(area).alias("_at"), newly.cast("bigint").alias("newly_on"), net.cast("bigint").alias("net"))

    here = step("_area", F.col("_seen") & ~stays, F.col("_on").cast("int") - stays.cast("int"))
    left = step("_was", F.lit(False), -(F.col("_was").isNotNull() & ~stays).cast("int"))
    steps = known.select("bucket", "probe_id", F.inline(F.array(here, left))).where("newly_on <> 0 or net <> 0")
    return steps.select("bucket", "probe_id", *[F.col("_at")[d].alias(d) for d in dims], *STEPS)


def added_up(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summands to sums; what has been taken back entirely has no row."""
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in STEPS]).where("newly_on <> 0 or net <> 0")


class PresenceTables:
    """The stored tables of the job below ``root``."""

    def __init__(self, spark: SparkSession, root: str, dims: Sequence[str] = D2):
        self.dims = tuple(dims)
        self.cells = MergedTable(spark, f"{root}/state_cells", lambda rows: merge_cells(rows, self.dims))
        self.changes = MergedTable(spark, f"{root}/state_changes", lambda rows: added_up(rows, ("bucket", "probe_id", *self.dims)))
        self.online = MergedTable(spark, f"{root}/realtime_online", lambda rows: added_up(rows, ("bucket", *self.dims)))

    def differences(self, number: int) -> DataFrame:
        """What micro-batch ``number`` changes, from the cells of its boxes alone."""
        boxes = self.cells.written(number).select("probe_id").distinct()
        steps = changes_of(self.cells.read(number + 1).join(boxes, "probe_id", "left_semi"), self.dims)
        if self.cells.exists(number):
            before = changes_of(self.cells.read(number).join(boxes, "probe_id", "left_semi"), self.dims)
            steps = steps.unionByName(before.withColumns({c: -F.col(c) for c in STEPS}))
        return added_up(steps, ("bucket", "probe_id", *self.dims))

    def floor(self, number: int | None, retention: str, minutes: int) -> Column:
        """First window that is kept of those before micro-batch ``number``."""
        newest = self.cells.read(number).agg(F.max("bucket")).first()[0]
        return window_start(F.lit(newest) - F.expr(f"interval {retention}"), minutes)

    def fold(self, number: int | None, floor: Column | None, batches: int) -> None:
        """Fold what stands before micro-batch ``number`` once ``batches`` deltas have come together.

        Older than ``floor`` only what later counts need stays.
        """
        keep: tuple[Keep | None, ...] = (None, None, None)
        if floor is not None:
            recent = F.col("bucket") >= floor
            keep = (lambda cells: last_before(cells, recent), recent,
                    lambda rows: added_up(rows.withColumn("bucket", F.when(recent, F.col("bucket"))), ("bucket", *self.dims)))
        for table, kept in zip((self.cells, self.changes, self.online), keep, strict=True):
            table.compact_every(batches, number, kept)


def last_before(cells: DataFrame, recent: Column) -> DataFrame:
    """The recent cells and of each box the newest of the others."""
    newest = Window.partitionBy("probe_id", recent).orderBy(F.col("bucket").desc())
    return cells.withColumn("_rn", F.row_number().over(newest)).where(recent | (F.col("_rn") == 1)).drop("_rn")


def presence_query(spark: SparkSession, rows: DataFrame, root: str, trigger: dict, terminals: DataFrame | None = None,
                   minutes: int = 5, dims: Sequence[str] = D2, order: Sequence[str] = ("event_time", "has_id"),
                   retention: str | None = None, name: str = "state") -> StreamingQuery:
    """Run the job over a stream with ``event_time``, ``probe_id`` and ``state``.

    ``terminals`` gives the area of a box as it is when its record comes in; records of unknown boxes do not count.  Without
    it ``dims`` must be empty and only cells and changes per box are kept.  Records older than ``retention``, counted back
    from the newest window before the micro-batch, are stored in ``<name>_expired``.
    """
    if terminals is None and dims:
        raise ValueError("areas need the terminal table")
    tables = PresenceTables(spark, root, dims)

    def write(batch: DataFrame, number: int) -> None:
        own = state_cells(batch, minutes, order)
        if terminals is not None:
            own = enrich_terminal(own, terminals, dims)
        floor = None
        if retention and tables.cells.exists(number):
            floor = tables.floor(number, retention, minutes)
            late = F.col("bucket") < floor
            own.where(late).write.mode("overwrite").parquet(f"{root}/{name}_expired/level=delta/batch={number}")
            own = own.where(~late)
        tables.fold(number, floor, FOLD)
        tables.cells.write_batch(own, number)
        tables.changes.write_batch(tables.differences(number), number)
        if terminals is not None:
            steps = {c: ("sum", F.col(c)) for c in STEPS}
            tables.online.write_batch(cube_all(tables.changes.written(number), dims, steps, ("bucket",)), number)

    return (rows.writeStream.queryName(name).foreachBatch(write)
            .option("checkpointLocation", f"{root}/_checkpoints/{name}").trigger(**trigger).start())


def online_counts(online: DataFrame, dims: Sequence[str] = D2) -> DataFrame:
    """Boxes on at any time of a window: those on before it plus those seen on anew.

    Windows without a change in a cell have no row; their count is the ``stay_on`` of the row before.  A row whose ``bucket``
    is null is what was carried over from folded windows.
    """
    before = Window.partitionBy(*dims).orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.sum("net").over(before), F.lit(0))
    counts = online.select("bucket", *dims, (held + F.col("newly_on")).alias("online_users"), (held + F.col("net")).alias("stay_on"))
    return counts.where("bucket is not null")


def current_online(spark: SparkSession, root: str, dims: Sequence[str] = D2) -> DataFrame:
    """Counts of all kept windows."""
    return online_counts(PresenceTables(spark, root, dims).online.read(), dims)


def current_slice(spark: SparkSession, root: str, dims: Sequence[str] = D2) -> DataFrame:
    """Per province (all cities) the counts of the newest window, also where nothing changed in it."""
    tables = PresenceTables(spark, root, dims)
    newest = F.lit(tables.cells.read().agg(F.max("bucket")).first()[0])
    area = tables.online.read().where("province_id <> 'ALL' and city_id = 'ALL'")
    now = F.coalesce(F.col("bucket") == newest, F.lit(False))
    online = F.sum(F.when(now, F.col("newly_on")).otherwise(F.col("net")))
    return area.groupBy(*dims).agg(online.alias("online_users"), F.sum("net").alias("stay_on")).select(
        newest.alias("bucket"), *dims, "online_users", "stay_on")
