"""Keyed tables on plain Parquet for streaming writers.

Every micro-batch writes its own folder, so a replayed batch overwrites itself.  The newest batch wins per key on read.
:meth:`KeyedTable.compact` folds batches into a base; no file is changed in place.  A writer that compares with the table
reads it as it was *before* its batch, so a replay finds what the first run found.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from viewpulse.sources.hadoop import matching, remove

#: a condition, or what becomes of the rows
Keep = Column | Callable[[DataFrame], DataFrame]


#: buckets that are sent to all tasks; more of them are joined by shuffle
FEW_BUCKETS = 1 << 18


def few(buckets: DataFrame) -> DataFrame:
    """Buckets to join with, marked to be sent to all tasks where they are few, so that what they choose from stays in place.

    They are counted first: planned sizes of aggregated files say nothing, and a shuffle of the other side is done by the
    time the true size is known.
    """
    return F.broadcast(buckets) if buckets.limit(FEW_BUCKETS + 1).count() <= FEW_BUCKETS else buckets


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)

    def _folder(self, level: str, batch: int) -> str:
        return f"{self.root}/level={level}/batch={batch}"

    def _complete(self, level: str) -> list[int]:
        """Numbers of the finished folders of a level."""
        found = matching(self.spark, f"{self.root}/level={level}/batch=*/_SUCCESS")
        return sorted(int(path.split("/")[-2].split("=")[1]) for path in found)

    def write_batch(self, rows: DataFrame, batch: int) -> None:
        """Rows of one micro-batch, at most one per key."""
        rows.write.mode("overwrite").parquet(self._folder("delta", batch))

    def before(self, batch: int) -> DataFrame | None:
        """Rows the last complete batch before ``batch`` wrote, None if there is none."""
        earlier = [b for b in self._complete("delta") if b < batch]
        return self.spark.read.parquet(self._folder("delta", earlier[-1])) if earlier else None

    def newest(self) -> DataFrame:
        """Rows of the newest complete batch alone."""
        return self.spark.read.parquet(self._folder("delta", self._complete("delta")[-1]))

    def exists(self, before: int | None = None) -> bool:
        return bool(self._parts(before))

    def _parts(self, before: int | None = None) -> list[tuple[str, int]]:
        """The newest base and the deltas after it, of batches below ``before`` only."""
        known = lambda level: [b for b in self._complete(level) if before is None or b < before]
        base = known("base")[-1:]
        floor = base[0] if base else -1
        return [("base", b) for b in base] + [("delta", b) for b in known("delta") if b > floor]

    def read(self, before: int | None = None) -> DataFrame:
        """Current rows, or those before a batch: the newest batch per key."""
        parts = self._parts(before)
        if not parts:
            raise FileNotFoundError(f"no complete batch below {self.root}")
        rows = self.spark.read.option("basePath", self.root).parquet(*[self._folder(*p) for p in parts])
        return self._current(rows.drop("level")).drop("batch")

    def _current(self, rows: DataFrame) -> DataFrame:
        """The rows that count, of all parts with their ``batch``."""
        newest = Window.partitionBy(*self.keys).orderBy(F.col("batch").desc())
        return rows.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")

    def written(self, batch: int) -> DataFrame:
        """The rows of one batch alone."""
        return self.spark.read.parquet(self._folder("delta", batch))

    def compact(self, before: int | None = None, keep: Keep | None = None) -> int | None:
        """Fold complete batches (below ``before``) into a new base of the rows that ``keep`` accepts; returns its number.

        A function may be given as ``keep``; it makes the rows of the base from the current ones.

        Bases older than the new one and the deltas in the base before it go; the deltas just folded stay until the next
        time, for readers that have listed them already.
        """
        parts = self._parts(before)
        if not parts:
            return None
        number = parts[-1][1]
        if ("base", number) not in parts:
            rows = self.read(before)
            if keep is not None:
                rows = rows.where(keep) if isinstance(keep, Column) else keep(rows)
            rows.write.mode("overwrite").parquet(self._folder("base", number))
            old = [b for b in self._complete("base") if b < number]
            gone = [("base", b) for b in old[:-1]] + [("delta", b) for b in self._complete("delta") if old and b <= old[-1]]
            remove(self.spark, [self._folder(*g) for g in gone])
        return number

    def compact_every(self, batches: int, batch: int | None, keep: Keep | None = None) -> None:
        """Fold what stands before ``batch`` once ``batches`` deltas have come together."""
        if sum(level == "delta" for level, _ in self._parts(batch)) >= batches:
            self.compact(batch, keep)


class MergedTable(KeyedTable):
    """Partial results: all batches count, and ``merge`` brings the rows of a key together, on read and when folding.

    ``merge`` must give the same for any split of the rows into batches, and for its own results.
    """

    def __init__(self, spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame]):
        super().__init__(spark, root, ())
        self.merge = merge

    def _current(self, rows: DataFrame) -> DataFrame:
        return self.merge(rows.drop("batch"))


class BucketTable(KeyedTable):
    """Results of time buckets: of each ``bucket`` the rows of the newest batch that has it, all of them."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, ("bucket",))

    def _current(self, rows: DataFrame) -> DataFrame:
        newest = rows.groupBy("bucket").agg(F.max("batch").alias("batch"))
        return rows.join(few(newest), ["bucket", "batch"], "left_semi")
