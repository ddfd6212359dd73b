"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zipfile
from collections.abc import Callable
from pathlib import Path
from tempfile import TemporaryDirectory

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewpulse.session import shared_path
from viewpulse.sources.hadoop import remove

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a missing id where ids are compared: such a row comes after all others.
LAST_ID = 2**63 - 1


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the session's shared folder and read it back.

    Cuts lineage: what follows survives lost executors without computing ``df`` again, and values that depend on the
    placement of rows (partition numbers, row ids) are fixed from here on.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def unstored(*frames: DataFrame) -> None:
    """Delete the files of :func:`stored` frames.  What was made from them must have been stored itself by then."""
    remove(frames[0].sparkSession, [frame.stored_at for frame in frames])


_SHIPPED: dict[str, TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Let Spark hand this package to its Python workers, once per application; they may not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED[context.applicationId] = folder = TemporaryDirectory()  # the driver serves the file from here
    package = Path(__file__).resolve().parents[1]
    with zipfile.ZipFile(target := Path(folder.name) / f"{package.name}.zip", "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))


_REMEMBERED: dict[tuple, object] = {}


def remembered(key: tuple, make: Callable[[], object]) -> object:
    """What a process keeps from task to task.  It keeps one thing: a worker outlives the operators that it serves, and
    their memories would add up."""
    if key not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[key] = make()
    return _REMEMBERED[key]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also when ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def hash128(value: Column) -> list[Column]:
    """Two independent 64-bit hashes: equal only for equal values, also among 10^15 of them."""
    return [F.xxhash64(value), F.xxhash64(F.lit("second"), value)]


def same(left: DataFrame, right: DataFrame, *pairs: tuple[str, str]) -> Column:
    """Null-safe equality of the named columns."""
    found = F.lit(True)
    for a, b in pairs:
        found = found & left[a].eqNullSafe(right[b])
    return found


def bits_for(rows: int, per_bucket: int) -> int:
    """Bits of a hash so that a bucket gets about ``per_bucket`` of ``rows``."""
    return max(0, -(-rows // per_bucket) - 1).bit_length()


def running(df: DataFrame, group: str, bucket: str, order: list[str], value: str, out: str,
            fan: int = 1024) -> DataFrame:
    """Exclusive running sum ``out`` of ``value`` per ``group`` in the order (``bucket``, ``order``).

    Works on three levels (rows of a bucket, buckets of a stretch of ``fan``, stretches of a group), so that no window
    holds a whole group, however large it is.  ``bucket`` is a non-negative long that the caller keeps small.
    """
    per_bucket = df.groupBy(group, bucket).agg(F.sum(value).alias("_sum")).withColumn("_far", F.expr(f"{bucket} div {fan}"))
    far = per_bucket.groupBy(group, "_far").agg(F.sum("_sum").alias("_far_sum"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    far = far.select(group, "_far", F.coalesce(F.sum("_far_sum").over(
        before(Window.partitionBy(group).orderBy("_far"))), F.lit(0)).alias("_far_off"))
    near = per_bucket.withColumn("_near_off", F.coalesce(F.sum("_sum").over(
        before(Window.partitionBy(group, "_far").orderBy(bucket))), F.lit(0)))
    offsets = near.join(far, [group, "_far"]).select(
        group, bucket, (F.col("_near_off") + F.col("_far_off")).alias("_off"))
    inside = F.coalesce(F.sum(value).over(before(Window.partitionBy(group, bucket).orderBy(*order))), F.lit(0))
    return df.withColumn("_in", inside).join(offsets, [group, bucket]).withColumn(
        out, F.col("_in") + F.col("_off")).drop("_in", "_off")
