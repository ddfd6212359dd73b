"""Batch log sources: SequenceFiles and text as they arrive, and the partitioned Parquet log tables made from them."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.operators.parse import parse_log, rejected_rows, valid_rows
from viewpulse.sources.hadoop import matching
from viewpulse.sources.periods import check_period, label, partition_filter, path_patterns, period_bounds

LINE = T.StructType([T.StructField("value", T.StringType())])


def read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One line per row in ``value``."""
    return spark.read.text(path)


def read_sequence_files(spark: SparkSession, glob: str) -> DataFrame:
    """Values of SequenceFiles (bytes) as UTF-8 lines; ``glob`` may be a comma-separated list of patterns.

    Spark has no DataFrame reader for the format, so this is the one place that passes rows through Python.  It streams
    file splits; nothing is gathered.  Read each file once, then work on the table written by :func:`write_log_table`.
    """
    def decode(pairs: Iterator) -> Iterator[tuple[str]]:
        for _, value in pairs:
            yield (bytes(value).decode("utf-8", "replace") if not isinstance(value, str) else value,)

    return spark.createDataFrame(spark.sparkContext.sequenceFile(glob).mapPartitions(decode), LINE)


def read_period_files(spark: SparkSession, root: str, prefix: str, period: str, at: datetime) -> DataFrame:
    """Lines of the SequenceFiles that hold a period.  Parts of it without files count as empty, not all of them."""
    patterns = [root.rstrip("/") + p for p in path_patterns(prefix, period, at)]
    found = [p for p in patterns if matching(spark, p)]
    if not found:
        raise FileNotFoundError(f"no files match {', '.join(patterns)}")
    return read_sequence_files(spark, ",".join(found))


def write_log_table(rows: DataFrame, path: str, unit: str, at: datetime | None, time: str = "event_time") -> None:
    """Typed rows as Parquet: a folder per ingest ``unit``, below it partitions by day and hour.

    A rerun of a unit replaces that unit alone, however far its rows reach into the hours of others.  ``at`` is the first
    moment of the period of the unit's files: rows without a time of their own count there (``file_time``).  Only with
    ``at=None`` such rows are refused, as nothing could ever read them by period.
    ``rebalance`` brings the rows of an hour together for few files, and splits an hour that holds far more than others.
    """
    if at is None and time not in rows.columns:
        raise ValueError(f"rows without {time} need the moment of their files")
    files = F.lit(at).cast("timestamp_ntz")
    moment = F.coalesce(F.col(time).cast("timestamp_ntz"), files) if time in rows.columns else files
    if at is None:
        moment = F.coalesce(moment, F.raise_error(F.lit(f"a row without {time} needs the moment of its files")).cast("timestamp_ntz"))
    stamped = (rows.withColumn("file_time", files).withColumn("dt", F.date_format(moment, "yyyyMMdd"))
               .withColumn("hr", F.date_format(moment, "HH")))
    (stamped.hint("rebalance", "dt", "hr").write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("dt", "hr").parquet(f"{path}/unit={unit}"))


def read_log_table(spark: SparkSession, path: str, period: str | None = None, at: datetime | None = None,
                   since: datetime | None = None, time: str = "event_time") -> DataFrame:
    """Rows of the period holding ``at`` (all rows without one); ``since`` moves the lower end back."""
    found = spark.read.parquet(path).schema
    # partition values look like numbers but are text with leading zeros
    places = ("dt", "hr", "unit")
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in places else f for f in found])
    table = spark.read.schema(text).parquet(path)
    if period is not None and at is not None:
        start, end = period_bounds(period, at)
        moment = F.col("file_time")
        if time in table.columns:
            moment = F.coalesce(F.col(time).cast("timestamp_ntz"), moment)
        table = table.where(partition_filter(since or start, end, moment))
    return table.drop(*places, "file_time")


def ingest(lines: DataFrame, log: str, path: str, unit: str, at: datetime | None, rejected_path: str | None = None,
           mode: str = "offline") -> None:
    """Parse raw lines once into a unit of the log table; refused lines go to ``rejected_path`` with their reason.

    A second call with one ``unit`` replaces it, other units stay: name units by their files, or use :func:`ingest_period`.
    """
    parsed = parse_log(lines, log, mode)
    write_log_table(valid_rows(parsed), path, unit=unit, at=at)
    if rejected_path:
        rejected_rows(parsed).write.mode("overwrite").parquet(f"{rejected_path}/unit={unit}")


def ingest_period(spark: SparkSession, root: str, prefix: str, log: str, period: str, at: datetime, path: str,
                  rejected_path: str | None = None) -> None:
    """Ingest the files of a period as one unit; a file belongs into one unit only.

    Rows without a time, and logs that have none, count in the period of their files, so use periods as short as those
    that reports need.
    """
    lines = read_period_files(spark, root, prefix, period, at)
    ingest(lines, log, path, f"{check_period(period)}-{label(period, at)}", period_bounds(period, at)[0], rejected_path)
