"""The terminal table: lookup side of the enrichment joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewpulse.model import TERMINAL_INFO_COLUMNS


def terminals_from_jdbc(spark: SparkSession, url: str, table: str = "TERMINAL_INFO", partitions: int = 16,
                        bounds: tuple[str, int, int] | None = None, **properties: str) -> DataFrame:
    """Terminal table of a database; ``bounds`` = (numeric column, low, high) splits the read."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if bounds:
        column, low, high = bounds
        reader = (reader.option("partitionColumn", column).option("lowerBound", low).option("upperBound", high)
                  .option("numPartitions", partitions))
    return reader.load()


def terminals_from_parquet(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*[c for c in TERMINAL_INFO_COLUMNS if c in table.columns])
