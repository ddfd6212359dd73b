"""Result tables with fixed column contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.model import TABLES


def to_contract(result: DataFrame, table: str, period: str, parse_time: str | None = None) -> DataFrame:
    """Stored column names and order; ``parse_time`` may already be a column of the result."""
    contract = TABLES[table]
    result = result.withColumn("period", F.lit(period))
    if parse_time is not None:
        result = result.withColumn("parse_time", F.lit(parse_time))
    return result.select(*[F.col(ours).alias(stored) for ours, stored in contract.columns.items()])


def write_table(result: DataFrame, root: str, table: str) -> None:
    """Contract rows as Parquet; a rerun replaces the (period, parseTime) it covers and nothing else."""
    (result.hint("rebalance", "period", "parseTime").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("period", "parseTime").parquet(f"{root}/{table}"))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Stored rows in contract order; the labels are text although they look like numbers."""
    schema = ", ".join(f"`{f}` {t}" for f, t in _stored_types(spark, root, table))
    return (spark.read.schema(schema).parquet(f"{root}/{table}")
            .select(*TABLES[table].columns.values()))


def _stored_types(spark: SparkSession, root: str, table: str) -> list[tuple[str, str]]:
    found = spark.read.parquet(f"{root}/{table}").dtypes
    return [(name, "string" if name in ("period", "parseTime") else kind) for name, kind in found]


def write_jdbc(result: DataFrame, url: str, table: str, batch: int = 1000, connections: int = 16,
               **properties: str) -> None:
    """Append contract rows to a database table; at most ``connections`` writers."""
    (result.coalesce(connections).write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
     .option("batchsize", batch).options(**properties).save())
