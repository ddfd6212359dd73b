"""Streaming line sources and their progress.

Every source yields ``value`` (the line) and ``ingest_time``; jobs take any such frame, so a source can be swapped.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = "query string, source string, batches bigint, start_offset string, end_offset string, input_rows bigint"


def kafka_lines(spark: SparkSession, brokers: str, topics: str | Sequence[str], starting: str = "latest",
                max_offsets: int | None = None, **options: str) -> DataFrame:
    """Values of one or several topics; needs the public Kafka connector on the class path."""
    names = topics if isinstance(topics, str) else ",".join(topics)
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
              .option("subscribe", names).option("startingOffsets", starting))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    raw = reader.options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("ingest_time"))


def text_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of text files as they appear in a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("value", F.col("_metadata.file_modification_time").alias("ingest_time"))


def table_rows(spark: SparkSession, path: str, glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """Typed rows of Parquet files as they appear in a folder; the schema is that of the files present."""
    source = spark.read
    reader = spark.readStream
    if glob:
        source, reader = source.option("pathGlobFilter", glob), reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.schema(source.parquet(path).schema).parquet(path)


class ProgressLog(StreamingQueryListener):
    """Rows and offsets of *all* micro-batches per query and source; a query itself keeps the newest few only.

    Make one before the queries start.  What it holds is bounded by the number of queries and sources.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.totals: dict[tuple[str, str, str], list] = {}
        self.ended: set[str] = set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for source in p.sources:
            key = (str(p.runId), p.name or str(p.id), source.description)
            total = self.totals.setdefault(key, [0, str(source.startOffset), None, 0])
            total[0] += 1
            total[2], total[3] = str(source.endOffset), total[3] + source.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def report(self, *queries: StreamingQuery, patience: float = 60) -> DataFrame:
        """(:data:`PROGRESS`) of the given queries; for those that have stopped all their events are waited for."""
        runs = {str(q.runId) for q in queries}
        limit = time.monotonic() + patience
        while any(not q.isActive and str(q.runId) not in self.ended for q in queries) and time.monotonic() < limit:
            time.sleep(0.05)
        rows = [(name, source, *total) for (run, name, source), total in self.totals.items() if run in runs]
        return self.spark.createDataFrame(rows, PROGRESS)

    def close(self) -> None:
        self.spark.streams.removeListener(self)
