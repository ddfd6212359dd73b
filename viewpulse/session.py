"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Runtime settings the library is designed for.  Shuffle partition counts are left to AQE: start high, coalesce later.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "viewpulse", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with :data:`DEFAULTS`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_keyed_state(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB state store; a session made elsewhere may not have it set."""
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, DEFAULTS[name])


#: Spark 4.1 and later; without it files of a shuffle stay until the driver's garbage collector meets their frame
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def passing_session(spark: SparkSession) -> SparkSession:
    """A copy of the session for frames that are run once: when a run has ended its shuffle files go.

    The settings of ``spark`` itself stay as they are, as its frames may be run again.
    """
    copy = type(spark)(spark.sparkContext, spark._jsparkSession.cloneSession())
    copy.conf.set(REMOVE_SHUFFLES, "true")
    return copy


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Frames that are run in this block leave no shuffle files behind."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where the cluster names none (local tests) a temporary folder is made and remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder when running on a cluster")
        root = tempfile.mkdtemp(prefix="viewpulse-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below :func:`shared_root`."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
