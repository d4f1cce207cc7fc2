"""Session settings the rollups are written for, and where they may keep files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings: times are UTC instants, plans adapt at run time, and a batch
# result replaces only the partitions it holds.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# For streams whose open windows do not fit the executors' heaps: state in RocksDB,
# outside the heap, with only its changes written per micro-batch.  Slower per row,
# so it is left to the owner of the session.
LARGE_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "clickroll", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """New or current session with the settings above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for tables and checkpoints of one run.

    It lies under ``spark.checkpoint.dir``, the folder every executor can
    reach.  A session on one machine may leave that unset and gets a temporary
    folder; on a cluster that would be a folder per machine, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="clickroll-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once to a table of their own and read back.

    For results that several branches read: the branches then prune columns and
    filters in the table, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def state_partitions(spark: SparkSession, number: int | None) -> Iterator[None]:
    """Shuffle partitions that a stream with state is started with, and keeps for good.

    AQE does not adapt them, so the owner of a stream names their number; with
    None the session's own holds.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if number is not None:
        spark.conf.set(key, number)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def large_state(spark: SparkSession) -> Iterator[None]:
    """Settings a stream with state in RocksDB is started with; the session has its own again behind it."""
    before = {key: spark.conf.get(key, None) for key in LARGE_STATE_CONF}
    for key, value in LARGE_STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
