"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCAN_PARTITION = 128 << 20  # bytes; Spark's default size of a scan partition
_FIT_PARTITION = 16 << 20  # bytes of stored features that keep one core busy in a fit
_FIT_ROWS = 50_000  # rows that do so, however well their features are packed
_LOCAL = "leadloom.local.folder"  # session setting: the fallback of a local session
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_RUN = "leadloom.run.folder"  # session setting while a run folder is open


def build_session(app: str = "leadloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings every operator assumes (UTC, ANSI, adaptive plans)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster an unset
    folder is an error, because a machine-local path dies with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    fallback = tempfile.mkdtemp(prefix="leadloom-")
    spark.conf.set(_LOCAL, fallback)  # Spark does not let a running session set its own folder
    return fallback


def steps_dir(spark: SparkSession) -> str:
    """Where stored steps go: the open run folder, otherwise ``leadloom`` in the shared folder."""
    return spark.conf.get(_RUN, None) or f"{shared_dir(spark).rstrip('/')}/leadloom"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Steps stored inside the block share one folder, which is removed at its end.

    Frames made in the block read that folder: write what should stay before the block ends. Blocks may be
    nested; a session runs one block at a time.
    """
    before = spark.conf.get(_RUN, None)
    path = f"{steps_dir(spark)}/run-{uuid.uuid4().hex}"
    spark.conf.set(_RUN, path)
    try:
        yield path
    finally:
        if before is None:
            spark.conf.unset(_RUN)
        else:
            spark.conf.set(_RUN, before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Iterative fits scan their input dozens of times. A parquet copy keeps column pruning,
    and unlike a cache it outlives lost executors without recomputing the lineage.
    """
    spark = df.sparkSession
    path = f"{steps_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int) -> None:
    """From now on Python workers of the session get at most ``rows`` rows at once.

    Spark's 10,000 rows of long texts are held several times over: in the Arrow buffers of the executor, in those of the
    worker and as Python strings. A smaller number set before stays. It holds for the session, as plans are made when they run.
    """
    now = int(spark.conf.get(_BATCH))
    if not 0 < now <= rows:
        spark.conf.set(_BATCH, rows)


def _estimated_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_side(df: DataFrame, most: int = 64 << 20) -> DataFrame:
    """A stored table marked for broadcast where Spark's figures show it within the bound.

    Four bytes in memory are counted for each stored one. Beyond the bound a join shuffles.
    """
    return F.broadcast(df) if 4 * _estimated_bytes(df) <= most else df


def spread(df: DataFrame) -> DataFrame:
    """Deal a small input out to all cores before work that is heavy per row.

    A small file is often a single scan task. An input large enough to give every core a scan
    partition of its own is left alone, so at most one scan partition per core is ever moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if _estimated_bytes(df) < cores * _SCAN_PARTITION else df


def training_table(df: DataFrame) -> DataFrame:
    """Store ``df`` for repeated fits, in no more partitions than its size deserves.

    Every boosting step runs several jobs over all partitions; on a small table their overhead
    is nearly all the time. Large tables keep their scan partitions. Flags and codes pack to a byte
    or two a row, so bytes alone would leave millions of rows to one core: rows count too.
    """
    stored = materialise(df)
    parts = max(_estimated_bytes(stored) / _FIT_PARTITION, stored.count() / _FIT_ROWS)
    return stored.coalesce(max(1, math.ceil(parts)))


def fits_at_once(df: DataFrame) -> int:
    """How many fits on a stored table may run side by side without fighting for cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return min(16, max(2, cores // max(1, df.rdd.getNumPartitions())))
