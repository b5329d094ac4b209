"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (runtime broadcast decisions
# backed by measured sizes, partition coalescing, skew-join splitting), UTC
# session time, no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target size of a shuffle partition after coalescing; the cluster sets
    # spark.sql.shuffle.partitions high (thousands at 100 TB) and AQE merges down
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # checkpoint files of DataFrames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "voltlens",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with ``DEFAULT_CONF``.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only in local mode, where
    one machine holds driver and executors, a fresh folder is created when that
    is unset; on a cluster an unset folder is an error, since a folder of the
    driver's machine is not seen by the executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="voltlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for a written table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/voltlens-{name}-{uuid.uuid4().hex[:12]}"
    if (paths := getattr(_scope, "paths", None)) is not None:
        paths.append(path)
    return path


#: Scratch paths of the innermost ``scratch_scope`` of a thread.
_scope = threading.local()


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that no later plan reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables that this thread writes inside are removed at the end: values leave it, no plans that read them."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        own, _scope.paths = _scope.paths, outer
        for path in own:
            remove_scratch(spark, path)


#: Shuffle files of an execution are removed when it ends (by default: when the driver collects its plan as garbage).
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Batches sent to Python workers hold about this much: for rows that are blocks of arrays.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
_held: dict = {}
_lock = threading.Lock()


@contextmanager
def settings(spark: SparkSession, values: dict):
    """Session settings for the executions inside; nested and parallel uses share them, the last to end sets them back."""
    with _lock:
        for k, v in values.items():
            n, before = _held.get(k, (0, None))
            if not n:
                before = spark.conf.get(k, None)
                spark.conf.set(k, v)
            _held[k] = n + 1, before
    try:
        yield
    finally:
        with _lock:
            for k in values:
                n, before = _held.pop(k)
                if n > 1:
                    _held[k] = n - 1, before
                elif before is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, before)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
