"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RUNTIME_SETTINGS = {
    # Hours, weekdays and timestamp strings must not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    # Join state of a long stream outgrows the heap; RocksDB keeps it on executor disk
    # and uploads it to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # A join may be split on skew even when that costs a shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Batches that go to Python workers end at so many bytes, however long the rows are.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # A long job is many queries: each one's shuffle files go when it ends, not when the driver collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on; everything else stays as the cluster has it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "trackfuse", master: str | None = None, **settings: str) -> SparkSession:
    """A configured session. ``settings`` are Spark properties with ``__`` for each dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


@contextlib.contextmanager
def _set(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def no_empty_batches(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Streams started within have no batches without input; the next batch with rows clears state out.

    For inner joins: a batch without input goes through their whole state and gives nothing. A windowed
    count or an outer join gives rows when its state goes, so it needs such batches.
    """
    return _set(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false"})


_STATE = "spark.sql.streaming.stateStore.rocksdb."
_SMALL_STATE = {
    # Checkpoints of a hundred batches hold what has long left the state; two are enough to go on after a failure.
    "spark.sql.streaming.minBatchesToRetain": "2",
    # Removed rows leave the files with the batch that removes them.
    f"{_STATE}compactOnCommit": "true",
    f"{_STATE}compression": "zstd",
    f"{_STATE}blockSizeKB": "16",
    # For each of four stores a partition.
    f"{_STATE}blockCacheSizeMB": "2",
}


def small_state(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Streams started within keep little on disk beside the state that they need: for replays of much history."""
    return _set(spark, _SMALL_STATE)


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``; within ``run_folder`` the run's own.

    The caller names it. Only a local session without that setting, as in a quick trial, gets a folder of its own.
    """
    run = spark.conf.get(_RUN, None)
    if run:
        return run
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="trackfuse-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


_RUN = "trackfuse.run"


@contextlib.contextmanager
def run_folder(spark: SparkSession, name: str | None = None, keep: bool = False) -> Iterator[str]:
    """Staged tables of one job go into a folder of their own, which is removed when the job has ended.

    What the job returns lazily must be written or collected before the end. ``name``
    makes a folder that a failed driver left behind easy to find: ``remove_run`` removes it.
    """
    before = spark.conf.get(_RUN, None)
    folder = f"{work_dir(spark)}/{name or new_name('run')}"
    spark.conf.set(_RUN, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(_RUN)
        else:
            spark.conf.set(_RUN, before)
        if not keep:
            _remove(spark, folder)


def remove_run(spark: SparkSession, name: str) -> bool:
    """Remove what a run of that name has left; whether there was anything."""
    return _remove(spark, f"{work_dir(spark)}/{name}")


def file_system(spark: SparkSession, place: str) -> tuple:
    """Hadoop's client of the store that ``place`` is in, and the path; any store that Spark can write to."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _remove(spark: SparkSession, folder: str) -> bool:
    fs, path = file_system(spark, folder)
    return fs.delete(path, True)


def new_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def new_path(spark: SparkSession, prefix: str) -> str:
    """A path nobody has used yet, in the shared folder."""
    return f"{work_dir(spark)}/{new_name(prefix)}"


def stage(df: DataFrame, prefix: str = "staged") -> DataFrame:
    """Write ``df`` once and read it back.

    Used where several later steps must see the very same rows, also when an executor
    is lost in between and its tasks run again.
    """
    path = new_path(df.sparkSession, prefix)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
