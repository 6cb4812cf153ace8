"""Session defaults and access to the shared working folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app_name: str = "aquifold",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Create a session with the settings the operators rely on (UTC, AQE).

    Nothing here pins sizes: partition counts come from the cluster unless given.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own; on a
    cluster an unset folder is an error, because executors would not see it.
    """
    folder = spark.conf.get(_CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="aquifold-")
    spark.conf.set(_CHECKPOINT_KEY, folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of any file system Spark can write to; Spark itself has no call for that."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Tables written inside the block leave no shuffle files behind; otherwise those stay until the driver collects garbage."""
    before = spark.conf.get(_CLEANUP_KEY, "false")
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP_KEY, before)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Tables written inside the block pass at most so many rows at once to Python workers.

    A batch is held several times, outside the JVM's heap as well as in the worker, so long texts need small batches.
    """
    before = spark.conf.get(_ARROW_ROWS_KEY)
    if not 0 < int(before) <= most:
        spark.conf.set(_ARROW_ROWS_KEY, most)
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS_KEY, before)


class Staging:
    """Intermediate tables of one job, written to the shared folder.

    Used where several operators read the same derived table: the expensive part
    runs once, lineage ends at files that outlive lost executors, and each reader
    still prunes columns and pushes filters into the parquet scan. As a context
    manager it removes the tables at the end; a job that returns lazy results on
    top of them leaves them to the folder's own clean-up.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self.folder = new_folder(spark, "job")

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and return a scan of it."""
        path = f"{self.folder}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        delete_folder(self._spark, self.folder)


#: Folders of the tables staged since a ``recorded_stages`` block was entered, innermost block last.
_RECORDS: list[list[str]] = []


@contextmanager
def recorded_stages() -> Iterator[list[str]]:
    """The folders that ``stage`` fills inside the block, so that their owner can remove them once nothing reads them."""
    folders: list[str] = []
    _RECORDS.append(folders)
    try:
        yield folders
    finally:
        _RECORDS.pop()
        if _RECORDS:
            _RECORDS[-1].extend(folders)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Stage one table that stays until the shared folder is cleaned, or its recorder removes it."""
    staging = Staging(df.sparkSession)
    if _RECORDS:
        _RECORDS[-1].append(staging.folder)
    with freed_shuffles(df.sparkSession):
        return staging.write(df, label)
