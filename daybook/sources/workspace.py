"""Intermediate tables in the cluster's shared folder.

A staged frame is written as Parquet and read back: the lineage ends there and a lost
executor costs no recomputation of earlier steps."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
MOST_OPEN = 256
PACKED = {"compression": "zstd"}      # ids and hashes are hex digits: only a codec with entropy coding halves them
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local session without one gets a temporary folder."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="daybook-")
        folder = _local[app]
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """True if the path exists on its file system."""
    fs, target = _fs(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote, if it is there."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def folders_below(spark: SparkSession, path: str, levels: int) -> list[str]:
    """Partition folders, relative to the path, so many levels below it."""
    fs, target = _fs(spark, path + "/*=*" * levels)
    base = fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(path)).toString()
    found = fs.globStatus(target)
    return sorted(x.getPath().toString()[len(base) + 1:] for x in (found or []))


@contextlib.contextmanager
def open_files(spark: SparkSession, most: int):
    """Writes inside keep a file open for each of so many partition folders or buckets, instead of sorting a task's rows by them."""
    before = spark.conf.get(OPEN_FILES, None)
    spark.conf.set(OPEN_FILES, str(most))
    try:
        yield
    finally:
        spark.conf.unset(OPEN_FILES) if before is None else spark.conf.set(OPEN_FILES, before)


class Workspace:
    """Staged tables of one job; as a context manager it deletes them in the end.

    Functions that return a lazy frame over staged tables use an own workspace that stays
    until the driver program ends."""

    def __init__(self, spark: SparkSession, name: str = "work"):
        self.spark, self.path, self.tables = spark, new_folder(spark, name), []
        atexit.register(self._end)

    def _end(self) -> None:
        with contextlib.suppress(Py4JError):     # the session may be gone already
            self._delete()

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *exc) -> None:
        atexit.unregister(self._end)
        self._delete()

    def _delete(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(self.spark, self.path)

    def stage(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        """Write and read back."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        schema = df.schema
        df.write.options(**PACKED).partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def stage_buckets(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """Write dealt into buckets by a key and read back: joins on the key move only the other side."""
        table = f"{name}_{uuid.uuid4().hex}"
        schema = df.schema
        self.tables.append(table)
        with open_files(self.spark, min(buckets, MOST_OPEN)):
            df.write.format("parquet").options(**PACKED, path=f"{self.path}/{table}").bucketBy(buckets, key).saveAsTable(table)
        return self.spark.table(table).select(*schema.names)

    def stage_all(self, frames: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, DataFrame]:
        """Stage several frames, each with its partition columns, as concurrent jobs."""
        with ThreadPoolExecutor(max_workers=len(frames)) as pool:
            jobs = {name: pool.submit(self.stage, df, name, *by) for name, (df, by) in frames.items()}
            return {name: job.result() for name, job in jobs.items()}


def workspace(df: DataFrame, work: Workspace | None) -> Workspace:
    """The given workspace, or a new one in the frame's session."""
    return work or Workspace(df.sparkSession)
