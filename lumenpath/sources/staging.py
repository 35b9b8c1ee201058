"""Tables written once per application and read back, so that plans start from short lineage.

The folder is the shared one the cluster names in ``spark.checkpoint.dir``; lost executors then
cost nothing but a re-read.  A local session without that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Files of partitions that a task keeps open at once.
PARTITION_FILES = 32
# Staged files are written and read a few times and take room beside the shuffles, so they are packed closely.
CODEC = "zstd"
# Files of at most so many bytes are broadcast unasked.  Spark takes files for as large as their rows, but of packed ones the
# rows can take fifty times as much on the driver, where a broadcast is built.
FILE_BROADCAST = 256 << 10

_LOCAL_ROOTS: dict[str, str] = {}
_TABLES: dict[str, list[str]] = {}
_LOCK = threading.RLock()


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="lumenpath-")
    return _LOCAL_ROOTS[app]


def close(spark: SparkSession) -> None:
    """Removes everything this application has staged; frames that read it cannot be used any more."""
    for table in _TABLES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"drop table if exists {table}")
    _delete(spark, f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Tasks write to that many partitions at once; only beyond it do they sort their rows by partition first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _bound_broadcasts(spark: SparkSession) -> None:
    """The session's bound for broadcasts goes on for sizes that are measured while a query runs, and not for sizes of files."""
    by_files, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    bound = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if bound > FILE_BROADCAST:
        if spark.conf.get(measured, None) is None:
            spark.conf.set(measured, bound)
        spark.conf.set(by_files, FILE_BROADCAST)


class Stage:
    """Writes a frame under a name the first time it is asked for, and reads it from then on.

    With ``bucket_by`` the rows are dealt once by these columns, and joins and groupings by them need no further exchange.
    Only the session's catalog knows about buckets, so such a frame is a table there, with its files in the shared folder.
    Sessions that stage tables do not broadcast by the size of files, beyond ``FILE_BROADCAST``.
    """

    def __init__(self, spark: SparkSession, label: str):
        _bound_broadcasts(spark)
        self.spark = spark
        self._root = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:8]}"
        self._written: dict[str, DataFrame] = {}

    def keep(self, name: str, build, partition_by: tuple[str, ...] = (), bucket_by: tuple[str, ...] = ()) -> DataFrame:
        with _LOCK:
            if name not in self._written and bucket_by:
                self._written[name] = self._bucketed(build(), f"{self._root}/{name}", bucket_by)
            elif name not in self._written:
                frame, path = build(), f"{self._root}/{name}"
                writer = frame.write.mode("errorifexists").option("compression", CODEC)
                with _open_files(self.spark, PARTITION_FILES):
                    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
                self._written[name] = self.spark.read.schema(frame.schema).parquet(path)
            return self._written[name]

    def drop(self, name: str) -> None:
        """Removes a frame kept in files that nothing reads any more, so that it takes no room beside those that follow."""
        with _LOCK:
            del self._written[name]
            _delete(self.spark, f"{self._root}/{name}")

    def _bucketed(self, frame: DataFrame, path: str, keys: tuple[str, ...]) -> DataFrame:
        table, buckets = f"lumenpath_staged_{uuid.uuid4().hex}", int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # The same hash deals rows to tasks and to buckets: each task writes one file.
        writer = frame.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("compression", CODEC)
        writer.option("path", path).saveAsTable(table)
        _TABLES.setdefault(self.spark.sparkContext.applicationId, []).append(table)
        return self.spark.table(table)
