"""Gold table and report files.

A gold folder holds snapshots and lists of what is current:

    <folder>/data/snapshot=<id>/tenant_id=<tenant>/part-*     the files of one write
    <folder>/lists/number=<n>/part-*                          one small file: each tenant's snapshot

A write adds a snapshot, which nobody reads yet, and then commits the next list, a single file that is there whole or not at all.
Readers follow the list with the highest number, so they never meet a half-written table; those that opened an older one go on
with its files until ``forget_gold`` removes them.  One writer at a time, any number of readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows are dealt and sorted by these, so that one user's rows lie side by side; several columns, so that a busy user can be split.
CLUSTER = ("tenant_id", "user_id", "environment_id", "module_id", "activity_id")
#: Ids that reports filter by apart from the order, with the number of values that a row group's Bloom filter is made for.
BLOOM = {"environment_id": 10_000, "module_id": 100_000, "activity_id": 1_000_000}
ROW_GROUP_BYTES = 32 << 20


class MissingTable(LookupError):
    """The gold table has not been built yet."""


def _clustered(gold: DataFrame, row_group_bytes: int) -> DataFrameWriter:
    order = [c for c in CLUSTER if c in gold.columns]
    writer = gold.repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.block.size", row_group_bytes)
    for name, values in BLOOM.items():
        if name in gold.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.expected.ndv#{name}", values)
    return writer


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


_ROW = "tenant_id string, snapshot string, schema string"


def _lists(spark: SparkSession, folder: str) -> DataFrame:
    if not _exists(spark, f"{folder}/lists"):
        raise MissingTable(f"gold table {folder} not found; build it before asking for a report")
    return spark.read.schema(f"number bigint, {_ROW}").parquet(f"{folder}/lists")


def _current(spark: SparkSession, folder: str) -> tuple[int, list]:
    """Number and rows of the current list: one row per tenant, and one that has the table's schema."""
    lists = _lists(spark, folder)
    number = lists.agg(F.max("number").alias("number")).first().number
    return number, lists.where(F.col("number") == number).select("tenant_id", "snapshot", "schema").collect()


def write_gold(gold: DataFrame, path: str, whole: bool = False, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Replaces the tenants that ``gold`` has rows of, or with ``whole`` the whole table.  Its schema becomes the table's."""
    spark, folder, snapshot = gold.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    try:
        number, before = _current(spark, folder)
    except MissingTable:
        number, before = 0, []
    _clustered(gold, row_group_bytes).partitionBy("tenant_id").parquet(f"{folder}/data/snapshot={snapshot}")
    written = _snapshots(spark, folder, [snapshot], gold.schema)
    tenants = written.select("tenant_id").distinct() if written.inputFiles() else spark.createDataFrame([], "tenant_id string")
    new = tenants.select("tenant_id", F.lit(snapshot).alias("snapshot"), F.lit(None).cast("string").alias("schema"))
    old = spark.createDataFrame([] if whole else [row for row in before if row.schema is None], _ROW)
    old = old.join(tenants.withColumnRenamed("tenant_id", "_new"), F.col("tenant_id").eqNullSafe(F.col("_new")), "left_anti")
    listed = new.unionByName(old).unionByName(spark.createDataFrame([(None, None, gold.schema.json())], _ROW))
    listed.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/lists/number={number + 1}")


def _snapshots(spark: SparkSession, folder: str, names: Iterable[str], schema: T.StructType) -> DataFrame:
    """Rows of snapshots; tenants stay text whatever their names look like."""
    fields = [f for f in schema.fields if f.name != "tenant_id"]
    keys = [T.StructField("snapshot", T.StringType()), T.StructField("tenant_id", T.StringType())]
    reader = spark.read.option("basePath", f"{folder}/data").schema(T.StructType(fields + keys))
    return reader.parquet(*[f"{folder}/data/snapshot={name}" for name in names])


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold from a folder, as the current list has it."""
    folder = path.rstrip("/")
    _, rows = _current(spark, folder)
    schema = T.StructType.fromJson(json.loads(next(row.schema for row in rows if row.schema is not None)))
    held: dict[str, list[str]] = {}
    for row in rows:
        if row.schema is None:
            held.setdefault(row.snapshot, []).append(row.tenant_id)
    if not held:
        return spark.createDataFrame([], schema)
    current = F.lit(False)
    for snapshot, tenants in held.items():
        known = [t for t in tenants if t is not None]
        inside = F.col("tenant_id").isin(known) if known else F.lit(False)
        if len(known) < len(tenants):
            inside = inside | F.col("tenant_id").isNull()
        current = current | ((F.col("snapshot") == snapshot) & inside)
    return _snapshots(spark, folder, held, schema).where(current).drop("snapshot")


def forget_gold(spark: SparkSession, path: str) -> int:
    """Removes the snapshots that the current list does not name, and returns how many; no reader may still use an older list."""
    folder = path.rstrip("/")
    _, rows = _current(spark, folder)
    used = {row.snapshot for row in rows if row.schema is None}
    data = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/data")
    files = data.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [status.getPath() for status in files.listStatus(data) if status.getPath().getName().removeprefix("snapshot=") not in used]
    for old in gone:
        files.delete(old, True)
    return len(gone)


def save_gold(gold: DataFrame, table: str, whole: bool = False, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """The same as a catalog table, which offers no isolation between tenants' partitions: a reader can meet old and new tenants.

    A table whose columns differ, or ``whole``, is replaced; otherwise only the partitions of the tenants at hand are.
    """
    spark = gold.sparkSession
    columns = [c for c in gold.columns if c != "tenant_id"] + ["tenant_id"]
    gold = gold.select(*columns)
    same = spark.catalog.tableExists(table) and [f[:2] for f in spark.table(table).dtypes] == [f[:2] for f in gold.dtypes]
    writer = _clustered(gold, row_group_bytes).mode("overwrite")
    if whole or not same:
        writer.partitionBy("tenant_id").format("parquet").saveAsTable(table)
        return
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        writer.insertInto(table)
    finally:
        spark.conf.set(key, before)


def open_gold(spark: SparkSession, table: str) -> DataFrame:
    """Gold from the catalog; a typed error when it is not there."""
    if not spark.catalog.tableExists(table):
        raise MissingTable(f"gold table {table} not found; build it before asking for a report")
    return spark.table(table)


def report_name(report: str, admin_id: int | None, user_ids: tuple[int, ...] = (), moment: datetime | None = None) -> str:
    """``<report>-user<id>-<yyyymmddHHMMSS>-<random>``; without a user filter the administrator's id is used."""
    who = ",".join(map(str, user_ids)) or str(admin_id)
    stamp = (moment or datetime.now()).strftime("%Y%m%d%H%M%S")
    return f"{report}-user{who}-{stamp}-{uuid.uuid4().hex[:8]}"


def write_report(report: DataFrame, folder: str, name: str) -> str:
    """Report as JSON lines, written by the executors into one directory; NULL fields are kept."""
    path = f"{folder.rstrip('/')}/{name}"
    report.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return path


def sample(report: DataFrame, rows: int = 5) -> DataFrame:
    return report.limit(rows)
