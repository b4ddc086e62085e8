"""Columnar sinks, and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session without the setting gets a folder inside its warehouse, which is
    shared as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tallyworks/{name}-{uuid.uuid4().hex}"


def scratch(frame: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table and read it back, for one that is used several times.

    It stays until ``drop_scratch``: results that are read from it are computed when they are asked for.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, f"scratch/{name}")
    with shuffles_dropped(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files when they end; else these stay until the driver collects its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that no result is read from any more."""
    at, system = _path(spark, path)
    system.delete(at, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables; call it when no result that rests on them is read any more."""
    at, system = _path(spark, f"{shared_folder(spark).rstrip('/')}/tallyworks/scratch")
    system.delete(at, True)


def _path(spark: SparkSession, path: str):
    """A path and its file system, which may be one that only Spark can reach."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly under ``path``; none if it is not there."""
    at, system = _path(spark, path)
    return [str(f.getPath()) for f in system.listStatus(at) if f.isDirectory()] if system.exists(at) else []


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that writes ``path`` has left its commit marker there."""
    at, system = _path(spark, f"{path}/_SUCCESS")
    return system.exists(at)


def write_orc(frame: DataFrame, path: str, mode: str = "errorifexists") -> None:
    frame.write.mode(mode).orc(path)


def append_rows(frame: DataFrame, table: str) -> None:
    """Insert into an existing table, by position as SQL does."""
    frame.write.insertInto(table)


def create_table_as(frame: DataFrame, table: str, path: str | None = None, if_not_exists: bool = True) -> None:
    """Create a columnar table from a query; an existing one is left alone or is an error."""
    writer = frame.write.format("orc").mode("ignore" if if_not_exists else "errorifexists")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def clustered_for_write(frame: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of the same target folder together before a partitioned write.

    Without it every task would open a file in every folder. ``rebalance`` lets
    adaptive execution split a key that holds too much for one task (a plain
    repartition would not) and merge small ones.
    """
    return frame.hint("rebalance", *columns)


def drop_table(spark: SparkSession, table: str, if_exists: bool = True) -> None:
    """Drop a table; one that is not there is left alone or is an error."""
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{table}")


def write_partitioned_bucketed(
    frame: DataFrame,
    table: str,
    path: str,
    partition: str = "batch",
    bucket: str = "course",
    buckets: int = 4,
) -> None:
    """ORC table partitioned by one column and hash-bucketed by another."""
    (
        clustered_for_write(frame, partition, bucket)
        .write.format("orc")
        .mode("overwrite")
        .partitionBy(partition)
        .bucketBy(buckets, bucket)
        .option("path", path)
        .saveAsTable(table)
    )


def overwrite_partitions(frame: DataFrame, path: str, partition: str = "batch") -> None:
    """Replace only those partitions that ``frame`` has rows for."""
    (
        clustered_for_write(frame, partition)
        .write.format("orc")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .save(path)
    )


def read_partitioned(spark: SparkSession, path: str, schema) -> DataFrame:
    """Scan a partitioned layout as plain files.

    The file scan keeps partition pruning and splits files freely. Reading the bucketed table by its name
    runs one task per bucket instead, and groups by the bucket column without a shuffle.
    """
    return spark.read.schema(schema).orc(path)
