"""Parquet layer tables: write once, skip if complete, read with a schema."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_VERSION = re.compile(r"v=(\d+)$")


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    fs, hadoop_path = _path(spark, path)
    fs.delete(hadoop_path, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """A finished Spark write leaves a marker; a crashed one does not."""
    return exists(spark, f"{path}/_SUCCESS")


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Files directly below a folder, sorted by path."""
    fs, hadoop_path = _path(spark, path)
    found = [s.getPath().toString() for s in fs.listStatus(hadoop_path) if s.isFile()]
    return sorted(f for f in found if f.endswith(suffix))


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_path(path: str, column: str, value) -> str:
    """Folder of one value of a partition column."""
    return f"{path}/{column}={NO_VALUE if value is None else value}"


def partition_files(
    spark: SparkSession, path: str, column: str | None, values: Sequence | None = None
) -> list[str]:
    """Data files of the given partitions (default: all), one level deep."""
    folders = [path]
    if column and values is None:
        fs, hadoop_path = _path(spark, path)
        found = [s.getPath().toString() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
        folders = [f for f in found if f"/{column}=" in f]
    elif column:
        folders = [partition_path(path, column, v) for v in values]
    return [
        f
        for folder in folders
        if exists(spark, folder)
        for f in list_files(spark, folder, ".parquet")
        if not f.rsplit("/", 1)[1].startswith(("_", "."))
    ]


def overwrite_partitions(
    df: DataFrame, path: str, columns: Sequence[str], sort: Sequence[str] = ()
) -> str:
    """Write the partitions that ``df`` has rows for; all others stay.

    The old files of a partition go when the new ones are complete, so a rerun
    after a crash gives the same table.
    """
    writer = by_partition(df, columns, sort).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    return path


def by_partition(
    df: DataFrame, columns: Sequence[str], sort: Sequence[str] = ()
) -> DataFrame:
    """Lay rows out for a partitioned write: few files per value, none oversized.

    REBALANCE lets adaptive execution split a hot value over several files and
    merge the small ones. The sort makes row-group statistics selective and
    doubles as the order the partitioned writer needs anyway.
    """
    return df.hint("rebalance", *columns).sortWithinPartitions(*columns, *sort)


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort: Sequence[str] = (),
    force: bool = False,
) -> str:
    """Write one layer table unless a complete one is there already."""
    if not force and is_complete(df.sparkSession, path):
        return path
    if partition_by:
        by_partition(df, partition_by, sort).write.mode("overwrite").partitionBy(
            *partition_by
        ).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def read_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if exists(spark, path):
        return read_layer(spark, path, schema)
    return spark.createDataFrame([], schema)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it back: cuts the lineage, survives the loss of
    executors, and tells Catalyst the true size."""
    df.write.mode("overwrite").parquet(path)
    return read_layer(df.sparkSession, path, df.schema)


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    found = (_VERSION.search(s.getPath().toString()) for s in fs.listStatus(hadoop_path))
    return sorted(int(m.group(1)) for m in found if m)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Newest complete version folder of a table that is rewritten as a whole."""
    for number in reversed(_versions(spark, path)):
        folder = f"{path}/v={number}"
        if is_complete(spark, folder):
            return folder
    return None


def write_version(df: DataFrame, path: str) -> str:
    """Write a new version next to the old ones, so none is overwritten while
    it is being read. Readers switch once the new one is complete."""
    known = _versions(df.sparkSession, path)
    folder = f"{path}/v={(known[-1] if known else 0) + 1}"
    df.write.mode("overwrite").parquet(folder)
    return folder


def read_current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    folder = current_version(spark, path)
    return read_layer(spark, folder, schema) if folder else spark.createDataFrame([], schema)
