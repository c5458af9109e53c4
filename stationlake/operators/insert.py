"""Insert-ignore into a Parquet table: skip keys that are there already."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stationlake.sources import layers


class Landed(NamedTuple):
    """What an insert added: how many rows, and the files that hold them."""

    rows: int
    files: list[str]


def partition_values(rows: DataFrame, column: str) -> list:
    """The partitions that a batch touches, NULL among them.

    One aggregate over one column. The values are bounded by the rule that made
    the partitions (dates: ``epoch_to_date``); only they reach the driver.
    """
    return [r[column] for r in rows.select(column).distinct().collect()]


KEY_GROUPS = 256

Range = tuple[str, str]


class Touched(NamedTuple):
    """The part of a table that a batch can meet."""

    partitions: list
    ranges: list[Range]


def touched_by(rows: DataFrame, partition: str, key: str) -> Touched:
    """The partitions of a batch, and ranges that hold all values of a key column.

    The keys are dealt by hash into ``KEY_GROUPS`` groups, whose least and
    greatest values make the ranges: a few late keys give a few narrow ones, many
    keys merge into wide ones. Partitions and groups are all that reaches the
    driver, in one job. The key must not be NULL.
    """
    group = F.pmod(F.xxhash64("key_value"), F.lit(KEY_GROUPS))
    found = (
        rows.select(F.col(partition).alias("partition_value"), F.col(key).alias("key_value"))
        .distinct()
        .select("partition_value", "key_value", group.alias("key_group"))
        .groupingSets([["partition_value"], ["key_group"]], "partition_value", "key_group")
        .agg(
            F.grouping("key_group").alias("of_partition"),
            F.min("key_value").alias("least"),
            F.max("key_value").alias("greatest"),
        )
        .collect()
    )
    ranges: list[Range] = []
    for least, greatest in sorted((r["least"], r["greatest"]) for r in found if not r["of_partition"]):
        if ranges and least <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(ranges[-1][1], greatest))
        else:
            ranges.append((least, greatest))
    return Touched([r["partition_value"] for r in found if r["of_partition"]], ranges)


def in_ranges(column: str, ranges: Sequence[Range]) -> Column:
    """A literal test that Parquet answers from statistics of row groups and pages."""
    tests = [
        F.col(column) == least if least == greatest else F.col(column).between(least, greatest)
        for least, greatest in ranges
    ]
    return reduce(or_, tests, F.lit(False))


def in_partitions(column: str, values: Sequence[date | None]) -> Column:
    """A literal test on a partition column, so that no other is listed."""
    present = sorted(v for v in values if v is not None)
    test = F.col(column).isin(present) if present else F.lit(False)
    return test | F.col(column).isNull() if len(present) < len(values) else test


def touched_dates(rows: DataFrame, column: str) -> Column:
    """A literal filter covering the dates of a batch."""
    return in_partitions(column, partition_values(rows, column))


def absent_from(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``.

    The batch is reduced to the keys the table has first: adaptive execution
    broadcasts a batch that proves small at run time, and the table's keys are
    then read but not shuffled. What comes back is no larger than the batch.
    """
    hits = existing.select(*keys).join(new.select(*keys), list(keys), "left_semi")
    return new.join(hits, list(keys), "left_anti")


def in_reach(
    existing: DataFrame,
    partition_by: str | None,
    values: Sequence | None,
    sort: Sequence[str] = (),
    ranges: Sequence[Range] | None = None,
) -> DataFrame:
    """The rows of a table that may have a key of the batch."""
    if values is not None:
        existing = existing.filter(in_partitions(partition_by, values))
    if ranges is not None:
        existing = existing.filter(in_ranges(sort[0], ranges))
    return existing


def insert_new(
    new: DataFrame,
    target: str,
    schema: StructType,
    keys: Sequence[str],
    partition_by: str | None = None,
    sort: Sequence[str] = (),
    values: Sequence | None = None,
    list_files: bool = False,
    ranges: Sequence[Range] | None = None,
) -> Landed:
    """Append the rows of ``new`` whose key the table lacks.

    ``new`` must be unique by key. ``values`` are the partitions of the batch
    (see ``partition_values``): with them only the touched partitions of the
    table are read. ``ranges`` of the first sort column, a key column (see
    ``touched_by``), leave out the row groups and pages that no key can be in. A crash half way through is harmless, as the rows it left
    behind are skipped on the next try. One writer per table. ``list_files``
    asks for the files written, found by listing the touched partitions.
    """
    spark = new.sparkSession
    before: set[str] = set()
    if layers.exists(spark, target):
        existing = layers.read_layer(spark, target, schema)
        existing = in_reach(existing, partition_by, values, sort, ranges)
        if list_files:
            before = set(layers.partition_files(spark, target, partition_by, values))
        new = absent_from(new, existing, keys)
    new = new.select(*schema.fieldNames())
    if partition_by:
        new = layers.by_partition(new, [partition_by], sort)
    landed = Observation()
    writer = new.observe(landed, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(target)
    files = []
    if list_files:
        files = sorted(set(layers.partition_files(spark, target, partition_by, values)) - before)
    return Landed(landed.get.get("rows") or 0, files)


def insert_ignore(
    new: DataFrame,
    target: str,
    schema: StructType,
    keys: Sequence[str],
    partition_by: str | None = None,
    sort: Sequence[str] = (),
    values: Sequence | None = None,
) -> int:
    """As ``insert_new``; returns how many rows were added."""
    return insert_new(new, target, schema, keys, partition_by, sort, values).rows


def replace_by_key(new: DataFrame, target: str, schema: StructType, keys: Sequence[str]) -> str:
    """Last write wins, for small tables with one row per key: rows of ``new``
    take the place of those with the same key. Writes a new version of the whole
    table; read it with ``layers.read_current``."""
    spark = new.sparkSession
    new = new.select(*schema.fieldNames())
    current = layers.read_current(spark, target, schema)
    kept = current.join(new.select(*keys), list(keys), "left_anti")
    return layers.write_version(kept.select(*schema.fieldNames()).unionByName(new), target)
