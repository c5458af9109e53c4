"""Load watermark, incremental reads above it, and the run log."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Mapping
from contextlib import contextmanager
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.functions.scalars import epoch_to_ts, whole_seconds
from stationlake.operators.ingest import INFO, STATUS
from stationlake.sources import layers

LAYERS = ("BRONZE", "SILVER", "GOLD")
RUN_STATES = ("RUNNING", "SUCCESS", "FAILED")


def seed_watermark(spark: SparkSession) -> DataFrame:
    """The control table before any load: one row per bronze table."""
    rows = [(t.name, None, None, 0, datetime.now(timezone.utc)) for t in (INFO, STATUS)]
    return spark.createDataFrame(rows, schemas.WATERMARK)


def refresh_watermark(
    control: DataFrame,
    tables: Mapping[str, DataFrame],
    epoch_unit: str = "s",
    since: date | None = None,
) -> DataFrame:
    """Set each source's total row count, and its newest report time where the
    table has one. Sources without a table here keep their values.

    The count needs file footers only. ``since``, the date of the last mark,
    spares the scan of older partitions for the newest time; a mark never goes
    back.
    """
    found = None
    for name, table in tables.items():
        count = F.count(F.lit(1)).alias("n")
        if "station_status_last_reported" not in table.columns:
            counted = table.agg(count, F.lit(None).cast("timestamp_ntz").alias("newest"))
        else:
            newest = epoch_to_ts(F.max("station_status_last_reported"), epoch_unit)
            if since is None:
                counted = table.agg(count, newest.alias("newest"))
            else:
                # The count is of all partitions, from footers; the scan of few.
                counted = table.agg(
                    count, F.lit(None).cast("timestamp_ntz").alias("newest")
                ).unionByName(
                    _from_date(table, since).agg(
                        F.lit(None).cast("bigint").alias("n"), newest.alias("newest")
                    )
                )
        counted = counted.withColumn("source_name", F.lit(name))
        found = counted if found is None else found.unionByName(counted)
    found = found.groupBy("source_name").agg(
        F.max("n").alias("n"), F.max("newest").alias("newest")
    )
    return control.join(found, "source_name", "left").select(
        "source_name",
        "last_station_id",
        F.greatest("newest", "last_reported_ts").alias("last_reported_ts"),
        F.coalesce("n", "rows_loaded").alias("rows_loaded"),
        F.when(F.col("n").isNotNull(), F.current_timestamp())
        .otherwise(F.col("last_load_ts"))
        .alias("last_load_ts"),
    )


def store_watermark(
    spark: SparkSession, path: str, tables: Mapping[str, DataFrame], epoch_unit: str = "s"
) -> str:
    control = seed_watermark(spark)
    since = None
    if layers.current_version(spark, path):
        control = layers.read_current(spark, path, schemas.WATERMARK)
        mark = control.agg(F.max("last_reported_ts")).first()[0]
        since = mark.date() if mark else None
    fresh = refresh_watermark(control, tables, epoch_unit, since)
    return layers.write_version(fresh.coalesce(1), path)


def _from_date(bronze_status: DataFrame, day: date) -> DataFrame:
    """Partitions from a date on, plus the one of rows without a date."""
    return bronze_status.filter(
        (F.col("event_date") >= F.lit(day)) | F.col("event_date").isNull()
    )


def above_mark(bronze_status: DataFrame, mark: datetime | None, epoch_unit: str = "s") -> DataFrame:
    """Rows reported after the mark. The date test is a literal on the partition
    column, so earlier partitions are not listed; rows without a date (odd
    epochs) are still compared.

    A high-water mark on report time: rows that arrive late, with a report time
    at or before the mark, are not in this result; ``landed_since`` has them.
    """
    if mark is None:
        return bronze_status
    seconds = int(mark.replace(tzinfo=timezone.utc).timestamp())
    return _from_date(bronze_status, mark.date()).filter(
        whole_seconds(F.col("station_status_last_reported"), epoch_unit) > seconds
    )


def landed_since(bronze: DataFrame, mark: datetime) -> DataFrame:
    """Rows that landed at a time or later, whenever they were reported: what an
    incremental build has to read, late reports included."""
    return bronze.filter(F.col("ingested_at") >= F.lit(mark))


def log_row(
    spark: SparkSession,
    run_id: str,
    pipeline: str,
    layer: str,
    state: str,
    rows: int = 0,
    error: str | None = None,
    seconds: float | None = None,
) -> DataFrame:
    if layer not in LAYERS or state not in RUN_STATES:
        raise ValueError(f"unknown layer or state: {layer}, {state}")
    duration = None if seconds is None else Decimal(f"{seconds:.2f}")
    record = (
        run_id,
        datetime.now(timezone.utc),
        pipeline,
        layer,
        state,
        rows,
        error,
        duration,
    )
    return spark.createDataFrame([record], schemas.RUN_LOG)


@contextmanager
def logged_run(spark: SparkSession, path: str, pipeline: str, layer: str):
    """Log a layer run: RUNNING at the start, SUCCESS or FAILED at the end. The
    caller puts the row count into the dict it is given, which has the run's id."""
    start = time.time()
    run_id = hashlib.sha256(f"{pipeline}|{layer}|{start!r}".encode()).hexdigest()
    result = {"rows": 0, "run_id": run_id}

    def log(*args):
        log_row(spark, run_id, pipeline, layer, *args).coalesce(1).write.mode("append").parquet(path)

    log("RUNNING")
    try:
        yield result
    except Exception as problem:
        log("FAILED", result["rows"], str(problem), time.time() - start)
        raise
    log("SUCCESS", result["rows"], None, time.time() - start)


def runs(log: DataFrame) -> DataFrame:
    """Each run's latest state."""
    done = F.when(F.col("status") == "RUNNING", 0).otherwise(1)
    picked = log.groupBy("run_id").agg(F.max_by(F.struct(*log.columns), done).alias("r"))
    return picked.select("r.*")


def load_counts(bronze: DataFrame) -> DataFrame:
    """Rows landed per source file."""
    return bronze.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_loaded"))
