"""The ledger of loads: which partitions a load touches, what it added to them
per source file, and which loads the layers above have taken in.

A load notes its partitions before it writes, so that none is missed if it
crashes; its counts come from the files it wrote, not from the table. A load that
never ended stays open: its partitions are built again each time, which changes
nothing but the time it takes.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.operators.ingest import Landing
from stationlake.operators.insert import Landed
from stationlake.sources import layers

_STORED = [c for c in schemas.LEDGER.fieldNames() if c != "table_name"]
STATES = ("TOUCHED", "LANDED", "DONE")


class LoadNote:
    """Writes one load's part of the ledger. Each table has a folder of its own
    there, as tables are loaded side by side."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.path, self.run_id = spark, path, run_id

    def _append(self, rows: DataFrame, landing: Landing) -> None:
        folder = layers.partition_path(self.path, "table_name", landing.name)
        rows.select(*_STORED).coalesce(1).write.mode("append").parquet(folder)

    def _note(self, landing: Landing, rows: list[tuple]) -> None:
        now = datetime.now(timezone.utc)
        data = [(self.run_id, landing.name, *row, now) for row in rows]
        self._append(self.spark.createDataFrame(data, schemas.LEDGER), landing)

    def touched(self, landing: Landing, values: list | None) -> None:
        days = [None] if values is None else values
        if days:
            self._note(landing, [("TOUCHED", None, day, None) for day in days])

    def landed(self, landing: Landing, target: str, landed: Landed) -> None:
        if landed.files:
            day = F.col(landing.partition_by) if landing.partition_by else F.lit(None).cast("date")
            added = self.spark.read.schema(landing.schema).option("basePath", target)
            counts = (
                added.parquet(*landed.files)
                .groupBy("source_file", day.alias("event_date"))
                .agg(F.count(F.lit(1)).alias("rows_loaded"))
            )
            named = {
                "run_id": F.lit(self.run_id),
                "state": F.lit("LANDED"),
                "noted_at": F.current_timestamp(),
            }
            self._append(counts.withColumns(named), landing)
        self._note(landing, [("DONE", None, None, landed.rows)])


def read(spark: SparkSession, path: str) -> DataFrame:
    return layers.read_or_empty(spark, path, schemas.LEDGER)


def counts_by_file(ledger: DataFrame, run_id: str | None = None) -> DataFrame:
    """run_id, table_name, source_file, rows_loaded: what loads added, per file."""
    landed = ledger.filter(F.col("state") == "LANDED")
    if run_id is not None:
        landed = landed.filter(F.col("run_id") == run_id)
    return landed.groupBy("run_id", "table_name", "source_file").agg(
        F.sum("rows_loaded").alias("rows_loaded")
    )


def open_notes(spark: SparkSession, ledger_path: str, built_path: str) -> DataFrame:
    """The ledger's rows of loads that no build has taken in yet."""
    built = layers.read_or_empty(spark, built_path, schemas.BUILT_RUNS)
    return read(spark, ledger_path).join(built, "run_id", "left_anti")


def mark_built(notes: DataFrame, built_path: str) -> None:
    """All ended loads among the notes are taken in. A load has ended when every
    table that it touched is done."""
    per_table = notes.groupBy("run_id", "table_name").agg(
        F.bool_or(F.col("state") == "DONE").alias("done")
    )
    ended = per_table.groupBy("run_id").agg(F.bool_and("done").alias("done")).filter("done")
    ended.select("run_id", F.current_timestamp().alias("built_at")).coalesce(1).write.mode(
        "append"
    ).parquet(built_path)
