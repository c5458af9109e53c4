"""Runs over whole layers: the bronze-silver-gold pipeline and the batch load."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.functions.scalars import BULK_NULLS, partition_date
from stationlake.operators import control, ledger, quality
from stationlake.operators.ingest import (
    INFO,
    STATUS,
    dead_letters,
    first_fault,
    land,
    land_dead_letters,
    sound_lines,
)
from stationlake.plans import gold, gold_sql, silver, silver_sql
from stationlake.sources import layers
from stationlake.sources.csv_feed import read_feed_csv, sample_first_m
from stationlake.sources.messages import (
    TOPIC_INFO,
    TOPIC_STATUS,
    encode_messages,
    write_kafka,
    write_message_dir,
)

NAME = "stationlake"


@dataclass(frozen=True)
class Lake:
    """Where the tables of a lake are."""

    root: str

    def at(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    @property
    def raw(self) -> str:
        return self.at("bronze", "raw")

    @property
    def raw_stream(self) -> str:
        return self.at("bronze", "raw_stream")

    @property
    def stage(self) -> str:
        return self.at("bronze", "stage")

    @property
    def status(self) -> str:
        return self.at("bronze", STATUS.name)

    @property
    def info(self) -> str:
        return self.at("bronze", INFO.name)

    @property
    def dlq(self) -> str:
        return self.at("bronze", "bronze_dlq")

    @property
    def fact(self) -> str:
        return self.at("silver", "station_status")

    @property
    def dimension(self) -> str:
        return self.at("silver", "station_dimension")

    @property
    def watermark(self) -> str:
        return self.at("control", "pipeline_watermark")

    @property
    def log(self) -> str:
        return self.at("control", "pipeline_log")

    @property
    def ledger(self) -> str:
        return self.at("control", "load_ledger")


@dataclass(frozen=True)
class Config:
    """Settings of a pipeline run."""

    lake: Lake
    csv: str | None = None
    max_files: str | int | None = None
    force_bronze: bool = False
    force_silver: bool = False
    force_gold: bool = False
    use_stream: bool = False
    epoch_unit: str = "s"
    multi_line: bool = False


def _stored_rows(spark: SparkSession, *paths: str) -> int:
    return sum(spark.read.parquet(p).count() for p in paths)


def build_bronze(spark: SparkSession, cfg: Config) -> str:
    """The raw layer: from CSV, or what the append stream has written."""
    if cfg.use_stream:
        if not layers.exists(spark, cfg.lake.raw_stream):
            raise RuntimeError("no streamed bronze yet: run the append stream first")
        return cfg.lake.raw_stream
    if layers.is_complete(spark, cfg.lake.raw) and not cfg.force_bronze:
        return cfg.lake.raw
    if cfg.csv is None:
        raise ValueError("bronze is missing and no CSV folder was given")
    feed = read_feed_csv(
        spark, cfg.csv, max_files=cfg.max_files, multi_line=cfg.multi_line
    )
    letters = dead_letters(feed, [])
    layers.write_layer(sound_lines(feed).drop("malformed"), cfg.lake.raw, force=True)
    land_dead_letters(letters, cfg.lake.dlq)
    return cfg.lake.raw


def build_silver(spark: SparkSession, cfg: Config, bronze: str) -> tuple[str, str]:
    """Fact and dimension. Both read the stored bronze with the columns they
    need; skipped only if both are complete."""
    lake = cfg.lake
    done = layers.is_complete(spark, lake.fact) and layers.is_complete(spark, lake.dimension)
    if not done or cfg.force_silver:
        parsed = silver.parse(
            layers.read_layer(spark, bronze, schemas.RAW_LAYER), cfg.epoch_unit
        )
        fact = silver.status_fact(parsed).withColumn(
            "date", partition_date(F.col("reported_at"))
        )
        layers.write_layer(
            fact, lake.fact, ["date"], ["station_id", "reported_at"], force=True
        )
        layers.write_layer(silver.station_dimension(parsed), lake.dimension, force=True)
    return lake.fact, lake.dimension


def read_silver(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    return (
        layers.read_layer(spark, lake.fact, schemas.SILVER_FACT),
        layers.read_layer(spark, lake.dimension, schemas.SILVER_DIMENSION),
    )


def build_gold(spark: SparkSession, cfg: Config) -> dict[str, str]:
    fact, dimension = read_silver(spark, cfg.lake)
    fact = fact.drop("date")
    views = {
        "daily_station_summary": (gold.daily_summary(fact, dimension), ["date"]),
        "hourly_patterns": (gold.hourly_patterns(fact), ["date"]),
        "station_summary": (gold.station_summary(fact, dimension), []),
    }
    return {
        name: layers.write_layer(
            view, cfg.lake.at("gold", name), by, ["station_id"], cfg.force_gold
        )
        for name, (view, by) in views.items()
    }


def run_pipeline(spark: SparkSession, cfg: Config) -> dict[str, str]:
    """Bronze, silver, gold; each layer is skipped if complete and not forced.
    Returns the path of every table."""
    log = cfg.lake.log
    with control.logged_run(spark, log, NAME, "BRONZE") as run:
        bronze = build_bronze(spark, cfg)
        run["rows"] = _stored_rows(spark, bronze)
    with control.logged_run(spark, log, NAME, "SILVER") as run:
        fact, dimension = build_silver(spark, cfg, bronze)
        run["rows"] = _stored_rows(spark, fact, dimension)
    with control.logged_run(spark, log, NAME, "GOLD") as run:
        views = build_gold(spark, cfg)
        run["rows"] = _stored_rows(spark, *views.values())
    return {"bronze": bronze, "silver_status": fact, "silver_dimension": dimension, **views}


def side_by_side(spark: SparkSession, jobs: dict[str, Callable]) -> dict:
    """Run independent jobs at once, so that one fills the cores another's last
    tasks leave idle; each writes a table of its own."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        target = inheritable_thread_target(spark)
        started = {name: pool.submit(target(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in started.items()}


def load_batch(
    spark: SparkSession,
    paths: str | list[str],
    lake: Lake,
    max_files: str | int | None = None,
    on_bad: str = "quarantine",
    epoch_unit: str = "s",
    multi_line: bool = False,
    log: bool = True,
) -> dict[str, int]:
    """Load CSV files into the two bronze tables; known keys are skipped.

    The text is parsed once, into a stage that each load replaces; status, info
    and dead letters then read only their columns from it. Under ``fail`` the
    stage is checked for both tables before either is written. The run log and
    the ledger get the load (not with ``log=False``, for timing the load alone);
    ``loaded_by_file`` tells what it inserted.
    """
    logged = control.logged_run(spark, lake.log, f"{NAME}_load", "BRONZE") if log else nullcontext({})
    with logged as run:
        feed = read_feed_csv(spark, paths, BULK_NULLS, max_files, multi_line)
        layers.write_layer(feed, lake.stage, force=True)
        stage = layers.read_layer(spark, lake.stage, schemas.STAGE)
        fault = first_fault(stage) if on_bad == "fail" else None
        if fault:
            raise ValueError(fault)
        note = ledger.LoadNote(spark, lake.ledger, run["run_id"]) if log else None
        loaded = _land_stage(spark, stage, lake, on_bad, epoch_unit, note)
        run["rows"] = loaded["status"] + loaded["info"]
    return loaded


def _land_stage(
    spark: SparkSession,
    stage: DataFrame,
    lake: Lake,
    on_bad: str,
    epoch_unit: str,
    note: ledger.LoadNote | None,
) -> dict[str, int]:
    jobs = {
        "status": lambda: land(stage, STATUS, lake.status, "batch", on_bad, epoch_unit, note),
        "info": lambda: land(stage, INFO, lake.info, "batch", on_bad, epoch_unit, note),
    }
    if on_bad == "quarantine":
        jobs["dead_letters"] = lambda: land_dead_letters(dead_letters(stage), lake.dlq)
    loaded = side_by_side(spark, jobs)
    control.store_watermark(spark, lake.watermark, bronze_tables(spark, lake), epoch_unit)
    return loaded


def loaded_by_file(spark: SparkSession, lake: Lake, run_id: str | None = None) -> DataFrame:
    """table_name, source_file, rows_loaded of a load (default: the last), from
    the ledger: the tables are not read."""
    run_id = run_id or last_load_id(spark, lake)
    counts = ledger.counts_by_file(ledger.read(spark, lake.ledger), run_id or "")
    return counts.select("table_name", "source_file", "rows_loaded")


def _loads(spark: SparkSession, lake: Lake) -> DataFrame:
    log = layers.read_or_empty(spark, lake.log, schemas.RUN_LOG)
    return log.filter(
        (F.col("pipeline_name") == f"{NAME}_load") & (F.col("status") == "RUNNING")
    )


def last_load_id(spark: SparkSession, lake: Lake) -> str | None:
    """The last batch load, from the run log."""
    return _loads(spark, lake).agg(F.max_by("run_id", "run_ts")).first()[0]


def last_load(spark: SparkSession, lake: Lake) -> datetime | None:
    """When the last batch load began, from the run log."""
    return _loads(spark, lake).agg(F.max("run_ts")).first()[0]


def bronze_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    return {
        INFO.name: layers.read_or_empty(spark, lake.info, INFO.schema),
        STATUS.name: layers.read_or_empty(spark, lake.status, STATUS.schema),
    }


def produce(
    spark: SparkSession,
    paths: str | list[str],
    topic_dir: str,
    max_files: str | int | None = None,
    max_rows: int | None = None,
    multi_line: bool = False,
    kafka: str | None = None,
    dlq: str | None = None,
) -> dict[str, int]:
    """Send CSV rows as messages to the topic directories, or to Kafka; return
    rows sent. Lines that are no rows go to the dead letters at ``dlq``; without
    one the first of them raises."""
    feed = read_feed_csv(spark, paths, (), max_files, multi_line)
    if dlq:
        land_dead_letters(dead_letters(feed, []), dlq)
    feed = sound_lines(feed, "quarantine" if dlq else "fail").drop("malformed")
    if max_rows is not None:
        feed = sample_first_m(feed, max_rows)
    sent = Observation()

    def rows_of(topic: str):
        return F.coalesce(F.sum(F.when(F.col("topic") == topic, F.col("rows"))), F.lit(0))

    messages = encode_messages(feed).observe(
        sent, rows_of(TOPIC_STATUS).alias("status"), rows_of(TOPIC_INFO).alias("info")
    )
    if kafka:
        write_kafka(messages, kafka)
    else:
        write_message_dir(messages, topic_dir)
    return dict(sent.get)


def build_warehouse(
    spark: SparkSession,
    lake: Lake,
    raw: DataFrame | None = None,
    epoch_unit: str = "s",
    since: datetime | None = None,
) -> dict[str, str]:
    """Silver and gold of the SQL model from the bronze tables, as logged runs.

    The station information is stored before the status joins it, so that
    Catalyst knows its size. Rejected rows are stored with the rules they
    break; each checked gold table is computed once and split the same way.
    With ``raw`` (the rows the load was made from) the data-quality audit log
    gets one more set of metrics; ``since``, the start of that load, keeps
    earlier loads out of its rates.
    """
    paths: dict[str, str] = {}
    with control.logged_run(spark, lake.log, f"{NAME}_warehouse", "SILVER") as run:
        info_all, info, status_all, status = _warehouse_silver(spark, lake, epoch_unit, paths)
        run["rows"] = info.count() + status.count()
    with control.logged_run(spark, lake.log, f"{NAME}_warehouse", "GOLD") as run:
        run["rows"] = _warehouse_gold(spark, lake, info, status, paths)
        if raw is not None:
            landed = [
                (landing, rows if since is None else rows.filter(F.col("bronze_ingested_at") >= F.lit(since)))
                for landing, rows in ((STATUS, status_all), (INFO, info_all))
            ]
            metrics = quality.quality_metrics(raw, landed)
            paths["gold_data_quality"] = lake.at("gold", "gold_data_quality")
            quality.as_audit_rows(metrics).write.mode("append").parquet(paths["gold_data_quality"])
    return paths


def _warehouse_silver(
    spark: SparkSession, lake: Lake, epoch_unit: str, paths: dict[str, str]
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """All checked and all valid rows, of station information and of status."""

    def store_checked(checked: DataFrame, name: str, by: list[str]) -> tuple:
        """One write for accepted and rejected rows; each is a folder of its own."""
        split = checked.withColumn("accepted", F.size("violations") == 0)
        path = lake.at("silver", f"{name}_checked")
        layers.write_layer(split, path, ["accepted", *by], ["station_id"], force=True)
        paths[name], paths[f"{name}_rejected"] = f"{path}/accepted=true", f"{path}/accepted=false"
        schema = checked.schema
        return (
            layers.read_layer(spark, path, split.schema).drop("accepted"),
            layers.read_or_empty(spark, paths[name], schema).drop("violations", *by),
        )

    bronze = bronze_tables(spark, lake)
    info_all, info = store_checked(
        silver_sql.check_info(bronze[INFO.name], epoch_unit), "silver_station_information", []
    )
    checked = silver_sql.check_status(bronze[STATUS.name], info, epoch_unit)
    status_all, status = store_checked(
        checked.withColumn("date", partition_date(F.col("last_reported_ts"))),
        "silver_station_status",
        ["date"],
    )

    return info_all, info, status_all, status


def _warehouse_gold(
    spark: SparkSession, lake: Lake, info: DataFrame, status: DataFrame, paths: dict[str, str]
) -> int:
    """Store the gold tables and what breaks their bounds; rows of the tables."""
    breaches, rows = None, 0

    def store(name: str, computed: DataFrame) -> DataFrame:
        """Kept and withheld rows from one computation."""
        nonlocal breaches, rows
        checked = layers.stored(computed, lake.at("gold", f"{name}_checked"))
        good = quality.kept(checked)
        paths[name] = lake.at("gold", name)
        layers.stored(gold_sql.as_table(good), paths[name])
        rows += good.count()
        found = quality.violation_rows(checked, name, gold_sql.KEYS[name])
        breaches = found if breaches is None else breaches.unionByName(found)
        return good

    availability = store("gold_station_availability", gold_sql.station_availability(status, info))
    store("gold_station_summary", gold_sql.station_summary(status, info))
    store("gold_region_summary", gold_sql.region_summary(availability))
    store("gold_station_daily", gold_sql.station_daily(status, info))
    paths["bounds_violations"] = lake.at("gold", "bounds_violations")
    layers.stored(breaches, paths["bounds_violations"])
    return rows
