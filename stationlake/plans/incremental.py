"""Silver and gold of the SQL model, kept up to date load by load.

Only the date partitions that loads have touched since the last build are read
from bronze and written again, late reports included; what they say comes from
the ledger of loads. Status of stations without valid information waits in its
own partitions, and when a later load brings the information, the waiting rows
move on without bronze being read. Lifetime summaries are merged from stored
sums, counts, minima and maxima per station and day, and per station and month.

Every step replaces whole partitions, adds keys that are missing, or writes a
version, so a build that crashed is run again as it is. One build at a time;
loads may go on meanwhile, the next build takes them in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.scalars import epoch_to_date
from stationlake.operators import control, ledger, quality
from stationlake.operators.ingest import INFO, STATUS
from stationlake.operators.insert import absent_from, in_partitions, partition_values
from stationlake.plans import gold_sql, silver_sql
from stationlake.plans.pipeline import NAME, Lake
from stationlake.session import fresh_dir
from stationlake.sources import layers

KEYS = ["station_id", "station_status_last_reported"]
ACCEPTED, REJECTED, WAITING = "accepted", "rejected", "waiting"
UNKNOWN = "station_unknown"

# The partial aggregates of a lifetime summary, by output name.
SUMS = {
    "bikes": "num_bikes_available",
    "docks": "num_docks_available",
    "renting": "is_renting",
    "installed": "is_installed",
}
COUNTS = {f"{name}_seen": column for name, column in SUMS.items()}
LEAST = {"min_bikes_available": "num_bikes_available", "first_seen_ts": "last_reported_ts"}
MOST = {"max_bikes_available": "num_bikes_available", "last_seen_ts": "last_reported_ts"}


def status_path(lake: Lake) -> str:
    """Checked status by event date and state."""
    return lake.at("silver", "status_by_date")


def info_path(lake: Lake) -> str:
    return lake.at("silver", "information_current")


def built_path(lake: Lake) -> str:
    return lake.at("control", "built_runs")


def partials_path(lake: Lake, level: str) -> str:
    return lake.at("gold", f"station_{level}_partials")


def summary_path(lake: Lake) -> str:
    return lake.at("gold", "station_summary_merged")


def _state() -> Column:
    return (
        F.when(F.array_contains("violations", UNKNOWN), F.lit(WAITING))
        .when(F.size("violations") > 0, F.lit(REJECTED))
        .otherwise(F.lit(ACCEPTED))
    )


def check_dates(
    spark: SparkSession, lake: Lake, info: DataFrame, dates: Sequence[date | None], epoch_unit: str
) -> DataFrame:
    """Checked status of the given event dates; bronze has the same partitions,
    of which no other is read."""
    bronze = layers.read_or_empty(spark, lake.status, STATUS.schema)
    touched = bronze.filter(in_partitions("event_date", dates))
    checked = silver_sql.check_status(touched, info, epoch_unit)
    day = epoch_to_date(F.col("station_status_last_reported"), epoch_unit)
    return checked.withColumns({"event_date": day, "state": _state()})


_SCHEMAS: dict[str, T.StructType] = {}


def _schema(name: str, rows: Callable[[], DataFrame]) -> T.StructType:
    """Schema of a stored table, which its expressions fix once and for all."""
    if name not in _SCHEMAS:
        _SCHEMAS[name] = rows().schema
    return _SCHEMAS[name]


def read_states(spark: SparkSession, lake: Lake) -> DataFrame:
    """Stored status of every ``state``, with ``violations`` and ``event_date``."""
    schema = _schema("status", lambda: check_dates(spark, lake, read_info(spark, lake), [], "s"))
    return layers.read_or_empty(spark, status_path(lake), schema)


def read_status(spark: SparkSession, lake: Lake, state: str = ACCEPTED) -> DataFrame:
    """Stored status of one state."""
    return read_states(spark, lake).filter(F.col("state") == state).drop("state")


def read_info(spark: SparkSession, lake: Lake) -> DataFrame:
    empty = spark.createDataFrame([], INFO.schema)
    schema = _schema("info", lambda: quality.kept(silver_sql.check_info(empty)))
    return layers.read_current(spark, info_path(lake), schema)


def new_info(spark: SparkSession, lake: Lake, epoch_unit: str) -> tuple[DataFrame, DataFrame]:
    """The valid station information, and the stations that the current version
    of it lacks. It becomes the current one only once their waiting rows have
    moved on, so that a crash does not hide them."""
    before = read_info(spark, lake)
    bronze = layers.read_or_empty(spark, lake.info, INFO.schema)
    valid = quality.kept(silver_sql.check_info(bronze, epoch_unit))
    info = layers.stored(valid, fresh_dir(spark, "information"))
    new = info.join(before.select("station_id"), "station_id", "left_anti")
    return info, layers.stored(new.select("station_id", "region_id"), fresh_dir(spark, "new-stations"))


def rebuild_dates(
    spark: SparkSession, lake: Lake, info: DataFrame, dates: Sequence[date | None], epoch_unit: str
) -> int:
    """Check the given dates anew and replace them in silver; accepted rows.

    Rows of bronze and of valid information never change, so a date's accepted
    and rejected rows only grow in number and are replaced by the write. Its
    waiting rows may all have gone, which the write cannot show: then their
    folder goes too.
    """
    if not dates:
        return 0
    seen = Observation()
    day = F.coalesce(F.col("event_date").cast("string"), F.lit(layers.NO_VALUE))
    checked = check_dates(spark, lake, info, dates, epoch_unit).observe(
        seen,
        F.count(F.when(F.col("state") == ACCEPTED, 1)).alias("accepted"),
        F.collect_set(F.when(F.col("state") == WAITING, day)).alias("waiting"),
    )
    layers.overwrite_partitions(checked, status_path(lake), ["event_date", "state"], KEYS)
    found = seen.get
    _drop_waiting(spark, lake, [d for d in dates if str(d or layers.NO_VALUE) not in found["waiting"]])
    return found["accepted"]


def _drop_waiting(spark: SparkSession, lake: Lake, dates: Sequence[date | None]) -> None:
    for day in dates:
        folder = layers.partition_path(status_path(lake), "event_date", day)
        layers.remove(spark, layers.partition_path(folder, "state", WAITING))


def heal_waiting(spark: SparkSession, lake: Lake, new: DataFrame) -> list[date | None]:
    """Move waiting rows of stations that are new on to accepted or rejected;
    return the dates they have.

    They are joined with the new stations alone and not checked again, as only
    the unknown station and the region were open. They are added first and taken
    away afterwards: after a crash in between they are skipped as known keys.
    """
    if not layers.exists(spark, status_path(lake)):
        return []
    path = status_path(lake)
    waiting = read_status(spark, lake, WAITING)
    schema = T.StructType([*waiting.schema.fields, T.StructField("state", T.StringType())])
    known = waiting.drop("region_id").join(new, "station_id")
    healed = layers.stored(
        known.withColumn("violations", F.array_remove("violations", UNKNOWN))
        .withColumn("state", _state())
        .select(*schema.fieldNames()),
        fresh_dir(spark, "healed"),
    )
    dates = partition_values(healed, "event_date")
    if not dates:
        return []
    touched = in_partitions("event_date", dates)
    existing = layers.read_layer(spark, path, schema).filter(touched & (F.col("state") != WAITING))
    added = absent_from(healed, existing, KEYS).select(*schema.fieldNames())
    by = ["event_date", "state"]
    layers.by_partition(added, by, KEYS).write.mode("append").partitionBy(*by).parquet(path)
    left = layers.stored(
        waiting.filter(touched)
        .join(new.select("station_id"), "station_id", "left_anti")
        .withColumn("state", F.lit(WAITING))
        .select(*schema.fieldNames()),
        fresh_dir(spark, "still-waiting"),
    )
    stay = set(partition_values(left, "event_date"))
    if stay:
        layers.overwrite_partitions(left, path, by, KEYS)
    _drop_waiting(spark, lake, [d for d in dates if d not in stay])
    return dates


# --- lifetime summaries from partials ---------------------------------------


def partials(status: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums, counts, minima and maxima of status rows: never a mean, so partials
    of disjoint rows can be merged exactly."""
    return status.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("snapshot_count"),
        *(F.sum(F.col(c).cast("bigint")).alias(name) for name, c in SUMS.items()),
        *(F.count(c).alias(name) for name, c in COUNTS.items()),
        *(F.min(c).alias(name) for name, c in LEAST.items()),
        *(F.max(c).alias(name) for name, c in MOST.items()),
    )


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partials of fewer keys: the same columns, in any number of steps."""
    return parts.groupBy(*keys).agg(
        *(F.sum(name).alias(name) for name in ("snapshot_count", *SUMS, *COUNTS)),
        *(F.min(name).alias(name) for name in LEAST),
        *(F.max(name).alias(name) for name in MOST),
    )


def summary(parts: DataFrame, info: DataFrame) -> DataFrame:
    """``gold_sql.station_summary`` from partials per station."""
    mean = gold_sql.ratio_of_sums
    stations = info.select("station_id", "station_name", "region_id", "capacity")
    seen = F.col("bikes_seen") * F.col("capacity")
    rows = parts.join(stations, "station_id", "left").select(
        "station_id",
        "station_name",
        "region_id",
        "capacity",
        "snapshot_count",
        mean("bikes", "bikes_seen").alias("avg_bikes_available"),
        "max_bikes_available",
        "min_bikes_available",
        mean("docks", "docks_seen").alias("avg_docks_available"),
        mean("bikes", seen, 4).alias("avg_utilization"),
        mean("bikes", seen, 2, 100).alias("avg_availability_pct"),
        mean("renting", "renting_seen", 2, 100).alias("pct_time_renting"),
        mean("installed", "installed_seen", 2, 100).alias("pct_time_installed"),
        "first_seen_ts",
        "last_seen_ts",
    )
    return quality.with_violations(rows, gold_sql.summary_rules())


def _month() -> Column:
    return F.date_format("event_date", "yyyy-MM")


def update_partials(spark: SparkSession, lake: Lake, dates: Sequence[date | None]) -> None:
    """Replace the partials of the given days, then of their months from days."""
    days, months = partials_path(lake, "day"), partials_path(lake, "month")
    status = read_status(spark, lake).filter(in_partitions("event_date", dates))
    by_day = partials(status, ["station_id", "event_date"])
    layers.overwrite_partitions(by_day, days, ["event_date"], ["station_id"])
    touched = sorted({(d.year, d.month) for d in dates if d is not None})
    inside = F.col("event_date").isNull() if None in dates else F.lit(False)
    for year, month in touched:
        after = date(year + month // 12, month % 12 + 1, 1)
        inside = inside | ((F.col("event_date") >= F.lit(date(year, month, 1))) & (F.col("event_date") < F.lit(after)))
    stored = layers.read_or_empty(spark, days, by_day.schema).filter(inside)
    by_month = merged(stored.withColumn("month", _month()), ["station_id", "month"])
    layers.overwrite_partitions(by_month, months, ["month"], ["station_id"])


def read_lifetime(spark: SparkSession, lake: Lake) -> DataFrame:
    """Partials per station over all its months."""
    schema = _schema(
        "month",
        lambda: merged(
            partials(read_status(spark, lake).withColumn("month", _month()), ["station_id", "month"]),
            ["station_id", "month"],
        ),
    )
    stored = layers.read_or_empty(spark, partials_path(lake, "month"), schema)
    return merged(stored, ["station_id"])


# --- the build --------------------------------------------------------------


def update_warehouse(spark: SparkSession, lake: Lake, epoch_unit: str = "s") -> dict[str, int]:
    """Take in what loads have landed since the last build; how many dates were
    built anew, how many had waiting rows moved on, and accepted rows."""
    done = {"dates": 0, "healed_dates": 0, "accepted": 0}
    notes = layers.stored(
        ledger.open_notes(spark, lake.ledger, built_path(lake)), fresh_dir(spark, "notes")
    )
    touched = notes.filter(F.col("state") == "TOUCHED")
    if notes.isEmpty():
        return done
    with control.logged_run(spark, lake.log, f"{NAME}_update", "SILVER") as run:
        info, new = new_info(spark, lake, epoch_unit)
        dates = partition_values(touched.filter(F.col("table_name") == STATUS.name), "event_date")
        done["dates"] = len(dates)
        run["rows"] = done["accepted"] = rebuild_dates(spark, lake, info, dates, epoch_unit)
        healed = heal_waiting(spark, lake, new)
        layers.write_version(info, info_path(lake))
        done["healed_dates"] = len(healed)
    with control.logged_run(spark, lake.log, f"{NAME}_update", "GOLD") as run:
        changed = list({*dates, *healed})
        if changed:
            update_partials(spark, lake, changed)
        kept = Observation()
        rows = quality.kept(summary(read_lifetime(spark, lake), info))
        counted = gold_sql.as_table(rows).observe(kept, F.count(F.lit(1)).alias("rows"))
        layers.write_version(counted, summary_path(lake))
        run["rows"] = kept.get["rows"]
    ledger.mark_built(notes, built_path(lake))
    return done
