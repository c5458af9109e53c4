"""Silver, SQL model: validated station information and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.functions.scalars import epoch_to_ts, to_flag
from stationlake.operators.quality import at_least_zero, between, not_null, with_violations

INFO_COLUMNS = [
    "station_id",
    "station_name",
    "lat",
    "lon",
    "region_id",
    "capacity",
    "has_kiosk",
    "station_information_last_updated",
    "missing_station_information",
    "bronze_ingested_at",
    "silver_loaded_at",
]
STATUS_COLUMNS = [
    "station_id",
    "num_bikes_available",
    "num_ebikes_available",
    "num_bikes_disabled",
    "num_docks_available",
    "num_docks_disabled",
    "is_installed",
    "is_renting",
    "is_returning",
    "station_status_last_reported",
    "last_reported_ts",
    "region_id",
    "bronze_ingested_at",
    "silver_loaded_at",
]


def _flag_rule(name: str) -> dict[str, Column]:
    """A text that is no flag breaks the rule; an absent one does not."""
    return {f"{name}_flag": F.col(f"{name}_text").isNull() | F.col(name).isNotNull()}


def _with_flags(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.withColumns({f"{n}_text": F.col(n) for n in names}).withColumns(
        {n: to_flag(F.col(f"{n}_text")) for n in names}
    )


def check_info(bronze_info: DataFrame, epoch_unit: str = "s") -> DataFrame:
    """Typed station information, every row, with the rules it breaks."""
    flags = ["has_kiosk", "missing_station_information"]
    typed = _with_flags(bronze_info, flags).withColumns(
        {
            "station_information_last_updated": epoch_to_ts(
                F.col("station_information_last_updated"), epoch_unit
            ),
            "bronze_ingested_at": F.col("ingested_at"),
            "silver_loaded_at": F.current_timestamp(),
        }
    )
    rules = {
        **not_null(
            "station_name", "lat", "lon", "capacity", "station_information_last_updated"
        ),
        **at_least_zero("capacity"),
        **between(-90, 90, "lat"),
        **between(-180, 180, "lon"),
        **_flag_rule("has_kiosk"),
        **_flag_rule("missing_station_information"),
    }
    return with_violations(typed, rules).select(*INFO_COLUMNS, "violations")


def check_status(bronze_status: DataFrame, info: DataFrame, epoch_unit: str = "s") -> DataFrame:
    """Typed status with the station's region, every row, with the rules it breaks.

    ``info`` is the valid station information, one row per station. One left
    join both fetches the region and tells whether the station is known. Give a
    stored ``info``: Catalyst then knows its size before the join and need not
    shuffle the status side while it is below the broadcast threshold.
    """
    known = info.select("station_id", "region_id", F.lit(True).alias("known"))
    typed = (
        _with_flags(bronze_status, ["is_installed", "is_renting", "is_returning"])
        .withColumns(
            {
                "last_reported_ts": epoch_to_ts(
                    F.col("station_status_last_reported"), epoch_unit
                ),
                "bronze_ingested_at": F.col("ingested_at"),
                "silver_loaded_at": F.current_timestamp(),
            }
        )
        .join(known, "station_id", "left")
    )
    rules = {
        **not_null(
            "num_bikes_available",
            "num_bikes_disabled",
            "num_docks_available",
            "is_installed",
            "is_renting",
            "is_returning",
            "last_reported_ts",
        ),
        **at_least_zero(
            "num_bikes_available",
            "num_docks_available",
            "num_bikes_disabled",
            "num_docks_disabled",
        ),
        "station_unknown": F.col("known").isNotNull(),
    }
    return with_violations(typed, rules).select(*STATUS_COLUMNS, "violations")


def orphans(checked_status: DataFrame) -> DataFrame:
    """Status rows whose station has no valid information."""
    return checked_status.filter(F.array_contains("violations", "station_unknown"))
