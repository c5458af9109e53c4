"""Silver, DataFrame model: typed rows, status fact, station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.functions.predicates import all_present, has_info_lenient
from stationlake.functions.scalars import epoch_to_ts, strip, to_bool, to_double, to_long
from stationlake.operators.firsts import first_non_null, first_wins, latest_non_null

STATUS_COLUMNS = schemas.COUNT_COLUMNS + schemas.FLAG_COLUMNS

FACT_COLUMNS = ["station_id", "reported_at", *STATUS_COLUMNS, "missing_station_information"]


def parse(raw: DataFrame, epoch_unit: str = "s") -> DataFrame:
    """Type every raw column leniently: what does not parse becomes NULL."""

    def ts(c: str):
        return epoch_to_ts(to_long(F.col(c)), epoch_unit)

    return raw.withColumns(
        {
            "station_id": strip(F.col("station_id")),
            **{c: to_long(F.col(c)) for c in STATUS_COLUMNS},
            "reported_at": ts("station_status_last_reported"),
            "station_name": strip(F.col("station_name")),
            "lat": to_double(F.col("lat")),
            "lon": to_double(F.col("lon")),
            "region_id": to_long(F.col("region_id")),
            "capacity": to_long(F.col("capacity")),
            "has_kiosk": to_bool(F.col("has_kiosk")),
            "info_updated_at": ts("station_information_last_updated"),
            "missing_station_information": to_bool(F.col("missing_station_information")),
        }
    )


def status_fact(parsed: DataFrame) -> DataFrame:
    """One row per station and time, the first to arrive."""
    rows = parsed.filter(all_present("station_id", "reported_at"))
    keyed = rows.select(*FACT_COLUMNS, *schemas.ARRIVAL)
    return first_wins(keyed, ["station_id", "reported_at"]).select(*FACT_COLUMNS)


def station_dimension(parsed: DataFrame, pick: str = "first") -> DataFrame:
    """One row per station: each attribute's first present value by arrival,
    or with ``pick="latest"`` the most recently updated one."""
    rows = parsed.filter(has_info_lenient(F.col("missing_station_information")))
    if pick == "first":
        fixed = [c for c in schemas.DIMENSION_COLUMNS if c != "station_name"]
        found = first_non_null(rows, "station_id", "station_name", fixed)
    elif pick == "latest":
        found = latest_non_null(
            rows,
            "station_id",
            schemas.DIMENSION_COLUMNS[0],
            schemas.DIMENSION_COLUMNS[1:],
            "info_updated_at",
        )
    else:
        raise ValueError(f"pick must be 'first' or 'latest', not {pick!r}")
    return found.select("station_id", *schemas.DIMENSION_COLUMNS)
