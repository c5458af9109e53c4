"""Gold, SQL model: availability, summaries and dailies with their bounds.

Every table is aggregated from the validated status first; station attributes
join the small result. Utilization and availability divide a station's mean by
its capacity, which equals the mean of the per-row ratio because a station has
one capacity, and needs no join on the large side.

Each function returns all rows with ``violations``: ``quality.kept`` gives the
table, ``quality.violation_rows`` the report. Values are never clamped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.functions.scalars import exact_ratio
from stationlake.operators.firsts import latest_values
from stationlake.operators.quality import at_least_zero, between, with_violations

# Key and numeric columns of each gold table.
KEYS = {
    "gold_station_availability": ["station_id"],
    "gold_station_summary": ["station_id"],
    "gold_region_summary": ["region_id"],
    "gold_station_daily": ["station_id", "station_date"],
}
NUMERIC = {
    "lat": "decimal(11,7)",
    "lon": "decimal(11,7)",
    "availability_pct": "decimal(5,2)",
    "avg_bikes_available": "decimal(7,2)",
    "avg_docks_available": "decimal(7,2)",
    "avg_utilization": "decimal(8,4)",
    "avg_availability_pct": "decimal(5,2)",
    "pct_time_renting": "decimal(5,2)",
    "pct_time_installed": "decimal(5,2)",
    "pct_stations_renting": "decimal(5,2)",
    "avg_bikes": "decimal(7,2)",
    "avg_docks": "decimal(7,2)",
}


def _mean(column: str, scale: int = 1) -> Column:
    return exact_ratio(F.sum(column), F.count(column), 2, scale)


def ratio_of_sums(top: str, bottom: str | Column, digits: int = 2, scale: int = 1) -> Column:
    """A mean or share from sums that are stored already."""
    bottom = F.col(bottom) if isinstance(bottom, str) else bottom
    return exact_ratio(F.col(top), bottom, digits, scale)


def summary_rules() -> dict[str, Column]:
    return {
        **between(0, 1, "avg_utilization"),
        **between(0, 100, "avg_availability_pct", "pct_time_renting", "pct_time_installed"),
    }


def as_table(kept: DataFrame) -> DataFrame:
    """Declared numeric types plus the refresh time, for storing."""
    typed = {c: F.col(c).cast(t) for c, t in NUMERIC.items() if c in kept.columns}
    return kept.withColumns({**typed, "refreshed_at": F.current_timestamp()})


def station_availability(status: DataFrame, info: DataFrame) -> DataFrame:
    """Latest status per station."""
    latest = latest_values(
        status,
        ["station_id"],
        [
            "num_bikes_available",
            "num_ebikes_available",
            "num_docks_available",
            "is_installed",
            "is_renting",
            "is_returning",
            "last_reported_ts",
        ],
        at="station_status_last_reported",
    )
    stations = info.select("station_id", "station_name", "region_id", "lat", "lon", "capacity")
    current = latest.join(stations, "station_id", "left").select(
        "station_id",
        "station_name",
        "region_id",
        "lat",
        "lon",
        "capacity",
        "num_bikes_available",
        "num_ebikes_available",
        "num_docks_available",
        "is_installed",
        "is_renting",
        "is_returning",
        exact_ratio(F.col("num_bikes_available"), F.col("capacity"), 2, 100).alias(
            "availability_pct"
        ),
        "last_reported_ts",
    )
    rules = {
        **between(0, 100, "availability_pct"),
        **between(0, 1, "is_installed", "is_renting", "is_returning"),
    }
    return with_violations(current, rules)


def station_summary(status: DataFrame, info: DataFrame) -> DataFrame:
    """Statistics per station over all its snapshots."""
    totals = status.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("snapshot_count"),
        F.sum("num_bikes_available").alias("bikes"),
        F.count("num_bikes_available").alias("counted"),
        F.max("num_bikes_available").alias("max_bikes_available"),
        F.min("num_bikes_available").alias("min_bikes_available"),
        _mean("num_docks_available").alias("avg_docks_available"),
        _mean("is_renting", 100).alias("pct_time_renting"),
        _mean("is_installed", 100).alias("pct_time_installed"),
        F.min("last_reported_ts").alias("first_seen_ts"),
        F.max("last_reported_ts").alias("last_seen_ts"),
    )
    stations = info.select("station_id", "station_name", "region_id", "capacity")
    capacity_seen = F.col("counted") * F.col("capacity")
    summary = totals.join(stations, "station_id", "left").select(
        "station_id",
        "station_name",
        "region_id",
        "capacity",
        "snapshot_count",
        exact_ratio(F.col("bikes"), F.col("counted"), 2).alias("avg_bikes_available"),
        "max_bikes_available",
        "min_bikes_available",
        "avg_docks_available",
        exact_ratio(F.col("bikes"), capacity_seen, 4).alias("avg_utilization"),
        exact_ratio(F.col("bikes"), capacity_seen, 2, 100).alias("avg_availability_pct"),
        "pct_time_renting",
        "pct_time_installed",
        "first_seen_ts",
        "last_seen_ts",
    )
    return with_violations(summary, summary_rules())


def region_summary(availability: DataFrame) -> DataFrame:
    """Current totals per region over the given availability rows; stations
    without a region are in none.

    The rounded percentages are summed as whole hundredths: the mean then does
    not hang on the order in which tasks deliver their rows.
    """
    hundredths = F.sum((F.col("availability_pct").cast("decimal(12,2)") * 100).cast("bigint"))
    regions = (
        availability.filter(F.col("region_id").isNotNull())
        .groupBy("region_id")
        .agg(
            F.count(F.lit(1)).cast("int").alias("station_count"),
            F.sum(F.col("capacity").cast("bigint")).alias("total_capacity"),
            F.sum(F.col("num_bikes_available").cast("bigint")).alias("total_bikes_available"),
            exact_ratio(hundredths, F.count("availability_pct") * 100, 2).alias(
                "avg_availability_pct"
            ),
            _mean("is_renting", 100).alias("pct_stations_renting"),
        )
    )
    return with_violations(
        regions, between(0, 100, "avg_availability_pct", "pct_stations_renting")
    )


def station_daily(status: DataFrame, info: DataFrame) -> DataFrame:
    """Means per station and day."""
    daily = status.groupBy(
        "station_id", F.to_date("last_reported_ts").alias("station_date")
    ).agg(
        F.sum("num_bikes_available").alias("bikes"),
        F.count("num_bikes_available").alias("counted"),
        _mean("num_docks_available").alias("avg_docks"),
        F.count(F.lit(1)).alias("measurements_count"),
    )
    stations = info.select("station_id", "station_name", "capacity")
    capacity_seen = F.col("counted") * F.col("capacity")
    rows = daily.join(stations, "station_id", "left").select(
        "station_id",
        "station_name",
        "station_date",
        exact_ratio(F.col("bikes"), F.col("counted"), 2).alias("avg_bikes"),
        "avg_docks",
        exact_ratio(F.col("bikes"), capacity_seen, 4).alias("avg_utilization"),
        "measurements_count",
    )
    return with_violations(
        rows,
        {
            **between(0, 1, "avg_utilization"),
            **at_least_zero("avg_bikes", "avg_docks", "measurements_count"),
        },
    )
