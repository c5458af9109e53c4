"""Gold, DataFrame model: daily, hourly and lifetime aggregates.

Each aggregates first and joins the dimension to the small result. No join
hint: the dimension grows with the number of stations, so Catalyst broadcasts
it only while it is below the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions.scalars import round2


def daily_summary(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    daily = fact.groupBy("station_id", F.to_date("reported_at").alias("date")).agg(
        round2(F.avg("num_bikes_available")).alias("avg_bikes_available"),
        F.min("num_bikes_available").alias("min_bikes_available"),
        F.max("num_bikes_available").alias("max_bikes_available"),
        round2(F.avg("num_ebikes_available")).alias("avg_ebikes_available"),
        round2(F.avg("num_docks_available")).alias("avg_docks_available"),
        F.min("num_docks_available").alias("min_docks_available"),
        F.max("num_docks_available").alias("max_docks_available"),
        F.count("reported_at").alias("num_snapshots"),
    )
    return daily.join(dimension, "station_id", "left")


def hourly_patterns(fact: DataFrame) -> DataFrame:
    return fact.groupBy(
        "station_id",
        F.to_date("reported_at").alias("date"),
        F.hour("reported_at").alias("hour"),
    ).agg(
        F.avg("num_bikes_available").alias("avg_bikes"),
        F.avg("num_docks_available").alias("avg_docks"),
        F.avg("num_ebikes_available").alias("avg_ebikes"),
        F.count("reported_at").alias("num_readings"),
    )


def station_summary(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    summary = fact.groupBy("station_id").agg(
        F.min("reported_at").alias("first_seen"),
        F.max("reported_at").alias("last_seen"),
        F.count("reported_at").alias("total_snapshots"),
        round2(F.avg("num_bikes_available")).alias("avg_bikes_available"),
        F.max("num_bikes_available").alias("peak_bikes_available"),
        round2(F.avg("num_docks_available")).alias("avg_docks_available"),
        F.min("num_docks_available").alias("min_docks_available"),
        F.avg(F.col("missing_station_information").cast("int")).alias("pct_missing_info"),
    )
    return summary.join(dimension, "station_id", "left")
