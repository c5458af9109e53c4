"""A station feed derived from the events, supplier and nation tables.

It has the raw feed's 18 text columns and every oddity the pipeline must cope
with: replays, padded ids, bad numbers, bad epochs, missing metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas

_EXPRESSIONS = {
    "station_id": """CASE WHEN event_id % 997 = 0 THEN NULL
        WHEN event_id % 13 = 0 THEN ' ' || user_id || '  ' ELSE string(user_id) END""",
    "num_bikes_available": """CASE WHEN event_id % 101 = 0 THEN 'n/a'
        ELSE string(bigint(floor(value + replay)) % 40) END""",
    "num_ebikes_available": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE string(event_id % 5) END",
    "num_bikes_disabled": "string(event_id % 3)",
    "num_docks_available": """string(event_id % 43
        - CASE WHEN event_id % 503 = 0 THEN 60 ELSE 0 END)""",
    "num_docks_disabled": "string(event_id % 2)",
    "is_installed": "'1'",
    "is_renting": "CASE WHEN event_type = 'error' THEN '0' ELSE '1' END",
    "is_returning": "CASE WHEN event_id % 11 = 0 THEN '0' ELSE '1' END",
    "station_status_last_reported": """CASE WHEN event_id % 211 = 0 THEN '0'
        WHEN event_id % 499 = 0 THEN NULL ELSE string(ep) END""",
    "station_name": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE s_name || ' ' END",
    "lat": "'40.' || lpad(string(s_suppkey), 4, '0')",
    "lon": "'-74.' || lpad(string(s_suppkey), 4, '0')",
    "region_id": "string(n_regionkey)",
    "capacity": "string(20 + s_suppkey % 40)",
    "has_kiosk": """CASE WHEN s_suppkey % 2 = 0 THEN 'True'
        WHEN s_suppkey IS NOT NULL THEN 'false' END""",
    "station_information_last_updated": "string(ep)",
    "missing_station_information": """CASE WHEN s_suppkey IS NULL THEN 'true'
        WHEN event_id % 19 = 0 THEN 'False' ELSE 'false' END""",
}


def derived_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows plus arrival order. Joins are left to Catalyst: it broadcasts
    supplier and nation only while their size is below its threshold."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    joined = events.join(supplier, F.col("s_suppkey") == F.col("user_id"), "left").join(
        nation, F.col("n_nationkey") == F.col("s_nationkey"), "left"
    )
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    rows = joined.withColumns(
        {"replay": F.explode(copies), "ep": F.expr("unix_timestamp(ts)")}
    )
    return rows.select(
        *(F.expr(text).alias(name) for name, text in _EXPRESSIONS.items()),
        F.expr("'feed_' || date_format(ts, 'yyyyMMdd') || '.csv'").alias("source_file"),
        F.lit("events").alias("arrival_source"),
        (F.col("event_id") * 2 + F.col("replay")).alias("arrival_pos"),
    ).select(*schemas.RAW_COLUMNS, "source_file", *schemas.ARRIVAL)
