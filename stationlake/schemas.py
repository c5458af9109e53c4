"""Declared schemas. Nothing in the package infers a schema from data."""

from pyspark.sql import types as T

# The raw feed's 18 columns, in file order, all text.
RAW_COLUMNS = [
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
    "station_name",
    "lat",
    "lon",
    "region_id",
    "capacity",
    "has_kiosk",
    "station_information_last_updated",
    "missing_station_information",
]

# Arrival order of a row: where it came from, then its place in there. The
# position is a plain BIGINT so that "first in arrival order" can be a hash
# aggregate per source (see operators/firsts.py).
ARRIVAL = ["arrival_source", "arrival_pos"]

# The two topics.
TOPIC_STATUS = "station-status"
TOPIC_INFO = "station-info"

# The longest texts that the tables take.
TEXT_LENGTHS = {
    "station_id": 50,
    "station_name": 200,
    "region_id": 20,
    "has_kiosk": 5,
    "missing_station_information": 5,
    "is_installed": 5,
    "is_renting": 5,
    "is_returning": 5,
}

COUNT_COLUMNS = [
    "num_bikes_available",
    "num_ebikes_available",
    "num_bikes_disabled",
    "num_docks_available",
    "num_docks_disabled",
]
FLAG_COLUMNS = ["is_installed", "is_renting", "is_returning"]

DIMENSION_COLUMNS = [
    "station_name",
    "lat",
    "lon",
    "region_id",
    "capacity",
    "has_kiosk",
    "info_updated_at",
]


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DECIMAL(11,7)": T.DecimalType(11, 7),
    "DECIMAL(10,2)": T.DecimalType(10, 2),
    "STRINGS": T.ArrayType(T.StringType()),
}


def struct(columns: str) -> T.StructType:
    """``"a INT, b STRING"`` as a StructType, without needing a session."""
    pairs = (column.split() for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW = struct(", ".join(f"{c} STRING" for c in RAW_COLUMNS))
ARRIVAL_COLUMNS = "arrival_source STRING, arrival_pos BIGINT"
RAW_LAYER = struct(
    ", ".join(f"{c} STRING" for c in RAW_COLUMNS) + ", source_file STRING, " + ARRIVAL_COLUMNS
)
# A stage also has the lines that are no rows.
STAGE = struct(
    ", ".join(f"{c} STRING" for c in RAW_COLUMNS)
    + ", malformed STRING, source_file STRING, "
    + ARRIVAL_COLUMNS
)

PROVENANCE_COLUMNS = (
    "ingested_at TIMESTAMP, source_file STRING, source_mode STRING, event_id STRING, "
    "kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT"
)
BRONZE_STATUS = struct(
    "station_id STRING, num_bikes_available INT, num_ebikes_available INT, "
    "num_bikes_disabled INT, num_docks_available INT, num_docks_disabled INT, "
    "is_installed STRING, is_renting STRING, is_returning STRING, "
    "station_status_last_reported BIGINT, " + PROVENANCE_COLUMNS + ", event_date DATE"
)
BRONZE_INFO = struct(
    "station_id STRING, station_name STRING, lat DECIMAL(11,7), lon DECIMAL(11,7), "
    "region_id STRING, capacity INT, has_kiosk STRING, "
    "station_information_last_updated BIGINT, missing_station_information STRING, "
    + PROVENANCE_COLUMNS
)
# One folder per topic, so that every stream writes a folder of its own.
DEAD_LETTERS = struct(
    "dlq_id STRING, event_id STRING, source_topic STRING, partition_num INT, "
    "kafka_offset BIGINT, error_message STRING, error_ts TIMESTAMP, raw_payload STRING"
)

SILVER_FACT = struct(
    "station_id STRING, reported_at TIMESTAMP_NTZ, num_bikes_available BIGINT, "
    "num_ebikes_available BIGINT, num_bikes_disabled BIGINT, num_docks_available BIGINT, "
    "num_docks_disabled BIGINT, is_installed BIGINT, is_renting BIGINT, is_returning BIGINT, "
    "missing_station_information BOOLEAN, date DATE"
)
SILVER_DIMENSION = struct(
    "station_id STRING, station_name STRING, lat DOUBLE, lon DOUBLE, region_id BIGINT, "
    "capacity BIGINT, has_kiosk BOOLEAN, info_updated_at TIMESTAMP_NTZ"
)

WATERMARK = struct(
    "source_name STRING, last_station_id STRING, last_reported_ts TIMESTAMP_NTZ, "
    "rows_loaded BIGINT, last_load_ts TIMESTAMP"
)
RUN_LOG = struct(
    "run_id STRING, run_ts TIMESTAMP, pipeline_name STRING, layer STRING, status STRING, "
    "rows_processed BIGINT, error_message STRING, duration_sec DECIMAL(10,2)"
)

LEDGER = struct(
    "run_id STRING, table_name STRING, state STRING, source_file STRING, event_date DATE, "
    "rows_loaded BIGINT, noted_at TIMESTAMP"
)
BUILT_RUNS = struct("run_id STRING, built_at TIMESTAMP")

MESSAGES = struct(
    "value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)
BENCH_RECORD = struct(
    "timestamp STRING, mode STRING, input STRINGS, rows_status BIGINT, rows_info BIGINT, "
    "rows_total BIGINT, elapsed_seconds DOUBLE, rows_per_second BIGINT, "
    "produced_status BIGINT, produced_info BIGINT, producer_seconds DOUBLE, "
    "master STRING, cores INT, input_rows BIGINT"
)
