"""The catalog's queries as plain SQL for DuckDB, over the same tables.

Written on its own, from the definitions: ranks and correlated picks instead of
the library's aggregates, so that agreement means something.
"""

from __future__ import annotations

_RAW = [
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
_RAW_LIST = ", ".join(_RAW)



def _half_up(numerator: str, denominator: str, digits: int) -> str:
    """A ratio of whole non-negative numbers rounded half up, in integers only."""
    unit = 10**digits
    return (
        f"CAST((2 * {unit} * CAST({numerator} AS HUGEINT) + ({denominator})) "
        f"// nullif(2 * ({denominator}), 0) AS DOUBLE) / {unit}"
    )


def _mean(column: str, scale: int = 1) -> str:
    return _half_up(f"{scale} * sum({column})", f"count({column})", 2)


_SEEN = "count(s.num_bikes_available) * max(i.capacity)"

_CTES = {
    "ev": """
  SELECT event_id, user_id, event_type, value + r.replay AS value, r.replay,
         CAST(floor(epoch(ts)) AS BIGINT) AS ep,
         'feed_' || strftime(ts, '%Y%m%d') || '.csv' AS source_file
  FROM events, (VALUES (0), (1)) AS r(replay)
  WHERE r.replay = 0 OR event_id % 10 = 0""",
    "feed": """
  SELECT event_id * 2 + replay AS arrival_pos, source_file,
    CASE WHEN event_id % 997 = 0 THEN NULL
         WHEN event_id % 13 = 0 THEN ' ' || CAST(user_id AS VARCHAR) || '  '
         ELSE CAST(user_id AS VARCHAR) END AS station_id,
    CASE WHEN event_id % 101 = 0 THEN 'n/a'
         ELSE CAST(CAST(floor(value) AS BIGINT) % 40 AS VARCHAR) END AS num_bikes_available,
    CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 5 AS VARCHAR) END AS num_ebikes_available,
    CAST(event_id % 3 AS VARCHAR) AS num_bikes_disabled,
    CAST(event_id % 43 - CASE WHEN event_id % 503 = 0 THEN 60 ELSE 0 END AS VARCHAR)
      AS num_docks_available,
    CAST(event_id % 2 AS VARCHAR) AS num_docks_disabled,
    '1' AS is_installed,
    CASE WHEN event_type = 'error' THEN '0' ELSE '1' END AS is_renting,
    CASE WHEN event_id % 11 = 0 THEN '0' ELSE '1' END AS is_returning,
    CASE WHEN event_id % 211 = 0 THEN '0' WHEN event_id % 499 = 0 THEN NULL
         ELSE CAST(ep AS VARCHAR) END AS station_status_last_reported,
    CASE WHEN event_id % 17 <> 0 THEN s_name || ' ' END AS station_name,
    '40.' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS lat,
    '-74.' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS lon,
    CAST(n_regionkey AS VARCHAR) AS region_id,
    CAST(20 + s_suppkey % 40 AS VARCHAR) AS capacity,
    CASE WHEN s_suppkey % 2 = 0 THEN 'True' WHEN s_suppkey IS NOT NULL THEN 'false' END
      AS has_kiosk,
    CAST(ep AS VARCHAR) AS station_information_last_updated,
    CASE WHEN s_suppkey IS NULL THEN 'true' WHEN event_id % 19 = 0 THEN 'False'
         ELSE 'false' END AS missing_station_information
  FROM ev LEFT JOIN supplier ON s_suppkey = user_id
          LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "parsed": """
  SELECT arrival_pos, trim(station_id) AS station_id,
    CASE WHEN TRY_CAST(station_status_last_reported AS BIGINT) > 1000000000 THEN
      make_timestamp(TRY_CAST(station_status_last_reported AS BIGINT) * 1000000) END AS reported_at,
    TRY_CAST(num_bikes_available AS BIGINT) AS num_bikes_available,
    TRY_CAST(num_ebikes_available AS BIGINT) AS num_ebikes_available,
    TRY_CAST(num_bikes_disabled AS BIGINT) AS num_bikes_disabled,
    TRY_CAST(num_docks_available AS BIGINT) AS num_docks_available,
    TRY_CAST(num_docks_disabled AS BIGINT) AS num_docks_disabled,
    TRY_CAST(is_installed AS BIGINT) AS is_installed,
    TRY_CAST(is_renting AS BIGINT) AS is_renting,
    TRY_CAST(is_returning AS BIGINT) AS is_returning,
    coalesce(lower(missing_station_information) = 'true', FALSE) AS missing_station_information,
    trim(station_name) AS station_name,
    TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon,
    TRY_CAST(region_id AS BIGINT) AS region_id, TRY_CAST(capacity AS BIGINT) AS capacity,
    coalesce(lower(has_kiosk) = 'true', FALSE) AS has_kiosk,
    CASE WHEN TRY_CAST(station_information_last_updated AS BIGINT) > 1000000000 THEN
      make_timestamp(TRY_CAST(station_information_last_updated AS BIGINT) * 1000000) END
      AS info_updated_at
  FROM feed""",
    "fact": """
  SELECT station_id, reported_at, num_bikes_available, num_ebikes_available, num_bikes_disabled,
    num_docks_available, num_docks_disabled, is_installed, is_renting, is_returning,
    missing_station_information
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id, reported_at ORDER BY arrival_pos) AS n
        FROM parsed WHERE station_id IS NOT NULL AND reported_at IS NOT NULL)
  WHERE n = 1""",
    "dim": """
  SELECT station_id,
    arg_min(station_name, arrival_pos) FILTER (station_name IS NOT NULL) AS station_name,
    arg_min(lat, arrival_pos) FILTER (lat IS NOT NULL) AS lat,
    arg_min(lon, arrival_pos) FILTER (lon IS NOT NULL) AS lon,
    arg_min(region_id, arrival_pos) FILTER (region_id IS NOT NULL) AS region_id,
    arg_min(capacity, arrival_pos) FILTER (capacity IS NOT NULL) AS capacity,
    arg_min(has_kiosk, arrival_pos) FILTER (has_kiosk IS NOT NULL) AS has_kiosk,
    arg_min(info_updated_at, arrival_pos) FILTER (info_updated_at IS NOT NULL) AS info_updated_at
  FROM parsed WHERE NOT missing_station_information GROUP BY station_id""",
    "status_typed": """
  SELECT arrival_pos, source_file, station_id,
    TRY_CAST(num_bikes_available AS INTEGER) AS num_bikes_available,
    TRY_CAST(num_ebikes_available AS INTEGER) AS num_ebikes_available,
    TRY_CAST(num_bikes_disabled AS INTEGER) AS num_bikes_disabled,
    TRY_CAST(num_docks_available AS INTEGER) AS num_docks_available,
    TRY_CAST(num_docks_disabled AS INTEGER) AS num_docks_disabled,
    is_installed, is_renting, is_returning,
    TRY_CAST(station_status_last_reported AS BIGINT) AS station_status_last_reported,
    (num_bikes_available IS NULL OR TRY_CAST(num_bikes_available AS INTEGER) IS NOT NULL)
      AND (num_ebikes_available IS NULL OR TRY_CAST(num_ebikes_available AS INTEGER) IS NOT NULL)
      AND (num_bikes_disabled IS NULL OR TRY_CAST(num_bikes_disabled AS INTEGER) IS NOT NULL)
      AND (num_docks_available IS NULL OR TRY_CAST(num_docks_available AS INTEGER) IS NOT NULL)
      AND (num_docks_disabled IS NULL OR TRY_CAST(num_docks_disabled AS INTEGER) IS NOT NULL)
      AND TRY_CAST(station_status_last_reported AS BIGINT) IS NOT NULL AS good
  FROM feed WHERE station_id IS NOT NULL AND station_status_last_reported IS NOT NULL""",
    "bronze_status": """
  SELECT station_id, num_bikes_available, num_ebikes_available, num_bikes_disabled,
    num_docks_available, num_docks_disabled, is_installed, is_renting, is_returning,
    station_status_last_reported, source_file,
    CAST(make_timestamp(station_status_last_reported * 1000000) AS DATE) AS event_date
  FROM (SELECT *, row_number() OVER (
          PARTITION BY station_id, station_status_last_reported ORDER BY arrival_pos) AS n
        FROM status_typed WHERE good)
  WHERE n = 1""",
    "bronze_info": """
  SELECT station_id, station_name, CAST(lat AS DECIMAL(11,7)) AS lat,
    CAST(lon AS DECIMAL(11,7)) AS lon, region_id, CAST(capacity AS INTEGER) AS capacity, has_kiosk,
    CAST(station_information_last_updated AS BIGINT) AS station_information_last_updated,
    missing_station_information
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY arrival_pos) AS n
        FROM feed WHERE station_id IS NOT NULL AND missing_station_information = 'false')
  WHERE n = 1""",
    "info_checked": """
  SELECT station_id, station_name, lat, lon, region_id, capacity,
    CASE lower(has_kiosk) WHEN 'true' THEN 1 WHEN '1' THEN 1 WHEN 'false' THEN 0 WHEN '0' THEN 0 END
      AS has_kiosk,
    CASE WHEN station_information_last_updated > 1000000000 THEN
      make_timestamp(station_information_last_updated * 1000000) END
      AS station_information_last_updated,
    CASE lower(missing_station_information) WHEN 'true' THEN 1 WHEN '1' THEN 1
      WHEN 'false' THEN 0 WHEN '0' THEN 0 END AS missing_station_information,
    concat_ws(',',
      CASE WHEN station_name IS NULL THEN 'station_name_not_null' END,
      CASE WHEN lat IS NULL THEN 'lat_not_null' END,
      CASE WHEN lon IS NULL THEN 'lon_not_null' END,
      CASE WHEN capacity IS NULL THEN 'capacity_not_null' END,
      CASE WHEN station_information_last_updated IS NULL
             OR station_information_last_updated <= 1000000000
           THEN 'station_information_last_updated_not_null' END,
      CASE WHEN capacity < 0 THEN 'capacity_negative' END,
      CASE WHEN lat NOT BETWEEN -90 AND 90 THEN 'lat_range' END,
      CASE WHEN lon NOT BETWEEN -180 AND 180 THEN 'lon_range' END,
      CASE WHEN lower(has_kiosk) NOT IN ('true', 'false', '0', '1') THEN 'has_kiosk_flag' END,
      CASE WHEN lower(missing_station_information) NOT IN ('true', 'false', '0', '1')
           THEN 'missing_station_information_flag' END) AS violations
  FROM bronze_info""",
    "info": "SELECT * FROM info_checked WHERE violations = ''",
    "status_checked": """
  SELECT b.station_id, b.num_bikes_available, b.num_ebikes_available, b.num_bikes_disabled,
    b.num_docks_available, b.num_docks_disabled,
    CAST(b.is_installed AS INTEGER) AS is_installed, CAST(b.is_renting AS INTEGER) AS is_renting,
    CAST(b.is_returning AS INTEGER) AS is_returning, b.station_status_last_reported,
    CASE WHEN b.station_status_last_reported > 1000000000 THEN
      make_timestamp(b.station_status_last_reported * 1000000) END AS last_reported_ts,
    i.region_id,
    concat_ws(',',
      CASE WHEN b.num_bikes_available IS NULL THEN 'num_bikes_available_not_null' END,
      CASE WHEN b.num_bikes_disabled IS NULL THEN 'num_bikes_disabled_not_null' END,
      CASE WHEN b.num_docks_available IS NULL THEN 'num_docks_available_not_null' END,
      CASE WHEN b.station_status_last_reported <= 1000000000 THEN 'last_reported_ts_not_null' END,
      CASE WHEN b.num_bikes_available < 0 THEN 'num_bikes_available_negative' END,
      CASE WHEN b.num_docks_available < 0 THEN 'num_docks_available_negative' END,
      CASE WHEN b.num_bikes_disabled < 0 THEN 'num_bikes_disabled_negative' END,
      CASE WHEN b.num_docks_disabled < 0 THEN 'num_docks_disabled_negative' END,
      CASE WHEN i.station_id IS NULL THEN 'station_unknown' END) AS violations
  FROM bronze_status b LEFT JOIN info i ON i.station_id = b.station_id""",
    "status": "SELECT * FROM status_checked WHERE violations = ''",
    "availability_all": f"""
  SELECT s.station_id, i.station_name, i.region_id, CAST(i.lat AS DOUBLE) AS lat,
    CAST(i.lon AS DOUBLE) AS lon, i.capacity, s.num_bikes_available, s.num_ebikes_available,
    s.num_docks_available, s.is_installed, s.is_renting, s.is_returning,
    {_half_up("100 * s.num_bikes_available", "i.capacity", 2)} AS availability_pct,
    s.last_reported_ts
  FROM (SELECT *, row_number() OVER (
          PARTITION BY station_id ORDER BY station_status_last_reported DESC) AS n
        FROM status) s
  LEFT JOIN info i ON i.station_id = s.station_id WHERE s.n = 1""",
    "availability": """
  SELECT * FROM availability_all
  WHERE availability_pct IS NULL OR availability_pct BETWEEN 0 AND 100""",
    "summary_all": f"""
  SELECT s.station_id, max(i.station_name) AS station_name, max(i.region_id) AS region_id,
    max(i.capacity) AS capacity, count(*) AS snapshot_count,
    {_mean("s.num_bikes_available")} AS avg_bikes_available,
    max(s.num_bikes_available) AS max_bikes_available,
    min(s.num_bikes_available) AS min_bikes_available,
    {_mean("s.num_docks_available")} AS avg_docks_available,
    {_half_up("sum(s.num_bikes_available)", _SEEN, 4)} AS avg_utilization,
    {_half_up("100 * sum(s.num_bikes_available)", _SEEN, 2)}
      AS avg_availability_pct,
    {_mean("s.is_renting", 100)} AS pct_time_renting,
    {_mean("s.is_installed", 100)} AS pct_time_installed,
    min(s.last_reported_ts) AS first_seen_ts, max(s.last_reported_ts) AS last_seen_ts
  FROM status s LEFT JOIN info i ON i.station_id = s.station_id GROUP BY s.station_id""",
    "region_all": f"""
  SELECT region_id, CAST(count(*) AS INTEGER) AS station_count,
    CAST(sum(capacity) AS BIGINT) AS total_capacity,
    CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes_available,
    {_half_up("sum(CAST(round(availability_pct * 100) AS BIGINT))",
              "100 * count(availability_pct)", 2)}
      AS avg_availability_pct,
    {_mean("is_renting", 100)} AS pct_stations_renting
  FROM availability WHERE region_id IS NOT NULL GROUP BY region_id""",
    "daily_all": f"""
  SELECT s.station_id, max(i.station_name) AS station_name,
    CAST(s.last_reported_ts AS DATE) AS station_date,
    {_mean("s.num_bikes_available")} AS avg_bikes,
    {_mean("s.num_docks_available")} AS avg_docks,
    {_half_up("sum(s.num_bikes_available)", _SEEN, 4)} AS avg_utilization,
    count(*) AS measurements_count
  FROM status s LEFT JOIN info i ON i.station_id = s.station_id
  GROUP BY s.station_id, CAST(s.last_reported_ts AS DATE)""",
}


def _q(select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in _CTES.items()) + "\n" + select


_STATUS_COLUMNS = """station_id, num_bikes_available, num_ebikes_available, num_bikes_disabled,
  num_docks_available, num_docks_disabled, is_installed, is_renting, is_returning,
  station_status_last_reported"""
_NO_TEXT = "CAST(NULL AS VARCHAR)"


# The same feed in three loads: rows land in order of their loads.
_LOADS = {
    "feed": f"""
  SELECT * REPLACE (CASE WHEN load = 1 AND TRY_CAST(trim(station_id) AS BIGINT) % 5 = 0 THEN 'true'
                         ELSE missing_station_information END AS missing_station_information)
  FROM (SELECT *, CASE WHEN day <= 5 AND (arrival_pos // 2) % 10 = 7 THEN 3 WHEN day > 20 THEN 2
                       ELSE 1 END AS load
        FROM (SELECT *, CAST(source_file[12:13] AS INTEGER) AS day FROM ({_CTES["feed"]})))""",
    "status_typed": _CTES["status_typed"].replace("SELECT arrival_pos,", "SELECT load, arrival_pos,"),
    "bronze_status": _CTES["bronze_status"].replace("ORDER BY arrival_pos", "ORDER BY load, arrival_pos"),
    "bronze_info": _CTES["bronze_info"].replace("ORDER BY arrival_pos", "ORDER BY load, arrival_pos"),
}


def _in_loads(select: str, last: int = 3) -> str:
    """A query over what the first loads make."""
    upto = {"feed": f"SELECT * FROM ({_LOADS['feed']}) WHERE load <= {last}"}
    ctes = _CTES | _LOADS | upto
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in ctes.items()) + "\n" + select


def _bronze_status(mode: str) -> str:
    return _q(f"SELECT {_STATUS_COLUMNS}, '{mode}' AS source_mode, event_date FROM bronze_status")


def _bronze_info(mode: str) -> str:
    return _q(
        f"""SELECT station_id, station_name, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon,
  region_id, capacity, has_kiosk, station_information_last_updated, missing_station_information,
  '{mode}' AS source_mode FROM bronze_info"""
    )


_COMPLAINT = "'bronze_station_status: num_bikes_available is not int: ' || num_bikes_available"
_FAILED = f"{_COMPLAINT} AS error_message"
# Status rows whose count of bikes is no number, per station.
_UNFIT = f"""SELECT {_FAILED}, station_id, count(*) AS n FROM feed
  WHERE station_id IS NOT NULL AND station_status_last_reported IS NOT NULL
    AND TRY_CAST(num_bikes_available AS INTEGER) IS NULL GROUP BY ALL"""


# The feed as lines of CSV: fields of a row, and whether the line has been broken.
_FIELDS = [f"coalesce({c}, '\\N')" for c in _RAW]
_BROKEN = f"""SELECT *, CASE
    WHEN arrival_pos % 89 = 1 THEN concat_ws(',', {', '.join(_FIELDS[:-1])})
    WHEN arrival_pos % 83 = 2 THEN concat_ws(',', {', '.join(_FIELDS)}, 'extra') END AS broken
  FROM feed"""

# What changes in the metrics of a second, equal load: nothing of it landed.
_SECOND = {
    "duplicate_rate": "100.0",
    "orphan_count": "0",
    "bound_violation_count": "0",
    "rejected_rate": "0.0",
}


def _bounds(table: str, source: str, key: str, column: str, low: float, high: float) -> str:
    return f"""SELECT '{table}' AS gold_table, {key} AS row_key, '{column}_range' AS rule
  FROM {source} WHERE {column} NOT BETWEEN {low} AND {high}"""


def _metric(dataset: str, name: str, value: str, threshold: float, source: str) -> str:
    unit = "pct" if name.endswith("rate") else "rows"
    test = ">=" if name == "row_count" else "<="
    return f"""SELECT '{name}' AS metric_name, v AS metric_value,
    {threshold}::DOUBLE AS threshold, '{unit}' AS unit, '{dataset}' AS dataset,
    CASE WHEN v {test} {threshold} THEN 'PASS' ELSE 'FAIL' END AS status
  FROM (SELECT CAST({value} AS DOUBLE) AS v FROM {source})"""


_STATUS_DQ = [
    ("row_count", "count(*)", 1.0, "feed"),
    (
        "null_key_count",
        "count(*) FILTER (station_id IS NULL OR station_status_last_reported IS NULL)",
        0.0,
        "feed",
    ),
    ("cast_failure_count", "count(*) FILTER (NOT good)", 0.0, "status_typed"),
    (
        "duplicate_rate",
        """round(100.0::DOUBLE * (count(*) FILTER (good) - (SELECT count(*) FROM bronze_status))
           / count(*) FILTER (good), 4)""",
        1.0,
        "status_typed",
    ),
    ("orphan_count", "count(*) FILTER (violations LIKE '%station_unknown')", 0.0, "status_checked"),
    (
        "bound_violation_count",
        "count(*) FILTER (violations NOT IN ('', 'station_unknown'))",
        0.0,
        "status_checked",
    ),
    (
        "rejected_rate",
        "round(100.0::DOUBLE * count(*) FILTER (violations <> '') / count(*), 4)",
        5.0,
        "status_checked",
    ),
]
_INFO_ROWS = "(SELECT * FROM feed WHERE station_id IS NOT NULL AND missing_station_information = 'false')"
_INFO_DQ = [
    ("row_count", "count(*)", 1.0, "feed"),
    ("null_key_count", "count(*) FILTER (station_id IS NULL)", 0.0, "feed"),
    (
        "cast_failure_count",
        """count(*) FILTER ((lat IS NOT NULL AND TRY_CAST(lat AS DECIMAL(11,7)) IS NULL)
           OR (capacity IS NOT NULL AND TRY_CAST(capacity AS INTEGER) IS NULL))""",
        0.0,
        _INFO_ROWS,
    ),
    (
        "duplicate_rate",
        "round(100.0::DOUBLE * (count(*) - (SELECT count(*) FROM bronze_info)) / count(*), 4)",
        1.0,
        _INFO_ROWS,
    ),
    ("bound_violation_count", "count(*) FILTER (violations <> '')", 0.0, "info_checked"),
    (
        "rejected_rate",
        "round(100.0::DOUBLE * count(*) FILTER (violations <> '') / count(*), 4)",
        5.0,
        "info_checked",
    ),
]


ORACLE: dict[str, str] = {
    "raw_feed_scan": _q(f"SELECT {_RAW_LIST} FROM feed"),
    "sample_first_m": _q(
        f"SELECT arrival_pos, {_RAW_LIST} FROM feed ORDER BY arrival_pos LIMIT 5000"
    ),
    "peek_bronze": _q(f"SELECT arrival_pos, {_RAW_LIST} FROM feed ORDER BY arrival_pos LIMIT 5"),
    "bronze_union_sources": _q(
        f"SELECT {_RAW_LIST} FROM feed UNION ALL SELECT {_RAW_LIST} FROM feed"
    ),
    "bronze_status_batch": _bronze_status("batch"),
    "bronze_info_batch": _bronze_info("batch"),
    "bronze_status_idempotent": _bronze_status("batch"),
    "bronze_info_idempotent": _bronze_info("batch"),
    "load_counts_by_file": _q(
        "SELECT source_file, count(*) AS rows_loaded FROM bronze_status GROUP BY source_file"
    ),
    "watermark_refresh": _q(
        f"""SELECT 'bronze_station_status' AS source_name, {_NO_TEXT} AS last_station_id,
  CASE WHEN max(station_status_last_reported) > 1000000000 THEN
    make_timestamp(max(station_status_last_reported) * 1000000) END AS last_reported_ts,
  count(*) AS rows_loaded FROM bronze_status
UNION ALL SELECT 'bronze_station_information', NULL, NULL, count(*) FROM bronze_info"""
    ),
    "bronze_dlq": _q(
        f"""SELECT {_NO_TEXT} AS event_id, {_NO_TEXT} AS source_topic, {_FAILED}, station_id,
  num_bikes_available, missing_station_information
FROM feed WHERE station_id IS NOT NULL AND station_status_last_reported IS NOT NULL
  AND TRY_CAST(num_bikes_available AS INTEGER) IS NULL"""
    ),
    "bronze_dlq_malformed": _q(
        f"""SELECT {_NO_TEXT} AS source_topic, 'line is not a CSV row of the feed''s columns' AS error_message,
  broken AS raw_payload FROM ({_BROKEN}) WHERE broken IS NOT NULL"""
    ),
    "dlq_dedup": _q(
        f"""SELECT 'station-status' AS source_topic, error_message, station_id,
  2 * n AS letters, 2 * n AS events, 2 * n AS places FROM ({_UNFIT})
UNION ALL SELECT NULL, error_message, station_id, n, 0, 0 FROM ({_UNFIT})"""
    ),
    "pipeline_log_states": _q(
        """SELECT 'stationlake_load' AS pipeline_name, 'BRONZE' AS layer, 'SUCCESS' AS status,
  (SELECT count(*) FROM bronze_status) + (SELECT count(*) FROM bronze_info) AS rows_processed
UNION ALL SELECT 'stationlake_warehouse', 'SILVER', 'SUCCESS',
  (SELECT count(*) FROM info) + (SELECT count(*) FROM status)
UNION ALL SELECT 'stationlake_warehouse', 'GOLD', 'SUCCESS',
  (SELECT count(*) FROM availability) + (SELECT count(*) FROM region_all)
  + (SELECT count(*) FROM summary_all
     WHERE (avg_utilization IS NULL OR avg_utilization BETWEEN 0 AND 1)
       AND (avg_availability_pct IS NULL OR avg_availability_pct BETWEEN 0 AND 100))
  + (SELECT count(*) FROM daily_all
     WHERE avg_utilization IS NULL OR avg_utilization BETWEEN 0 AND 1)"""
    ),
    "pipeline_run_layers": _q(
        """SELECT 'BRONZE' AS layer, 'SUCCESS' AS status, count(*) AS rows_processed, CAST(2 AS BIGINT) AS runs FROM feed
UNION ALL SELECT 'SILVER', 'SUCCESS', (SELECT count(*) FROM fact) + (SELECT count(*) FROM dim), 2
UNION ALL SELECT 'GOLD', 'SUCCESS',
  (SELECT count(*) FROM (SELECT DISTINCT station_id, CAST(reported_at AS DATE) FROM fact))
  + (SELECT count(*) FROM (SELECT DISTINCT station_id, CAST(reported_at AS DATE), hour(reported_at) FROM fact))
  + (SELECT count(DISTINCT station_id) FROM fact), 2"""
    ),
    "silver_parsed": _q("SELECT * FROM parsed"),
    "silver_status_fact": _q("SELECT * FROM fact"),
    "silver_station_dimension": _q("SELECT * FROM dim"),
    "silver_station_dimension_latest": _q(
        "SELECT station_id, "
        + ", ".join(
            f"arg_min({c}, n) FILTER ({c} IS NOT NULL) AS {c}"
            for c in (
                "station_name",
                "lat",
                "lon",
                "region_id",
                "capacity",
                "has_kiosk",
                "info_updated_at",
            )
        )
        + """
FROM (SELECT *, row_number() OVER (ORDER BY info_updated_at DESC NULLS LAST, arrival_pos) AS n
      FROM parsed WHERE NOT missing_station_information)
GROUP BY station_id"""
    ),
    "silver_info_validated": _q(
        """SELECT * REPLACE (CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon)
FROM info_checked"""
    ),
    "silver_status_validated": _q("SELECT * EXCLUDE (violations) FROM status"),
    "silver_status_rejected": _q(
        """SELECT station_id, station_status_last_reported, violations
FROM status_checked WHERE violations <> ''"""
    ),
    "silver_status_fk_orphans": _q(
        """SELECT station_id, station_status_last_reported, last_reported_ts
FROM status_checked s WHERE NOT EXISTS (SELECT 1 FROM info i WHERE i.station_id = s.station_id)"""
    ),
    "silver_incremental": _q(
        f"""SELECT {_STATUS_COLUMNS} FROM bronze_status
WHERE station_status_last_reported >
  (SELECT max(station_status_last_reported) FROM bronze_status) - 7 * 86400"""
    ),
    "silver_incremental_late": _in_loads("SELECT * EXCLUDE (violations) FROM status"),
    "silver_orphans_resolved": f"""SELECT now.* FROM
  ({_in_loads("SELECT * FROM status_checked WHERE violations LIKE '%station_unknown'", 1)}) was
JOIN ({_in_loads("""SELECT station_id, station_status_last_reported, region_id,
  CASE WHEN violations LIKE '%station_unknown' THEN 'waiting' WHEN violations <> '' THEN 'rejected'
       ELSE 'accepted' END AS state FROM status_checked""", 2)}) now
USING (station_id, station_status_last_reported)""",
    "gold_station_summary_merged": _in_loads(
        """SELECT * FROM summary_all
WHERE (avg_utilization IS NULL OR avg_utilization BETWEEN 0 AND 1)
  AND (avg_availability_pct IS NULL OR avg_availability_pct BETWEEN 0 AND 100)"""
    ),
    "load_counts_second_load": " UNION ALL ".join(
        f"""SELECT {number} AS load, '{table}' AS table_name, n AS rows_loaded FROM
  (SELECT ({_in_loads(f"SELECT count(*) FROM {source}", last)}) - ({_in_loads(f"SELECT count(*) FROM {source}", before)}) AS n)
WHERE n > 0"""
        for number, before, last in ((1, 0, 1), (2, 1, 3))
        for table, source in (
            ("bronze_station_status", "bronze_status"),
            ("bronze_station_information", "bronze_info"),
        )
    ),
    "gold_daily_summary": _q(
        """SELECT f.*, d.* EXCLUDE (station_id) FROM (
  SELECT station_id, CAST(reported_at AS DATE) AS date,
    round_even(avg(num_bikes_available), 2) AS avg_bikes_available,
    min(num_bikes_available) AS min_bikes_available,
    max(num_bikes_available) AS max_bikes_available,
    round_even(avg(num_ebikes_available), 2) AS avg_ebikes_available,
    round_even(avg(num_docks_available), 2) AS avg_docks_available,
    min(num_docks_available) AS min_docks_available,
    max(num_docks_available) AS max_docks_available,
    count(reported_at) AS num_snapshots
  FROM fact GROUP BY station_id, CAST(reported_at AS DATE)) f
LEFT JOIN dim d ON d.station_id = f.station_id"""
    ),
    "gold_hourly_patterns": _q(
        """SELECT station_id, CAST(reported_at AS DATE) AS date,
  CAST(hour(reported_at) AS INTEGER) AS hour, avg(num_bikes_available) AS avg_bikes,
  avg(num_docks_available) AS avg_docks, avg(num_ebikes_available) AS avg_ebikes,
  count(reported_at) AS num_readings
FROM fact GROUP BY ALL"""
    ),
    "gold_station_summary": _q(
        """SELECT f.*, d.* EXCLUDE (station_id) FROM (
  SELECT station_id, min(reported_at) AS first_seen, max(reported_at) AS last_seen,
    count(reported_at) AS total_snapshots,
    round_even(avg(num_bikes_available), 2) AS avg_bikes_available,
    max(num_bikes_available) AS peak_bikes_available,
    round_even(avg(num_docks_available), 2) AS avg_docks_available,
    min(num_docks_available) AS min_docks_available,
    avg(CAST(missing_station_information AS INTEGER)) AS pct_missing_info
  FROM fact GROUP BY station_id) f
LEFT JOIN dim d ON d.station_id = f.station_id"""
    ),
    "gold_station_availability": _q("SELECT * FROM availability"),
    "gold_station_summary_sql": _q(
        """SELECT * FROM summary_all
WHERE (avg_utilization IS NULL OR avg_utilization BETWEEN 0 AND 1)
  AND (avg_availability_pct IS NULL OR avg_availability_pct BETWEEN 0 AND 100)"""
    ),
    "gold_station_daily": _q(
        """SELECT * FROM daily_all WHERE avg_utilization IS NULL OR avg_utilization BETWEEN 0 AND 1"""
    ),
    "gold_region_summary": _q("SELECT * FROM region_all"),
    "gold_data_quality": _q(
        "\nUNION ALL ".join(
            [_metric("bronze_station_status", *m) for m in _STATUS_DQ]
            + [_metric("bronze_station_information", *m) for m in _INFO_DQ]
        )
    ),
    "gold_data_quality_two_loads": _q(
        "\nUNION ALL ".join(
            _metric(dataset, name, _SECOND[name], threshold, "(SELECT 1)")
            if name in _SECOND
            else _metric(dataset, name, value, threshold, source)
            for dataset, metrics in (
                ("bronze_station_status", _STATUS_DQ),
                ("bronze_station_information", _INFO_DQ),
            )
            for name, value, threshold, source in metrics
        )
    ),
    "gold_bounds_violations": _q(
        "\nUNION ALL ".join(
            [
                _bounds(
                    "gold_station_availability",
                    "availability_all",
                    "station_id",
                    "availability_pct",
                    0,
                    100,
                ),
                _bounds(
                    "gold_station_summary", "summary_all", "station_id", "avg_utilization", 0, 1
                ),
                _bounds(
                    "gold_station_summary",
                    "summary_all",
                    "station_id",
                    "avg_availability_pct",
                    0,
                    100,
                ),
                _bounds(
                    "gold_region_summary",
                    "region_all",
                    "region_id",
                    "avg_availability_pct",
                    0,
                    100,
                ),
                _bounds(
                    "gold_station_daily",
                    "daily_all",
                    "station_id || '|' || CAST(station_date AS VARCHAR)",
                    "avg_utilization",
                    0,
                    1,
                ),
            ]
        )
    ),
    "route_topics": _q(
        """SELECT 'station-status' AS topic, arrival_pos, station_id, missing_station_information
FROM feed
UNION ALL SELECT 'station-info', arrival_pos, station_id, missing_station_information
FROM feed WHERE missing_station_information = 'false'"""
    ),
    "produce_status_messages": _q(
        f"""SELECT 'station-status' AS topic, {_RAW_LIST} FROM feed
UNION ALL SELECT 'station-info', {_RAW_LIST} FROM feed
WHERE missing_station_information = 'false'"""
    ),
    "stream_bronze_status": _bronze_status("stream"),
    "stream_bronze_status_ms": f"""SELECT * REPLACE (
  1000 * station_status_last_reported AS station_status_last_reported)
FROM ({_bronze_status("stream")})""",
    "stream_bronze_info": _bronze_info("stream"),
    "produce_counts": _q(
        f"""SELECT {_NO_TEXT} AS topic, CAST(NULL AS BIGINT) AS sent, count(broken) AS stored FROM ({_BROKEN})
UNION ALL SELECT 'station-status', count(*), count(*) FROM ({_BROKEN}) WHERE broken IS NULL
UNION ALL SELECT 'station-info', count(*), count(*) FROM ({_BROKEN})
  WHERE broken IS NULL AND missing_station_information = 'false'"""
    ),
    "stream_bronze_dlq": _q(
        f"""SELECT event_id, 'station-status' AS topic, CAST(0 AS INTEGER) AS partition_num,
  CAST(kafka_offset AS BIGINT) AS kafka_offset, error_message, station_id, station_status_last_reported
FROM (
  SELECT *, row_number() OVER (PARTITION BY error_message IS NULL, station_id, station_status_last_reported
                               ORDER BY arrival_pos) AS n
  FROM (
    SELECT *, sha256('station-status|0|' || kafka_offset || '|' || place) AS event_id,
      CASE WHEN TRY_CAST(num_bikes_available AS INTEGER) IS NULL THEN {_COMPLAINT} END AS error_message
    FROM (
      SELECT *, arrival_pos // 2000 AS kafka_offset,
        row_number() OVER (PARTITION BY arrival_pos // 2000 ORDER BY arrival_pos) - 1 AS place FROM feed)
    WHERE station_id IS NOT NULL AND station_status_last_reported IS NOT NULL))
WHERE error_message IS NOT NULL OR n = 1"""
    ),
    "stream_bronze_append": _q(f"SELECT {_RAW_LIST} FROM feed"),
    "stream_replay_idempotent": _bronze_status("stream"),
}
