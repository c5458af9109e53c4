import pytest
from conftest import rows
from pyspark.sql import functions as F

from stationlake.operators import quality
from stationlake.operators.ingest import INFO, STATUS, bronze_rows
from stationlake.plans import gold_sql, silver_sql


@pytest.mark.parametrize(
    "change, broken",
    [
        ({}, []),
        ({"station_name": None}, ["station_name_not_null"]),
        ({"lat": None}, ["lat_not_null"]),
        ({"lon": None}, ["lon_not_null"]),
        ({"capacity": None}, ["capacity_not_null"]),
        ({"station_information_last_updated": "0"}, ["station_information_last_updated_not_null"]),
        ({"capacity": "-1"}, ["capacity_negative"]),
        ({"capacity": "0"}, []),
        ({"lat": "90"}, []),
        ({"lat": "90.5"}, ["lat_range"]),
        ({"lon": "-180.5"}, ["lon_range"]),
        ({"region_id": None, "has_kiosk": None}, []),
        ({"has_kiosk": "maybe"}, ["has_kiosk_flag"]),
    ],
)
def test_info_rules(raw, change, broken):
    checked = silver_sql.check_info(bronze_rows(raw(change), INFO))
    assert checked.first().violations == broken
    assert quality.kept(checked).count() == (not broken)
    assert quality.rejected(checked).count() == bool(broken)


@pytest.mark.parametrize(
    "change, broken",
    [
        ({}, []),
        ({"num_ebikes_available": None, "num_docks_disabled": None}, []),
        ({"num_bikes_available": None}, ["num_bikes_available_not_null"]),
        ({"num_bikes_disabled": None}, ["num_bikes_disabled_not_null"]),
        ({"num_docks_available": None}, ["num_docks_available_not_null"]),
        ({"is_installed": None}, ["is_installed_not_null"]),
        ({"is_renting": "2"}, ["is_renting_not_null"]),
        ({"is_returning": "TRUE"}, []),
        ({"station_status_last_reported": "1000000000"}, ["last_reported_ts_not_null"]),
        ({"num_bikes_available": "-1"}, ["num_bikes_available_negative"]),
        ({"num_docks_available": "-1"}, ["num_docks_available_negative"]),
        ({"num_bikes_disabled": "-1"}, ["num_bikes_disabled_negative"]),
        ({"num_docks_disabled": "-1"}, ["num_docks_disabled_negative"]),
        ({"station_id": "stranger"}, ["station_unknown"]),
    ],
)
def test_status_rules(raw, change, broken):
    info = quality.kept(silver_sql.check_info(bronze_rows(raw({}), INFO)))
    checked = silver_sql.check_status(bronze_rows(raw(change), STATUS), info)
    assert checked.first().violations == broken


def test_station_with_rejected_info_is_unknown(raw):
    feed = raw({"lat": "91"}, {"station_id": "2"})
    info = quality.kept(silver_sql.check_info(bronze_rows(feed, INFO)))
    checked = silver_sql.check_status(bronze_rows(feed, STATUS), info)
    assert rows(silver_sql.orphans(checked), "station_id") == [("1",)]
    assert rows(quality.kept(checked), "station_id", "region_id") == [("2", "7")]
    assert quality.kept(checked).count() + quality.rejected(checked).count() == checked.count()


@pytest.fixture
def silver(raw):
    def build(*changes):
        feed = raw(*changes)
        info = quality.kept(silver_sql.check_info(bronze_rows(feed, INFO)))
        status = quality.kept(silver_sql.check_status(bronze_rows(feed, STATUS), info))
        return status, info

    return build


HOUR = 3600


def test_availability_is_the_latest_row(silver):
    status, info = silver(
        {"num_bikes_available": "1", "station_status_last_reported": str(1_700_000_000 + HOUR)},
        {"num_bikes_available": "7"},
    )
    row = quality.kept(gold_sql.station_availability(status, info)).first()
    assert (row.num_bikes_available, row.availability_pct, row.station_name) == (1, 5.0, "Main St")


def test_summary_and_daily(silver):
    status, info = silver(
        {"num_bikes_available": "1", "is_renting": "0"},
        {"num_bikes_available": "4", "station_status_last_reported": str(1_700_000_000 + HOUR)},
        {"num_bikes_available": "8", "station_status_last_reported": str(1_700_000_000 + 24 * HOUR)},
    )
    row = gold_sql.station_summary(status, info).first()
    assert (row.snapshot_count, row.avg_bikes_available, row.max_bikes_available) == (3, 4.33, 8)
    assert (row.avg_utilization, row.avg_availability_pct) == (0.2167, 21.67)
    assert (row.pct_time_renting, row.pct_time_installed) == (66.67, 100.0)
    daily = gold_sql.station_daily(status, info)
    assert rows(daily.select(F.col("station_date").cast("string"), "avg_bikes", "avg_utilization",
                             "measurements_count"), "station_date", "avg_bikes",
                "avg_utilization", "measurements_count") == [
        ("2023-11-14", 2.5, 0.125, 2),
        ("2023-11-15", 8.0, 0.4, 1),
    ]


def test_utilization_equals_the_mean_of_row_ratios(silver):
    status, info = silver(
        *(
            {
                "num_bikes_available": str((i * 7) % 20),
                "station_status_last_reported": str(1_700_000_000 + i),
            }
            for i in range(50)
        )
    )
    direct = status.join(info, "station_id").agg(F.avg(F.col("num_bikes_available") / F.col("capacity")))
    got = gold_sql.station_summary(status, info).first().avg_utilization
    assert got == pytest.approx(direct.first()[0], abs=5e-5)


def test_capacity_zero_gives_no_ratio(silver):
    status, info = silver({"capacity": "0"})
    row = gold_sql.station_availability(status, info).first()
    assert row.availability_pct is None and row.violations == []


def test_breaching_rows_are_withheld_and_reported(silver):
    status, info = silver({"num_bikes_available": "30"}, {"station_id": "2"})
    checked = gold_sql.station_availability(status, info)
    assert rows(quality.kept(checked), "station_id") == [("2",)]
    report = quality.violation_rows(checked, "t", ["station_id"])
    assert rows(report, "gold_table", "row_key", "rule") == [("t", "1", "availability_pct_range")]
    assert checked.filter("station_id = '1'").first().availability_pct == 150.0
    daily = quality.violation_rows(gold_sql.station_daily(status, info), "d", ["station_id", "station_date"])
    assert rows(daily, "row_key") == [("1|2023-11-14",)]


def test_regions_leave_out_stations_without_one(silver):
    status, info = silver(
        {"num_bikes_available": "10"},
        {"station_id": "2", "num_bikes_available": "5", "is_renting": "0"},
        {"station_id": "3", "region_id": None},
    )
    row = gold_sql.region_summary(gold_sql.station_availability(status, info)).collect()
    assert [
        (r.region_id, r.station_count, r.total_capacity, r.total_bikes_available,
         r.avg_availability_pct, r.pct_stations_renting)
        for r in row
    ] == [("7", 2, 40, 15, 37.5, 50.0)]


def test_quality_metrics(raw):
    feed = raw(
        {},
        {},
        {"station_id": None},
        {"station_id": "2", "num_bikes_available": "x"},
        {"station_id": "3", "num_docks_available": "-1"},
        {"station_id": "4", "missing_station_information": "true"},
    )
    info = quality.kept(silver_sql.check_info(bronze_rows(feed, INFO)))
    checked = silver_sql.check_status(bronze_rows(feed, STATUS), info)
    got = {
        r.metric_name: (r.metric_value, r.status)
        for r in quality.quality_metrics(feed, [(STATUS, checked)]).collect()
    }
    assert got == {
        "row_count": (6.0, "PASS"),
        "null_key_count": (1.0, "FAIL"),
        "cast_failure_count": (1.0, "FAIL"),
        "duplicate_rate": (25.0, "FAIL"),
        "orphan_count": (1.0, "FAIL"),
        "bound_violation_count": (1.0, "FAIL"),
        "rejected_rate": (66.6667, "FAIL"),
    }
    lenient = quality.quality_metrics(
        feed, [(STATUS, checked)], thresholds={"orphan_count": 1.0}
    )
    assert [r.status for r in lenient.collect()] == ["PASS"]


def test_quality_of_nothing(raw):
    feed = raw({}).limit(0)
    info = silver_sql.check_info(bronze_rows(feed, INFO))
    checked = silver_sql.check_status(bronze_rows(feed, STATUS), quality.kept(info))
    got = {r.metric_name: (r.metric_value, r.status) for r in quality.quality_metrics(feed, [(STATUS, checked)]).collect()}
    assert got["row_count"] == (0.0, "FAIL")
    assert got["duplicate_rate"] == (0.0, "PASS") and got["rejected_rate"] == (0.0, "PASS")
