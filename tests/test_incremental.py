import os

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from stationlake.operators import ledger, quality
from stationlake.operators.ingest import INFO, STATUS, bronze_rows, land
from stationlake.plans import gold_sql, incremental, silver_sql
from stationlake.plans.incremental import update_warehouse
from stationlake.plans.pipeline import Lake, load_batch, loaded_by_file
from stationlake.sources import layers

DAY = 86_400
FIRST = 1_700_000_000
KEYS = incremental.KEYS


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def status(station, day, **values):
    return {"station_id": station, "station_status_last_reported": str(FIRST + day * DAY), **values}


NO_INFO = {"missing_station_information": "true"}


def load(spark, lake, write_csv, tmp_path, number, *feed):
    folder = write_csv(tmp_path / f"in-{number}", f"load-{number}.csv", *feed)
    return load_batch(spark, folder, lake)


def full_build(spark, lake):
    """Accepted status and summary from all of bronze at once."""
    info = quality.kept(silver_sql.check_info(layers.read_layer(spark, lake.info, INFO.schema)))
    checked = silver_sql.check_status(layers.read_layer(spark, lake.status, STATUS.schema), info)
    kept = quality.kept(checked)
    return kept, quality.kept(gold_sql.station_summary(kept, info))


def same(spark, lake):
    kept, summary = full_build(spark, lake)
    columns = [c for c in kept.columns if c not in ("bronze_ingested_at", "silver_loaded_at")]
    assert rows(incremental.read_status(spark, lake), *columns) == rows(kept, *columns)
    merged = quality.kept(
        incremental.summary(incremental.read_lifetime(spark, lake), incremental.read_info(spark, lake))
    )
    assert rows(merged, *summary.columns) == rows(summary, *summary.columns)


def test_loads_one_by_one_equal_a_full_build(spark, lake, write_csv, tmp_path):
    load(
        spark, lake, write_csv, tmp_path, 1,
        status("1", 0), status("1", 40, num_bikes_available="9"), status("2", 0, **NO_INFO),
        status("2", 40, num_bikes_available="-1", **NO_INFO), status("9", 0, **NO_INFO),
    )
    assert update_warehouse(spark, lake) == {"dates": 2, "healed_dates": 0, "accepted": 2}
    assert incremental.read_status(spark, lake, incremental.WAITING).count() == 3
    same(spark, lake)
    # Nothing new: nothing is built.
    assert update_warehouse(spark, lake) == {"dates": 0, "healed_dates": 0, "accepted": 0}
    # A late report of an old day, and information that rows of two days wait for.
    load(spark, lake, write_csv, tmp_path, 2, status("1", 0, station_status_last_reported=str(FIRST + 7)), status("2", 41))
    assert update_warehouse(spark, lake) == {"dates": 2, "healed_dates": 1, "accepted": 4}
    same(spark, lake)
    assert rows(incremental.read_status(spark, lake, incremental.WAITING), "station_id") == [("9",)]
    rejected = incremental.read_status(spark, lake, incremental.REJECTED)
    assert rejected.select("violations").first()[0] == ["num_bikes_available_negative"]
    # The last waiting row goes, and with it its folder.
    load(spark, lake, write_csv, tmp_path, 3, status("9", 60))
    update_warehouse(spark, lake)
    same(spark, lake)
    day = f"{incremental.status_path(lake)}/event_date=2023-11-14"
    assert sorted(n for n in os.listdir(day) if "=" in n) == ["state=accepted"]


def test_a_crashed_build_is_run_again(spark, lake, write_csv, tmp_path, monkeypatch):
    load(spark, lake, write_csv, tmp_path, 1, status("1", 0), status("2", 0, **NO_INFO), status("2", 3, **NO_INFO))
    update_warehouse(spark, lake)
    load(spark, lake, write_csv, tmp_path, 2, status("2", 9))
    with monkeypatch.context() as patch:
        # The healed rows are in, those that wait have not gone yet.
        patch.setattr(incremental, "_drop_waiting", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            update_warehouse(spark, lake)
    update_warehouse(spark, lake)
    same(spark, lake)
    assert incremental.read_status(spark, lake).groupBy(*KEYS).count().filter("count > 1").count() == 0
    assert incremental.read_status(spark, lake, incremental.WAITING).count() == 0


def test_a_load_that_never_ended_is_built(spark, lake, raw):
    note = ledger.LoadNote(spark, lake.ledger, "crashed")
    note.landed = lambda *_: None  # it ends before it says so
    land(raw(status("1", 0)), STATUS, lake.status, note=note)
    assert update_warehouse(spark, lake)["dates"] == 1
    assert incremental.read_status(spark, lake, incremental.WAITING).count() == 1
    assert update_warehouse(spark, lake)["dates"] == 1  # still open
    ledger.LoadNote(spark, lake.ledger, "crashed")._note(STATUS, [("DONE", None, None, 1)])
    update_warehouse(spark, lake)
    assert update_warehouse(spark, lake)["dates"] == 0


def test_odd_dates(spark, lake, write_csv, tmp_path):
    times = ["0", "86400", "99999999999", str(FIRST)]
    load(spark, lake, write_csv, tmp_path, 1, *({"station_status_last_reported": t} for t in times))
    update_warehouse(spark, lake)
    same(spark, lake)
    load(spark, lake, write_csv, tmp_path, 2, {"station_status_last_reported": "99999999998"})
    update_warehouse(spark, lake)
    same(spark, lake)
    assert incremental.read_status(spark, lake).filter("event_date IS NULL").count() == 2


def test_only_touched_dates_are_read(spark, lake, write_csv, tmp_path):
    load(spark, lake, write_csv, tmp_path, 1, *(status("1", d) for d in range(5)))
    update_warehouse(spark, lake)
    info = incremental.read_info(spark, lake)
    touched = spark.createDataFrame([(FIRST + DAY,)], "t long").select(F.to_date(F.timestamp_seconds("t"))).first()[0]
    text = plan(incremental.check_dates(spark, lake, info, [touched], "s"))
    assert "PartitionFilters: [isnotnull(event_date" in text and "= 2023-11-15)" in text
    text = plan(incremental.read_status(spark, lake).filter(F.col("event_date") == touched))
    filters = text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "(event_date" in filters and "= accepted)" in filters


def test_partials_merge_in_any_order(spark, raw):
    feed = [
        status(str(i % 3), i % 40, num_bikes_available=str(i * 7 % 19), is_renting=str(i % 2))
        for i in range(90)
    ]
    bronze = bronze_rows(raw(*feed), STATUS)
    info = quality.kept(silver_sql.check_info(bronze_rows(raw(*feed), INFO)))
    kept = quality.kept(silver_sql.check_status(bronze, info))
    parts = [kept.filter(F.pmod(F.hash("station_status_last_reported"), F.lit(3)) == i) for i in range(3)]
    one = incremental.partials(parts[0], ["station_id"])
    for part in parts[1:]:
        more = incremental.partials(part, ["station_id"])
        one = incremental.merged(one.unionByName(more), ["station_id"])
    got, want = incremental.summary(one, info), gold_sql.station_summary(kept, info)
    assert rows(got, *want.columns) == rows(want, *want.columns)


def test_counts_come_from_the_files_of_the_load(spark, lake, write_csv, tmp_path):
    load(spark, lake, write_csv, tmp_path, 1, status("1", 0), status("2", 1))
    load(spark, lake, write_csv, tmp_path, 2, status("1", 0), status("3", 0), status("3", 5))
    counts = loaded_by_file(spark, lake)
    assert rows(counts, "table_name", "source_file", "rows_loaded") == [
        (INFO.name, "load-2.csv", 1), (STATUS.name, "load-2.csv", 2),
    ]
    assert counts.inputFiles() and all("/control/load_ledger/" in f for f in counts.inputFiles())
    every = ledger.counts_by_file(ledger.read(spark, lake.ledger))
    assert every.agg(F.sum("rows_loaded")).first()[0] == 4 + 3
