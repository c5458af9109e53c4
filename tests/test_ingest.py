import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.operators import insert
from stationlake.operators.ingest import (
    INFO,
    STATUS,
    bronze_rows,
    dead_letters,
    fold_dead_letters,
    land,
    land_dead_letters,
    land_latest,
)
from stationlake.sources import layers

KEY = ["station_id", "station_status_last_reported"]
BAD = {"num_bikes_available": "n/a", "station_status_last_reported": "1700000001"}


def read(spark, path, landing=STATUS):
    return layers.read_layer(spark, path, landing.schema)


def test_bad_values_fail_blank_or_leave(raw):
    feed = raw({}, BAD)
    with pytest.raises(Exception, match="num_bikes_available is not int: n/a"):
        bronze_rows(feed, STATUS, on_bad="fail").collect()
    blanked = bronze_rows(feed, STATUS, on_bad="null")
    assert rows(blanked, "num_bikes_available") == [(5,), (None,)]
    assert rows(bronze_rows(feed, STATUS), "num_bikes_available") == [(5,)]


def test_blanked_key_drops_the_row(raw):
    feed = raw({"station_status_last_reported": "soon"}, {})
    assert bronze_rows(feed, STATUS, on_bad="null").count() == 1


def test_rows_without_a_key_are_skipped(raw):
    feed = raw({"station_id": None}, {"station_status_last_reported": None}, {})
    assert bronze_rows(feed, STATUS).count() == 1
    assert dead_letters(feed, [STATUS]).count() == 0


def test_empty_text_is_absent_in_messages_only(raw):
    feed = raw({"num_bikes_available": ""}, {"station_status_last_reported": ""})
    assert rows(bronze_rows(feed, STATUS, "stream"), "num_bikes_available") == [(None,)]
    assert bronze_rows(feed, STATUS, "batch").count() == 0
    assert dead_letters(feed, [STATUS], "batch").count() == 2


def test_info_needs_the_exact_flag_and_keeps_the_first(raw):
    feed = raw(
        {"missing_station_information": "False", "station_name": "no"},
        {"missing_station_information": None, "station_name": "no"},
        {"station_name": "first", "lat": "40.12345678"},
        {"station_name": "second"},
    )
    got = bronze_rows(feed, INFO).select("station_name", F.col("lat").cast("string"))
    assert rows(got, *got.columns) == [("first", "40.1234568")]
    assert rows(bronze_rows(feed, INFO, keep="last"), "station_name") == [("second",)]


def test_provenance(raw):
    row = bronze_rows(raw({}), STATUS).first()
    assert (row.source_file, row.source_mode, row.event_id) == ("a.csv", "batch", None)
    assert str(row.event_date) == "2023-11-14" and row.ingested_at is not None


def test_loading_twice_adds_nothing(spark, raw, tmp_path):
    target = str(tmp_path / "status")
    feed = raw({}, {"num_bikes_available": "6"}, {"station_id": "2"})
    assert land(feed, STATUS, target) == 2
    assert land(feed, STATUS, target) == 0
    more = raw({"station_id": "2", "num_bikes_available": "9"}, {"station_id": "3"})
    assert land(more, STATUS, target) == 1
    assert rows(read(spark, target), "station_id", "num_bikes_available") == [
        ("1", 5),
        ("2", 5),
        ("3", 5),
    ]


def test_late_and_odd_dates_are_still_compared(spark, raw, tmp_path):
    target = str(tmp_path / "status")
    times = ["0", "86400", "1700000000", "99999999999", "-5"]
    feed = raw(*({"station_status_last_reported": t} for t in times))
    assert land(feed, STATUS, target) == 5
    assert land(raw({"station_status_last_reported": "99999999999"}), STATUS, target) == 0
    assert land(raw({"station_status_last_reported": "86400"}, {"station_id": "9"}), STATUS, target) == 1
    assert read(spark, target).filter("event_date IS NULL").count() == 2


def test_later_batches_meet_earlier_ones(spark, raw, tmp_path):
    target = str(tmp_path / "status")

    def batch(*days):
        return raw(*({"station_status_last_reported": str(1_700_000_000 + d * 86_400)} for d in days))

    assert land(batch(0, 1, 2, 3), STATUS, target) == 4
    assert land(batch(1, 3, 5, 7), STATUS, target) == 2
    assert read(spark, target).select(*KEY).distinct().count() == 6


def test_partial_append_then_retry(spark, raw, tmp_path):
    target = str(tmp_path / "status")
    feed = raw(*({"station_id": str(i)} for i in range(20)))
    # A crash left some of the batch behind.
    part = bronze_rows(feed, STATUS).filter("station_id < '15'").select(*STATUS.schema.fieldNames())
    part.write.partitionBy("event_date").mode("append").parquet(target)
    left = read(spark, target).count()
    assert 0 < left < 20
    assert land(feed, STATUS, target) == 20 - left
    assert read(spark, target).groupBy(*KEY).count().filter("count > 1").count() == 0


def test_insert_reads_only_touched_partitions(spark, raw, tmp_path):
    target = str(tmp_path / "status")
    land(raw({}, {"station_status_last_reported": "1600000000"}), STATUS, target)
    new = bronze_rows(raw({}), STATUS)
    existing = read(spark, target).filter(insert.touched_dates(new, "event_date"))
    text = plan(insert.absent_from(new, existing, KEY))
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "ReadSchema: struct<station_id:string,station_status_last_reported:bigint>" in text
    assert "LeftSemi" in text and "LeftAnti" in text


def test_dead_letters_say_why_and_come_once(spark, raw, tmp_path):
    feed = raw({**BAD, "capacity": "big"}, {}, {"lat": "north", "missing_station_information": "true"})
    letters = dead_letters(feed)
    assert rows(letters, "error_message") == [
        ("bronze_station_information: capacity is not int: big",),
        ("bronze_station_status: num_bikes_available is not int: n/a",),
    ]
    payload = letters.select(F.get_json_object("raw_payload", "$.station_name")).first()[0]
    assert payload == "Main St"
    target = str(tmp_path / "dlq")
    assert land_dead_letters(letters, target) == 2
    assert land_dead_letters(letters, target) == 0
    assert read_count(spark, target) == 2


def test_one_file_of_letters_per_task_and_few_after_folding(spark, raw, tmp_path):
    target, many = str(tmp_path / "dlq"), 40
    for load in range(3):
        feed = raw(*({**BAD, "station_id": f"{load}-{i}"} for i in range(many)))
        assert land_dead_letters(dead_letters(feed), target) == many
    folder = layers.partition_path(target, "source_topic", None)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(layers.partition_files(spark, folder, None)) <= 3 * tasks
    before = rows(layers.read_layer(spark, target, schemas.DEAD_LETTERS), "dlq_id", "raw_payload")
    assert fold_dead_letters(spark, target) == 1
    assert rows(layers.read_layer(spark, target, schemas.DEAD_LETTERS), "dlq_id", "raw_payload") == before
    # A fold that crashed half way has left copies; the next one drops them.
    spark.read.parquet(folder).limit(50).write.mode("append").parquet(folder)
    assert fold_dead_letters(spark, target, rows_a_file=50) <= 3
    assert rows(layers.read_layer(spark, target, schemas.DEAD_LETTERS), "dlq_id", "raw_payload") == before
    assert fold_dead_letters(spark, str(tmp_path / "none")) == 0


def read_count(spark, path):
    return layers.read_layer(spark, path, schemas.DEAD_LETTERS).count()


def test_last_write_wins_over_what_is_stored(spark, raw, tmp_path):
    target = str(tmp_path / "info")
    land_latest(raw({"station_name": "a"}, {"station_id": "2", "station_name": "b"}), INFO, target)
    land_latest(raw({"station_name": "c"}, {"station_name": "d"}), INFO, target)
    current = layers.read_current(spark, target, INFO.schema)
    assert rows(current, "station_id", "station_name") == [("1", "d"), ("2", "b")]


def test_unknown_modes_are_refused(raw):
    with pytest.raises(ValueError):
        bronze_rows(raw({}), STATUS, mode="replay")
    with pytest.raises(ValueError):
        bronze_rows(raw({}), STATUS, on_bad="ignore")
