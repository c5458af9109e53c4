
import pytest
from conftest import SOUND
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.functions.scalars import BULK_NULLS, FEED_NULLS
from stationlake.operators.ingest import INFO, MALFORMED_LINE
from stationlake.plans.pipeline import Lake, load_batch, loaded_by_file
from stationlake.sources import layers
from stationlake.sources.csv_feed import (
    file_limit,
    list_feed,
    peek,
    read_feed_csv,
    sample_first_m,
    write_feed_csv,
)


def test_null_tokens_in_files(spark, tmp_path, write_csv):
    folder = write_csv(
        tmp_path / "in",
        "a.csv",
        {"station_name": r"\N", "region_id": "", "capacity": '""', "has_kiosk": "null"},
    )
    columns = ["station_name", "region_id", "capacity", "has_kiosk"]
    feed = read_feed_csv(spark, folder, FEED_NULLS).select(*columns).first()
    bulk = read_feed_csv(spark, folder, BULK_NULLS).select(*columns).first()
    assert tuple(feed) == (None, None, None, None)
    assert tuple(bulk) == (None, None, "", "null")


def test_quotes_and_padding_survive(spark, tmp_path, write_csv):
    folder = write_csv(
        tmp_path / "in", "a.csv", {"station_name": '"A ""B"", C"', "station_id": "  7 "}
    )
    row = read_feed_csv(spark, folder).first()
    assert (row.station_name, row.station_id, row.source_file) == ('A "B", C', "  7 ", "a.csv")


def test_wrong_header_is_refused(spark, tmp_path, write_csv):
    header = ["wrong", *schemas.RAW_COLUMNS[1:]]
    folder = write_csv(tmp_path / "in", "a.csv", {}, header=header)
    with pytest.raises(Exception, match="(?i)header"):
        read_feed_csv(spark, folder).collect()


@pytest.fixture
def uneven(tmp_path, write_csv):
    """Five files of uneven length; bikes number the rows in file-then-row order."""
    number = 0
    for name, length in zip("abcde", (3, 40, 1, 17, 60)):
        rows = []
        for _ in range(length):
            rows.append({"num_bikes_available": str(number), "station_name": "x" * (number % 50)})
            number += 1
        folder = write_csv(tmp_path / "uneven", f"{name}.csv", *rows)
    return folder, number


@pytest.mark.parametrize("split_bytes", [300, 1000, 3000, 128 * 1024 * 1024])
@pytest.mark.parametrize("open_cost", [0, 100, 4 * 1024 * 1024])
def test_arrival_order_is_file_then_row(spark, uneven, split_bytes, open_cost):
    folder, total = uneven
    wanted = {
        "spark.sql.files.maxPartitionBytes": split_bytes,
        "spark.sql.files.openCostInBytes": open_cost,
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        feed = read_feed_csv(spark, folder)
        order = feed.orderBy(*schemas.ARRIVAL).select("num_bikes_available").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert [int(r[0]) for r in order] == list(range(total))


@pytest.mark.parametrize("m", [0, 1, 3, 4, 43, 44, 61, 120, 121, 500])
def test_sample_first_m_matches_a_global_sort(spark, uneven, m):
    folder, total = uneven
    sample = sample_first_m(read_feed_csv(spark, folder), m)
    got = sorted(int(r[0]) for r in sample.select("num_bikes_available").collect())
    assert got == list(range(min(m, total)))


def test_sample_crosses_position_ranges(spark):
    feed = spark.range(0, 50).select(
        F.lit("s").alias("arrival_source"), (F.col("id") * 100_000).alias("arrival_pos")
    )
    got = sample_first_m(feed, 37).agg(F.count("*"), F.max("arrival_pos")).first()
    assert tuple(got) == (37, 36 * 100_000)


def test_file_choice(spark, uneven):
    folder, _ = uneven
    assert [file_limit(v) for v in ("0", "all", "", None, "3", -2)] == [None] * 4 + [3, 1]
    assert [f[-5:] for f in list_feed(spark, folder, 2)] == ["a.csv", "b.csv"]
    assert len(list_feed(spark, [f"{folder}/c.csv", folder])) == 6
    with pytest.raises(FileNotFoundError):
        list_feed(spark, f"{folder}/nothing")


def test_written_feed_reads_back(spark, raw, tmp_path):
    feed = raw({"station_id": " 1  ", "station_name": None}, {"station_id": "2"})
    back = read_feed_csv(spark, write_feed_csv(feed, str(tmp_path / "out")))
    got = [tuple(r) for r in back.orderBy(*schemas.ARRIVAL).select(*schemas.RAW_COLUMNS).collect()]
    assert got[0][0] == " 1  " and got[0][10] is None and got[1][0] == "2"
    assert got[1][1:] == tuple(SOUND[c] for c in schemas.RAW_COLUMNS[1:])


def test_peek(raw):
    feed = raw(*({"station_id": str(i)} for i in range(9)))
    assert [r.station_id for r in peek(feed.repartition(5), 3).collect()] == ["0", "1", "2"]


RAGGED = "9,1,2,3,4,5,6,7,8,1700000000"


@pytest.fixture
def ragged_feed(write_csv, tmp_path):
    """Two sound rows, one too long, one too short, one with a line break in quotes."""
    folder = tmp_path / "feed"
    write_csv(folder, "a.csv", {}, {"station_id": "2", "station_name": '"A\nB"'})
    path = folder / "a.csv"
    long = path.read_text(encoding="utf-8").splitlines()[1] + ",x,y"
    path.write_text(path.read_text(encoding="utf-8") + f"{long}\n{RAGGED}\n", encoding="utf-8")
    return str(folder)


def test_lines_that_are_no_rows_become_dead_letters(spark, ragged_feed, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    loaded = load_batch(spark, ragged_feed, lake)
    assert (loaded["status"], loaded["info"], loaded["dead_letters"]) == (1, 1, 4)
    letters = layers.read_layer(spark, lake.dlq, schemas.DEAD_LETTERS)
    texts = [r.raw_payload for r in letters.collect()]
    assert RAGGED in texts and any(t.endswith(",x,y") for t in texts)
    assert {r.error_message for r in letters.collect()} == {MALFORMED_LINE}


def test_multi_line_fields_are_read_on_demand(spark, ragged_feed, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    loaded = load_batch(spark, ragged_feed, lake, multi_line=True)
    assert (loaded["info"], loaded["dead_letters"]) == (2, 2)
    info = layers.read_layer(spark, lake.info, INFO.schema)
    assert "A\nB" in [r.station_name for r in info.collect()]


def test_fail_writes_nothing(spark, write_csv, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    feed = write_csv(tmp_path / "feed", "a.csv", {}, {"station_id": "2", "capacity": "big"})
    with pytest.raises(ValueError, match="capacity is not int: big"):
        load_batch(spark, feed, lake, on_bad="fail")
    assert not any(layers.exists(spark, p) for p in (lake.status, lake.info, lake.watermark))
    log = layers.read_layer(spark, lake.log, schemas.RUN_LOG)
    assert sorted(r.status for r in log.collect()) == ["FAILED", "RUNNING"]


def test_rows_of_a_load_are_counted_by_file(spark, write_csv, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    feed = write_csv(tmp_path / "feed", "a.csv", {})
    load_batch(spark, feed, lake)
    write_csv(tmp_path / "feed", "b.csv", {"station_id": "x" * 51}, {"station_id": "3"})
    assert load_batch(spark, feed, lake)["dead_letters"] == 2
    counts = loaded_by_file(spark, lake).collect()
    assert sorted((r.table_name, r.source_file, r.rows_loaded) for r in counts) == [
        ("bronze_station_information", "b.csv", 1),
        ("bronze_station_status", "b.csv", 1),
    ]
