import os
from datetime import datetime

import pytest
from conftest import rows

from stationlake import schemas
from stationlake.__main__ import main
from stationlake.operators import control
from stationlake.operators.ingest import INFO, STATUS, bronze_rows
from stationlake.plans import pipeline
from stationlake.plans.pipeline import Config, Lake, build_warehouse, load_batch, produce, run_pipeline
from stationlake.sources import layers, messages
from stationlake.sources.csv_feed import read_feed_csv
from stationlake.streaming import ingest as streaming


@pytest.fixture
def csv(tmp_path, write_csv):
    for n, name in enumerate(("a.csv", "b.csv")):
        folder = write_csv(
            tmp_path / "in",
            name,
            {"station_id": "1", "num_bikes_available": str(n)},
            {"station_id": f"only-{n}", "station_status_last_reported": str(1_700_090_000 + n)},
            {"station_id": "3", "num_bikes_available": "n/a", "missing_station_information": "true"},
        )
    return folder


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def written_at(path):
    return os.stat(f"{path}/_SUCCESS").st_mtime_ns


def test_pipeline_end_to_end_and_skipping(spark, csv, lake):
    cfg = Config(lake, csv)
    out = run_pipeline(spark, cfg)
    assert sorted(out) == [
        "bronze", "daily_station_summary", "hourly_patterns", "silver_dimension", "silver_status",
        "station_summary",
    ]
    fact, dimension = pipeline.read_silver(spark, lake)
    assert fact.count() == 4 and dimension.count() == 3
    assert rows(fact.filter("station_id = '1'"), "num_bikes_available") == [(0,)]
    daily = spark.read.parquet(out["daily_station_summary"])
    assert daily.count() == 4 and "date=2023-11-14" in os.listdir(out["daily_station_summary"])
    # Complete layers are left alone; a forced one is rebuilt.
    before = {name: written_at(path) for name, path in out.items()}
    run_pipeline(spark, Config(lake, csv, force_gold=True))
    after = {name: written_at(path) for name, path in out.items()}
    changed = {name for name in out if before[name] != after[name]}
    assert changed == {"daily_station_summary", "hourly_patterns", "station_summary"}
    # A layer whose write did not finish is not complete.
    os.remove(f"{lake.dimension}/_SUCCESS")
    run_pipeline(spark, cfg)
    assert layers.is_complete(spark, lake.dimension)
    runs = control.runs(layers.read_layer(spark, lake.log, schemas.RUN_LOG))
    assert rows(runs.groupBy("layer", "status").count(), "layer", "status", "count") == [
        ("BRONZE", "SUCCESS", 3), ("GOLD", "SUCCESS", 3), ("SILVER", "SUCCESS", 3),
    ]
    assert runs.filter("layer = 'BRONZE'").first().rows_processed == 6


def test_failed_run_is_logged(spark, lake):
    with pytest.raises(ValueError):
        run_pipeline(spark, Config(lake))
    run = control.runs(layers.read_layer(spark, lake.log, schemas.RUN_LOG)).first()
    assert (run.layer, run.status) == ("BRONZE", "FAILED") and "no CSV folder" in run.error_message
    with pytest.raises(ValueError):
        control.log_row(spark, "x", "p", "IRON", "SUCCESS")


def test_pipeline_from_the_stream(spark, csv, lake):
    cfg = Config(lake, use_stream=True)
    with pytest.raises(RuntimeError, match="append stream"):
        run_pipeline(spark, cfg)
    produce(spark, csv, f"{lake.root}/topics")
    source = messages.stream_message_dir(
        spark, f"{lake.root}/topics/topic={messages.TOPIC_STATUS}", messages.TOPIC_STATUS
    )
    streaming.drain(
        streaming.start_append_stream(
            source, lake.raw_stream, lake.at("checkpoints", "append"), available_now=True
        )
    )
    run_pipeline(spark, cfg)
    streamed = pipeline.read_silver(spark, lake)[0]
    other = Lake(f"{lake.root}-csv")
    run_pipeline(spark, Config(other, csv))
    key = ["station_id", "reported_at"]
    assert rows(streamed, *key) == rows(pipeline.read_silver(spark, other)[0], *key)


def test_load_batch_and_watermark(spark, csv, lake):
    assert load_batch(spark, csv, lake) == {"status": 3, "info": 3, "dead_letters": 2}
    assert load_batch(spark, csv, lake) == {"status": 0, "info": 0, "dead_letters": 0}
    mark = layers.read_current(spark, lake.watermark, schemas.WATERMARK)
    assert rows(mark, "source_name", "last_reported_ts", "rows_loaded") == [
        (INFO.name, None, 3),
        (STATUS.name, datetime(2023, 11, 15, 23, 13, 21), 3),
    ]
    bronze = layers.read_layer(spark, lake.status, STATUS.schema)
    assert rows(control.load_counts(bronze), "source_file", "rows_loaded") == [
        ("a.csv", 2), ("b.csv", 1),
    ]


def test_mark_never_goes_back_and_absent_tables_keep_theirs(spark, raw):
    first = control.refresh_watermark(
        control.seed_watermark(spark), {STATUS.name: bronze_rows(raw({}), STATUS)}
    )
    older = bronze_rows(raw({"station_status_last_reported": "1600000000"}), STATUS)
    again = control.refresh_watermark(first, {STATUS.name: older}, since=datetime(2023, 1, 1).date())
    assert rows(again, "source_name", "last_reported_ts", "rows_loaded") == [
        (INFO.name, None, 0),
        (STATUS.name, datetime(2023, 11, 14, 22, 13, 20), 1),
    ]


def test_above_mark(raw):
    bronze = bronze_rows(
        raw(
            {"station_status_last_reported": "1700000000"},
            {"station_status_last_reported": "1700000001"},
            {"station_status_last_reported": "1600000000"},
            {"station_status_last_reported": "99999999999"},
        ),
        STATUS,
    )
    mark = datetime(2023, 11, 14, 22, 13, 20)
    got = rows(control.above_mark(bronze, mark), "station_status_last_reported")
    assert got == [(1_700_000_001,), (99_999_999_999,)]
    assert control.above_mark(bronze, None).count() == 4


def test_versions_switch_only_when_complete(spark, tmp_path):
    path = str(tmp_path / "control")
    assert layers.current_version(spark, path) is None
    layers.write_version(spark.range(1), path)
    second = layers.write_version(spark.range(2), path)
    assert layers.current_version(spark, path) == second
    os.remove(f"{second}/_SUCCESS")
    assert layers.current_version(spark, path).endswith("v=1")
    assert layers.write_version(spark.range(3), path).endswith("v=3")


def test_warehouse(spark, csv, lake):
    load_batch(spark, csv, lake)
    feed = read_feed_csv(spark, csv, (r"\N",))
    paths = build_warehouse(spark, lake, feed)
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()
              if layers.exists(spark, path)}
    assert counts["silver_station_status"] == 3 and counts["silver_station_information"] == 3
    assert counts["gold_station_availability"] == counts["gold_station_summary"] == 3
    assert counts["gold_region_summary"] == 1 and counts["gold_station_daily"] == 3
    assert counts["bounds_violations"] == 0 and counts["gold_data_quality"] == 13
    gold = spark.read.parquet(paths["gold_station_summary"])
    assert dict(gold.dtypes)["avg_utilization"] == "decimal(8,4)"
    audit = spark.read.parquet(paths["gold_data_quality"])
    assert audit.select("dq_id").distinct().count() == 13
    build_warehouse(spark, lake, feed)
    assert spark.read.parquet(paths["gold_data_quality"]).count() == 26


def test_produce_counts_and_row_cap(spark, csv, tmp_path):
    assert produce(spark, csv, str(tmp_path / "t1")) == {"status": 6, "info": 4}
    assert produce(spark, csv, str(tmp_path / "t2"), max_rows=4) == {"status": 4, "info": 3}
    assert produce(spark, csv, str(tmp_path / "t3"), max_files=1) == {"status": 3, "info": 2}


def test_command_line(spark, csv, lake, capsys):
    root = ["--lake", lake.root]
    main(["run", *root, "--csv", csv, "--force-all"])
    assert "station_summary: " in capsys.readouterr().out
    main(["load", *root, csv])
    main(["warehouse", *root])
    main(["produce", *root, csv])
    for what in ("status", "info", "append"):
        main(["consume", *root, what, "--until-empty"])
    # The streams met tables the load had filled already.
    assert layers.read_layer(spark, lake.status, STATUS.schema).count() == 3
    main(["bench", *root, "batch", "--csv", csv])
    main(["bench", *root, "stream", "--csv", csv, "--max-rows", "5"])
    capsys.readouterr()
    main(["report", *root])
    report = capsys.readouterr().out
    assert "| 2 files | - | 6 |" in report and "| stream |" in report and "best batch rate" in report
