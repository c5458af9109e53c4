import json

import pytest
from conftest import SOUND, rows
from pyspark.sql import functions as F
from test_messages import message_frame

from stationlake import schemas
from stationlake.operators.ingest import INFO, STATUS, bronze_rows
from stationlake.sources import layers, messages
from stationlake.sources.messages import TOPIC_INFO, TOPIC_STATUS
from stationlake.streaming import ingest as streaming

KEY = ["station_id", "station_status_last_reported"]


class Bench:
    """A topic directory and the paths of its stream."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.table, self.dlq = f"{self.root}/table", f"{self.root}/dlq"

    def send(self, frame):
        messages.write_message_dir(frame, f"{self.root}/topics")

    def source(self, topic=TOPIC_STATUS, max_files=1):
        directory = f"{self.root}/topics/topic={topic}"
        return messages.stream_message_dir(self.spark, directory, topic, max_files)

    def drain(self, landing=STATUS, topic=TOPIC_STATUS, checkpoint="checkpoint"):
        query = streaming.start_ingest_stream(
            self.source(topic),
            landing,
            self.table,
            f"{self.root}/{checkpoint}",
            self.dlq,
            available_now=True,
        )
        streaming.drain(query)
        return query

    def read(self, landing=STATUS):
        return layers.read_layer(self.spark, self.table, landing.schema)

    def letters(self):
        return layers.read_or_empty(self.spark, self.dlq, schemas.DEAD_LETTERS)


@pytest.fixture
def bench(spark, tmp_path):
    return Bench(spark, tmp_path)


def feed(raw, count=60):
    return raw(
        *(
            {
                "station_id": str(i % 7),
                "station_status_last_reported": str(1_700_000_000 + 3600 * (i // 2)),
                "num_bikes_available": "oops" if i % 20 == 3 else str(i % 2),
            }
            for i in range(count)
        )
    )


def test_many_batches_land_the_same_keys_as_a_batch_load(bench, raw):
    for part in feed(raw).randomSplit([1.0, 1.0, 1.0], seed=3):
        bench.send(messages.encode_messages(part, 5))
    query = bench.drain()
    assert len(query.recentProgress) >= 3
    assert rows(bench.read(), *KEY) == rows(bronze_rows(feed(raw), STATUS), *KEY)
    assert bench.letters().count() == 3


def test_one_ordered_batch_equals_the_batch_load(bench, raw):
    columns = [c for c in STATUS.columns]
    bench.send(messages.encode_messages(feed(raw), 8, ordered_partitions=3))
    streaming.land_messages(
        messages.read_message_dir(bench.spark, f"{bench.root}/topics/topic={TOPIC_STATUS}", TOPIC_STATUS),
        STATUS,
        bench.table,
        bench.dlq,
    )
    assert rows(bench.read(), *columns) == rows(bronze_rows(feed(raw), STATUS), *columns)


def test_replays_and_restarts_add_nothing(bench, raw):
    packed = messages.encode_messages(feed(raw), 5)
    bench.send(packed)
    bench.drain()
    landed = bench.read().count()
    # The same checkpoint has nothing left to do.
    assert not any(p["numInputRows"] for p in bench.drain().recentProgress)
    # The same rows again under new offsets, then all of it on a new checkpoint.
    bench.send(packed.withColumn("offset", F.col("offset") + 1000))
    bench.drain()
    bench.drain(checkpoint="lost-checkpoint")
    assert bench.read().count() == landed
    assert bench.read().select(*KEY).distinct().count() == landed


def test_crash_between_append_and_checkpoint(bench, raw):
    bench.send(messages.encode_messages(feed(raw), 5))
    batch = messages.read_message_dir(
        bench.spark, f"{bench.root}/topics/topic={TOPIC_STATUS}", TOPIC_STATUS
    )
    streaming.land_messages(batch.limit(3), STATUS, bench.table, bench.dlq)
    bench.drain()
    assert rows(bench.read(), *KEY) == rows(bronze_rows(feed(raw), STATUS), *KEY)
    assert bench.letters().select("event_id").distinct().count() == bench.letters().count() == 3


def test_late_rows_are_accepted(bench, raw):
    bench.send(messages.encode_messages(raw({"station_status_last_reported": "1700000000"})))
    bench.drain()
    bench.send(messages.encode_messages(raw({"station_status_last_reported": "1200000000"})))
    bench.drain()
    assert bench.read().count() == 2


def test_provenance_of_streamed_rows(bench, raw):
    bench.send(messages.encode_messages(raw({}, {"station_id": "2"})))
    bench.drain()
    got = bench.read().orderBy("station_id").collect()
    assert {(r.source_mode, r.kafka_topic, r.source_file) for r in got} == {
        ("stream", TOPIC_STATUS, None)
    }
    assert len({r.event_id for r in got}) == 2 and all(len(r.event_id) == 64 for r in got)


def test_info_stream(bench, raw):
    bench.send(messages.encode_messages(raw({}, {"station_name": "again"}, {"station_id": "2"})))
    bench.drain(INFO, TOPIC_INFO)
    bench.drain(INFO, TOPIC_INFO, "second")
    assert rows(bench.read(INFO), "station_id") == [("1",), ("2",)]


def test_malformed_messages_become_dead_letters(bench, spark):
    sound = json.dumps([SOUND, {**SOUND, "station_id": "2", "num_docks_disabled": "x"}])
    bench.send(message_frame(spark, sound, "{broken", "[]"))
    bench.drain()
    assert bench.read().count() == 1
    assert rows(bench.letters(), "kafka_offset", "error_message") == [
        (0, "bronze_station_status: num_docks_disabled is not int: x"),
        (1, "message is not a JSON array of rows"),
    ]
    assert bench.letters().filter("kafka_offset = 1").first().raw_payload == "{broken"


def test_append_stream_keeps_every_row(bench, raw, spark):
    bench.send(messages.encode_messages(feed(raw).unionByName(raw({"lat": "null"})), 10))
    target = f"{bench.root}/raw"
    for _ in range(2):
        query = streaming.start_append_stream(
            bench.source(), target, f"{bench.root}/append", available_now=True
        )
        streaming.drain(query)
    got = layers.read_layer(spark, target, schemas.RAW_LAYER)
    assert got.count() == 61 and got.filter("lat IS NULL").count() == 1
    assert got.select(*schemas.ARRIVAL).distinct().count() == 61


def test_running_stream_ends_its_batch_before_it_stops(bench, raw):
    bench.send(messages.encode_messages(raw({})))
    query = streaming.start_status_stream(
        bench.source(), bench.table, f"{bench.root}/checkpoint", bench.dlq, interval="1 second"
    )
    query.processAllAvailable()
    bench.send(messages.encode_messages(raw({"station_id": "2"})))
    streaming.stop_gracefully(query)
    assert not query.isActive and bench.read().count() >= 1
    again = streaming.start_status_stream(
        bench.source(), bench.table, f"{bench.root}/checkpoint", bench.dlq, available_now=True
    )
    streaming.drain(again)
    assert bench.read().count() == 2


def test_bad_value_stops_a_failing_stream(bench, raw):
    bench.send(messages.encode_messages(raw({"capacity": "x", "num_bikes_available": "x"})))
    query = streaming.start_ingest_stream(
        bench.source(), STATUS, bench.table, f"{bench.root}/c", bench.dlq, "fail", available_now=True
    )
    with pytest.raises(Exception, match="num_bikes_available is not int"):
        streaming.drain(query)


def test_blanking_stream_keeps_malformed_messages_apart(bench, spark):
    sound = json.dumps([{**SOUND, "num_bikes_available": "x"}])
    frame = message_frame(spark, sound, "{broken")
    streaming.land_messages(frame, STATUS, bench.table, bench.dlq, on_bad="null")
    assert rows(bench.read(), "num_bikes_available") == [(None,)]
    assert rows(bench.letters(), "error_message") == [("message is not a JSON array of rows",)]


def test_kafka_source_says_when_its_package_is_missing(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.stream_kafka(spark, "localhost:9092", TOPIC_STATUS, min_messages=2, max_messages=9)
