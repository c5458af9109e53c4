import json

from conftest import SOUND, rows
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.operators.ingest import event_id
from stationlake.sources import messages


def message_frame(spark, *values, topic=messages.TOPIC_STATUS, first_offset=0):
    data = [(v, topic, 0, first_offset + i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(data, schemas.MESSAGES)


def test_encode_then_decode_gives_the_rows_back(raw):
    feed = raw(*({"station_id": str(i), "lat": None} for i in range(25)))
    sent = messages.encode_messages(feed.repartition(3), rows_per_message=4).cache()
    status = sent.filter(F.col("topic") == messages.TOPIC_STATUS)
    assert status.agg(F.max("rows"), F.sum("rows")).first()[:] == (4, 25)
    decoded = messages.decode_messages(status)
    assert rows(decoded, *schemas.RAW_COLUMNS) == rows(feed, *schemas.RAW_COLUMNS)
    one = json.loads(status.first().value)[0]
    assert list(one) == schemas.RAW_COLUMNS and one["lat"] is None


def test_info_topic_gets_rows_with_the_exact_flag(raw):
    feed = raw({}, {"missing_station_information": "False"}, {"missing_station_information": "true"})
    sent = messages.encode_messages(feed)
    info = messages.decode_messages(sent.filter(F.col("topic") == messages.TOPIC_INFO))
    assert info.count() == 1
    none = messages.encode_messages(raw({"missing_station_information": "true"}))
    assert rows(none, "topic") == [(messages.TOPIC_STATUS,)]


def test_ordered_messages_keep_arrival_order(raw):
    feed = raw(*({"num_bikes_available": str(i)} for i in range(100)))
    sent = messages.encode_messages(feed.repartition(7), 9, ordered_partitions=4)
    decoded = messages.decode_messages(sent.filter(F.col("topic") == messages.TOPIC_STATUS))
    order = decoded.orderBy(*schemas.ARRIVAL).select("num_bikes_available").collect()
    assert [int(r[0]) for r in order] == list(range(100))


def test_producer_null_tokens(raw):
    sent = messages.encode_messages(raw({"lat": r"\N", "lon": "", "region_id": "null"}))
    row = messages.decode_messages(sent).first()
    assert (row.lat, row.lon, row.region_id) == (None, None, "null")


def test_odd_messages(spark):
    sound = json.dumps([{**SOUND, "extra": "x", "capacity": 20}])
    decoded = messages.decode_messages(message_frame(spark, sound, "[]", "{broken", None, "7"))
    good = decoded.filter("malformed IS NULL").collect()
    assert [(r.station_id, r.capacity, r.kafka_offset) for r in good] == [("1", "20", 0)]
    assert "extra" not in decoded.columns
    bad = decoded.filter("malformed IS NOT NULL")
    assert rows(bad, "kafka_offset", "malformed") == [(2, "{broken"), (3, ""), (4, "7")]


def test_a_null_in_an_array_is_malformed(spark):
    text = json.dumps([SOUND, None])
    decoded = messages.decode_messages(message_frame(spark, text))
    assert rows(decoded.filter("malformed IS NOT NULL"), "malformed", "arrival_pos") == [(text, 1)]
    assert decoded.filter("malformed IS NULL").count() == 1


def test_places_of_rows_are_their_own(spark):
    """Rows of neighbouring messages keep their order and get ids of their own."""
    text = json.dumps([SOUND] * 3)
    decoded = messages.decode_messages(message_frame(spark, text, text, first_offset=9))
    marked = decoded.select(*schemas.ARRIVAL, event_id().alias("event_id"), "kafka_offset")
    assert marked.select("event_id").distinct().count() == 6
    in_order = marked.orderBy(*schemas.ARRIVAL).collect()
    assert [(r.kafka_offset, r.arrival_pos) for r in in_order] == [
        (o, p) for o in (9, 10) for p in range(3)
    ]


def test_offsets_go_on_with_the_next_production(spark, raw, tmp_path):
    path = str(tmp_path / "topics")
    for name in ("oops", "worse"):
        messages.write_message_dir(
            messages.encode_messages(raw({"num_bikes_available": name}), ordered_partitions=1), path
        )
    stored = messages.read_message_dir(spark, f"{path}/topic=station-status", messages.TOPIC_STATUS)
    assert rows(stored, "partition", "offset") == [(0, 0), (0, 1)]
    decoded = messages.decode_messages(stored)
    assert decoded.select(event_id()).distinct().count() == 2


def test_binary_values_decode(spark):
    frame = message_frame(spark, json.dumps([SOUND])).withColumn("value", F.encode("value", "utf-8"))
    assert messages.decode_messages(frame).first().station_name == "Main St"
