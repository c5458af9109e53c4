import os
import signal
import threading
import time

import pytest
from test_streaming import KEY, bench, feed  # noqa: F401
from conftest import rows
from pyspark.sql import functions as F

from stationlake.operators.ingest import STATUS, bronze_rows
from stationlake.sources import layers, messages
from stationlake.sources.messages import TOPIC_STATUS
from stationlake.streaming import ingest as streaming
from stationlake.streaming import watch


def start(bench, source=None, **options):  # noqa: F811
    options = {"interval": "300 milliseconds"} | options
    source = bench.source(max_files=None) if source is None else source
    return streaming.start_ingest_stream(source, STATUS, bench.table, f"{bench.root}/checkpoint", bench.dlq, **options)


def sent_in_files(bench, raw, messages_a_file=2):  # noqa: F811
    """12 messages of 5 rows in one task, and the files that they lie in."""
    packed = messages.encode_messages(feed(raw).coalesce(1), 5).coalesce(1)
    messages.write_message_dir(packed, f"{bench.root}/topics", messages_a_file)
    directory = f"{bench.root}/topics/topic={TOPIC_STATUS}"
    return directory, layers.list_files(bench.spark, directory, ".parquet")


def test_a_topic_is_drained_in_batches_of_the_given_size(bench, raw):  # noqa: F811
    directory, files = sent_in_files(bench, raw)
    sizes = [os.path.getsize(f.removeprefix("file:")) for f in files]
    assert len(files) == 6 and 3 * min(sizes) > 2 * max(sizes) + 1
    source = messages.stream_message_dir(
        bench.spark, directory, TOPIC_STATUS, max_bytes=2 * max(sizes) + 1
    )
    query = start(bench, source, available_now=True)
    streaming.drain(query)
    # A message is one row of the source.
    took = [p["sources"][0]["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(took) == 3
    assert rows(bench.read(), *KEY) == rows(bronze_rows(feed(raw), STATUS), *KEY)


def test_a_file_over_the_limit_is_a_batch_of_its_own(bench, raw):  # noqa: F811
    directory, files = sent_in_files(bench, raw, 4)
    source = messages.stream_message_dir(bench.spark, directory, TOPIC_STATUS, max_bytes=1)
    query = start(bench, source, available_now=True)
    streaming.drain(query)
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == len(files) == 3
    assert rows(bench.read(), *KEY) == rows(bronze_rows(feed(raw), STATUS), *KEY)


def test_a_producer_that_pauses_is_waited_for(bench, raw):  # noqa: F811
    parts = feed(raw).randomSplit([1.0, 1.0], seed=5)
    first, second = (messages.encode_messages(part, 5) for part in parts)
    bench.send(first)
    query = start(bench)

    def late():
        time.sleep(2)
        bench.send(second)

    producer = threading.Thread(target=late)
    began = time.monotonic()
    producer.start()
    try:
        seen = watch.wait(bench.spark, query, quiet=8)
        assert query.isActive
    finally:
        producer.join()
        streaming.stop_gracefully(query)
    watch.raise_failures(query)
    assert time.monotonic() - began > 10  # the pause, then the quiet time
    assert seen >= second.filter(F.col("topic") == TOPIC_STATUS).count()
    assert rows(bench.read(), *KEY) == rows(bronze_rows(feed(raw), STATUS), *KEY)


def test_streams_that_end_by_themselves_are_not_waited_for(bench, raw):  # noqa: F811
    bench.send(messages.encode_messages(feed(raw), 5))
    query = start(bench, available_now=True)
    watch.wait(bench.spark, query, quiet=600)
    assert not query.isActive
    watch.raise_failures(query)


def test_a_failure_ends_the_wait_and_is_raised(bench, raw):  # noqa: F811
    bench.send(messages.encode_messages(feed(raw), 5))
    query = start(bench, on_bad="fail")
    watch.wait(bench.spark, query, quiet=600)
    with pytest.raises(Exception, match="num_bikes_available is not int"):
        watch.raise_failures(query)


@pytest.mark.parametrize("number", [signal.SIGINT, signal.SIGTERM])
def test_a_signal_ends_the_wait_after_the_batch(bench, raw, number):  # noqa: F811
    bench.send(messages.encode_messages(feed(raw), 5))
    before = signal.getsignal(number)
    query = start(bench)
    with watch.stop_signals() as stop:
        timer = threading.Timer(1, os.kill, (os.getpid(), number))
        timer.start()
        watch.wait(bench.spark, query, stop=stop)
        assert stop.is_set()
    streaming.stop_gracefully(query)
    assert signal.getsignal(number) is before
    # What was begun is whole; a restart takes the rest.
    query = start(bench, available_now=True)
    streaming.drain(query)
    assert rows(bench.read(), *KEY) == rows(bronze_rows(feed(raw), STATUS), *KEY)
