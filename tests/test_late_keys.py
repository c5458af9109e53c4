"""Late keys meet a large table: what is read of it, and what lands."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stationlake.operators import insert
from stationlake.operators.ingest import STATUS, complete, land, pick_rows, project
from stationlake.sources import layers

DAY = 86_400
FIRST = 1_640_995_200  # 2022-01-01, UTC
DAYS, HOT_DAY, STATIONS = 730, 400, 3000
KEY = list(STATUS.keys)
# Times of the hot day that follow no pattern, one in each stretch of 600 s.
HOT_TIMES = f"{FIRST + HOT_DAY * DAY} + 600 * (id div {STATIONS}) + pmod(xxhash64(id), 600)"


def status(spark, station, at):
    """Raw rows of the stations and times that two expressions over ``id`` give."""
    return lambda ids: ids.select(
        F.expr(station).cast("string").alias("station_id"),
        *(F.lit("1").alias(c) for c in STATUS.columns if c not in KEY),
        F.expr(at).cast("string").alias("station_status_last_reported"),
        F.lit("false").alias("missing_station_information"),
        F.lit("a.csv").alias("source_file"),
        F.lit("a.csv").alias("arrival_source"),
        F.col("id").alias("arrival_pos"),
    )


@pytest.fixture(scope="module")
def two_years(spark, tmp_path_factory):
    """Ten rows on each of 730 days, and 300,000 more on one of them."""
    table = str(tmp_path_factory.mktemp("late") / "table")
    thin = status(spark, "id % 10", f"{FIRST} + (id div 10) * {DAY}")(spark.range(10 * DAYS))
    hot = status(spark, f"1000 + id % {STATIONS}", HOT_TIMES)(spark.range(100 * STATIONS))
    land(thin.unionByName(hot), STATUS, table)
    return table


def late_rows(spark):
    """Ten keys: five on the hot day, of which two are there, five on other days."""
    there = spark.range(500, 502).select(
        F.expr(f"string(1000 + id % {STATIONS})").alias("station"), F.expr(HOT_TIMES).alias("at")
    )
    data = [(str(1502 + i), FIRST + HOT_DAY * DAY + 70_000) for i in range(3)]
    data += [(str(i), FIRST + (90 + 100 * i) * DAY + 7) for i in range(5)]
    keys = there.unionByName(spark.createDataFrame(data, "station string, at long"))
    return status(spark, "station", "at")(keys.withColumn("id", F.monotonically_increasing_id()))


def bytes_read(spark, action):
    """Bytes that files gave while an action ran; executors share this JVM."""

    def so_far():
        statistics = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
        return sum(s.getBytesRead() for s in statistics)

    before = so_far()
    action()
    return so_far() - before


def test_only_pages_that_may_have_a_late_key_are_read(spark, two_years):
    batch = complete(project(late_rows(spark), STATUS), STATUS)
    touched = insert.touched_by(batch, "event_date", "station_id")
    assert len(touched.partitions) == 6 and 1 <= len(touched.ranges) <= 10

    def read(values, ranges):
        table = layers.read_layer(spark, two_years, STATUS.schema)
        reach = insert.in_reach(table, "event_date", values, STATUS.sort, ranges)
        return bytes_read(spark, lambda: reach.select(*KEY).write.format("noop").mode("overwrite").save())

    # Hadoop does not count the bytes of vectored reads.
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    try:
        everything = read(None, None)
        dates = read(touched.partitions, None)
        pages = read(*touched)
    finally:
        spark.conf.unset("parquet.hadoop.vectored.io.enabled")
    # Measured: 8.0 MB, 1.4 MB and 0.7 MB, of which most are dictionary pages.
    assert pages < everything / 10, (pages, dates, everything)
    assert pages < dates * 2 / 3, (pages, dates, everything)


def test_ranges_hold_every_key_and_few_are_narrow(spark):
    keys = [f"{i:05d}" for i in range(0, 50_000, 7)]
    frame = spark.createDataFrame([(k, i % 3) for i, k in enumerate(keys)], "k string, p int")
    partitions, ranges = insert.touched_by(frame, "p", "k")
    assert sorted(partitions) == [0, 1, 2]
    assert len(ranges) <= insert.KEY_GROUPS
    assert all(any(a <= k <= b for a, b in ranges) for k in keys)
    assert all(ranges[i][1] < ranges[i + 1][0] for i in range(len(ranges) - 1))
    one = insert.touched_by(frame.limit(1), "p", "k")
    assert one == ([0], [("00000", "00000")])
    assert insert.touched_by(frame.filter("false"), "p", "k") == ([], [])


def test_partitions_without_a_value_are_touched(spark):
    frame = spark.createDataFrame([("a", None), ("b", 1)], "k string, p int")
    assert set(insert.touched_by(frame, "p", "k").partitions) == {None, 1}


def test_late_keys_land_once(spark, two_years):
    def table():
        return layers.read_layer(spark, two_years, STATUS.schema)

    before = table().count()
    late = late_rows(spark)
    assert land(late, STATUS, two_years) == 8
    assert land(late, STATUS, two_years) == 0
    assert table().count() == before + 8
    wanted = rows(pick_rows(project(late, STATUS), STATUS), *KEY)
    found = rows(table().join(late.select("station_id").distinct(), "station_id"), *KEY)
    assert set(wanted) <= set(found) and len(found) == len(set(found))
    # An empty batch reads and adds nothing.
    assert land(late.filter("false"), STATUS, two_years) == 0
