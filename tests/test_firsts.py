import random

from conftest import plan, rows
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.operators.firsts import (
    first_wins,
    last_wins,
    latest_values,
    unique_when_present,
)
from stationlake.plans import silver


def test_fact_keeps_the_first_arrival_whatever_the_partitioning(raw):
    feed = raw(
        {"num_bikes_available": "1"},
        {"num_bikes_available": "2"},
        {"station_id": " 1 ", "num_bikes_available": "3"},
        {"station_id": "2", "num_bikes_available": "n/a"},
        {"station_id": "2", "num_bikes_available": "4"},
        {"station_id": None},
        {"station_status_last_reported": "1000000000"},
        {"station_id": "8d0e-uuid", "num_bikes_available": "9"},
    )
    want = [("1", 1), ("2", None), ("8d0e-uuid", 9)]
    for parts in (1, 3, 7):
        fact = silver.status_fact(silver.parse(feed.repartition(parts)))
        assert rows(fact, "station_id", "num_bikes_available") == want


def test_order_across_sources(raw):
    late = raw({"num_bikes_available": "1"}, source="b.csv")
    early = raw({"num_bikes_available": "2"}, source="a.csv")
    both = late.unionByName(early)
    assert rows(first_wins(both, ["station_id"]), "num_bikes_available") == [("2",)]
    assert rows(last_wins(both, ["station_id"]), "num_bikes_available") == [("1",)]


def brute_dimension(parsed_rows):
    """First present value per station and column, by a plain loop."""
    found = {}
    for r in sorted(parsed_rows, key=lambda r: (r["arrival_source"], r["arrival_pos"])):
        if r["missing_station_information"]:
            continue
        seen = found.setdefault(r["station_id"], {})
        for c in schemas.DIMENSION_COLUMNS:
            if seen.get(c) is None:
                seen[c] = r[c]
    return sorted(
        ((s, *(v[c] for c in schemas.DIMENSION_COLUMNS)) for s, v in found.items()), key=repr
    )


def test_dimension_matches_a_plain_loop(raw):
    pick = random.Random(7)

    def maybe(*options):
        return pick.choice([None, *options])

    frames = []
    for source in ("b.csv", "a.csv", "c.csv"):
        frames.append(
            raw(
                *(
                    {
                        "station_id": maybe("1", "2", "3"),
                        "station_name": maybe("A", "B ", " C"),
                        "lat": maybe("40.1", "x"),
                        "lon": maybe("-74.1"),
                        "region_id": maybe("1", "2"),
                        "capacity": maybe("20", "30"),
                        "has_kiosk": maybe("true", "False"),
                        "station_information_last_updated": maybe("0", "1700000000", "1700000500"),
                        "missing_station_information": maybe("true", "false", "False"),
                    }
                    for _ in range(25)
                ),
                source=source,
            )
        )
    feed = frames[0].unionByName(frames[1]).unionByName(frames[2])
    parsed = silver.parse(feed.repartition(6))
    got = rows(
        silver.station_dimension(parsed), "station_id", *schemas.DIMENSION_COLUMNS
    )
    assert got == brute_dimension([r.asDict() for r in parsed.collect()])


def test_latest_dimension_prefers_the_newest_update(raw):
    feed = raw(
        {"station_name": "old", "station_information_last_updated": "1700000000"},
        {"station_name": "new", "station_information_last_updated": "1700000900", "capacity": None},
        {"station_name": "undated", "station_information_last_updated": None},
    )
    latest = silver.station_dimension(silver.parse(feed), pick="latest").first()
    first = silver.station_dimension(silver.parse(feed)).first()
    assert (latest.station_name, latest.capacity, first.station_name) == ("new", 20, "old")


def test_latest_values(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 3, None), ("a", 2, 30), ("b", 1, 5)], "k string, at bigint, v int"
    )
    assert rows(latest_values(df, ["k"], ["v"], "at"), "k", "v", "at") == [
        ("a", None, 3),
        ("b", 5, 1),
    ]


def test_unique_only_where_there_is_a_key(spark):
    df = spark.createDataFrame(
        [("e1", 1), ("e1", 2), (None, 3), (None, 3), ("e2", 4)], "event_id string, n int"
    )
    got = rows(unique_when_present(df, "event_id", ["n"]), "event_id", "n")
    assert got == [("e1", 1), ("e2", 4), (None, 3), (None, 3)]


def test_plans_prune_before_the_shuffle(raw):
    parsed = silver.parse(raw({}, {}))
    fact = plan(silver.status_fact(parsed))
    before, after = fact.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
    dimension = plan(silver.station_dimension(parsed))
    # The first level, next to the data, is a hash aggregate.
    assert dimension.rindex("HashAggregate") > dimension.rindex("SortAggregate")
    latest = plan(latest_values(parsed, ["station_id"], ["capacity"], "num_bikes_available"))
    assert "Sort" not in latest and "HashAggregate" in latest


def test_hot_key_sends_one_row_per_task(spark):
    hot = spark.range(0, 30_000, 1, 6).select(
        F.lit("k").alias("station_id"),
        F.lit("s").alias("arrival_source"),
        F.col("id").alias("arrival_pos"),
    )
    assert rows(first_wins(hot, ["station_id"]), "arrival_pos") == [(0,)]
