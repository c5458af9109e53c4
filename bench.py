"""Headline benchmark: typing, facts, gold tables, and batch and stream ingest.

Prints one JSON line. Each query runs once to warm up and is then timed once.
Ingest runs over 500,000 and 2,000,000 CSV rows derived from the feed, after one
warm-up run of each mode over 20,000. BENCH_ONLY picks queries by name, with
"all" for the whole catalog and "ingest" for the ingest runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stationlake import benchmark  # noqa: E402
from stationlake.catalog import QUERIES  # noqa: E402
from stationlake.session import fresh_dir, local_session  # noqa: E402
from stationlake.sources import layers  # noqa: E402
from stationlake.sources.derived_feed import derived_feed  # noqa: E402

HEADLINE = [
    "raw_feed_scan",
    "silver_parsed",
    "silver_status_fact",
    "silver_station_dimension",
    "silver_status_validated",
    "gold_daily_summary",
    "gold_hourly_patterns",
    "gold_station_summary",
    "gold_station_availability",
    "gold_station_summary_sql",
    "gold_station_daily",
    "gold_region_summary",
    "gold_data_quality",
    "bronze_status_batch",
    "stream_bronze_status",
]
WARM_UP_ROWS = 20_000
INGEST_ROWS = [int(n) for n in os.environ.get("BENCH_INGEST_ROWS", "500000,2000000").split(",")]


def timed(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    chosen = os.environ.get("BENCH_ONLY", ",".join([*HEADLINE, "ingest"])).split(",")
    spark = local_session("bench", cores, memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for name, query in QUERIES.items():
        if name not in chosen and "all" not in chosen:
            continue
        timed(query, spark, sf_dir)
        seconds[name] = round(timed(query, spark, sf_dir), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    ingest = {}
    feed = derived_feed(spark, sf_dir)
    have = feed.count()
    for rows in [WARM_UP_ROWS, *INGEST_ROWS] if "ingest" in chosen else []:
        copies = benchmark.repeated_feed(feed.repartition(cores), -(-rows // have))
        source = layers.stored(copies, fresh_dir(spark, f"rows-{rows}"))
        csv = benchmark.sample_csv(source, rows, fresh_dir(spark, f"csv-{rows}"))
        for mode, run in benchmark.RUNNERS.items():
            result = run(spark, csv, fresh_dir(spark, f"ingest-{mode}"))
            if rows == WARM_UP_ROWS:
                continue
            key = f"ingest_{mode}_{rows}"
            seconds[key] = result["elapsed_seconds"]
            ingest[key] = {
                k: result.get(k)
                for k in ("rows_total", "rows_per_second", "producer_seconds")
                if result.get(k) is not None
            }
            ingest[key]["input_rows"] = rows
            print(key, result, file=sys.stderr, flush=True)

    print(
        json.dumps(
            {
                "metric": "total_query_and_ingest_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "ingest": ingest,
                "master": spark.sparkContext.master,
                "spark": spark.version,
                "driver_memory": spark.sparkContext.getConf().get("spark.driver.memory"),
                "repetitions": "1 timed after 1 warm-up",
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
