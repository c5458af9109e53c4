"""Command line: python -m stationlake COMMAND --lake DIR ...

The session comes from spark-submit's settings; nothing is configured here.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stationlake import benchmark, schemas
from stationlake.operators.ingest import fold_dead_letters, sound_lines
from stationlake.plans.incremental import update_warehouse
from stationlake.plans.pipeline import (
    Config,
    Lake,
    build_warehouse,
    last_load,
    load_batch,
    loaded_by_file,
    produce,
    run_pipeline,
)
from stationlake.sources import layers
from stationlake.sources.csv_feed import read_feed_csv
from stationlake.sources.messages import (
    TOPIC_INFO,
    TOPIC_STATUS,
    stream_kafka,
    stream_message_dir,
)
from stationlake.streaming import ingest as streaming, watch


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="stationlake", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, help: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=help)
        sub.add_argument("--lake", required=True, help="root folder of the tables")
        return sub

    def feed_options(sub: argparse.ArgumentParser, epochs: bool = True, lines: bool = True) -> None:
        if epochs:
            sub.add_argument("--epoch-unit", choices=("s", "ms"), default="s")
        if lines:
            sub.add_argument("--multi-line", action="store_true", help="quoted fields may break lines")

    run = command("run", "bronze, silver and gold of the DataFrame model")
    run.add_argument("--csv", help="folder of feed files")
    run.add_argument("--files", help="first N files; 0 or all for every file")
    for layer in ("bronze", "silver", "gold", "all"):
        run.add_argument(f"--force-{layer}", action="store_true")
    run.add_argument("--stream", action="store_true", help="start from the streamed raw layer")
    feed_options(run)

    load = command("load", "load CSV files into the two bronze tables")
    load.add_argument("paths", nargs="+")
    load.add_argument("--on-bad", choices=("fail", "null", "quarantine"), default="quarantine")
    feed_options(load)

    build = command("warehouse", "silver and gold of the SQL model from the bronze tables")
    build.add_argument(
        "--quality", action="store_true", help="measure the last load, from its stage, as well"
    )
    feed_options(build, lines=False)

    update = command("update", "silver and gold of the dates that loads have touched since the last update")
    feed_options(update, lines=False)

    command("fold", "merge the files of dead letters")

    send = command("produce", "send CSV rows as messages below LAKE/topics")
    send.add_argument("paths", nargs="+")
    send.add_argument("--files", type=int)
    send.add_argument("--max-rows", type=int)
    send.add_argument("--kafka", help="bootstrap servers; without it, LAKE/topics")
    feed_options(send, epochs=False)

    consume = command("consume", "land a topic")
    consume.add_argument("what", choices=("status", "info", "append"))
    consume.add_argument("--kafka", help="bootstrap servers; without it, LAKE/topics")
    consume.add_argument("--start", default="earliest", choices=("earliest", "latest"))
    feed_options(consume, lines=False)
    consume.add_argument("--until-empty", action="store_true", help="stop once drained")
    consume.add_argument(
        "--until-quiet", type=float, metavar="SECONDS", help="stop once no rows have come for so long"
    )

    bench = command("bench", "time ingest of the same files")
    bench.add_argument("mode", choices=benchmark.MODES)
    bench.add_argument("--csv", required=True)
    scope = bench.add_mutually_exclusive_group()
    scope.add_argument("--files", type=int)
    scope.add_argument("--max-rows", type=int)

    command("report", "recorded benchmark runs as Markdown")
    return top


def consume(spark: SparkSession, args, lake: Lake) -> None:
    topic = TOPIC_INFO if args.what == "info" else TOPIC_STATUS
    if args.kafka:
        # The least number of messages of 2,000 rows per batch, and
        # how long to wait for them.
        least, delay = {"info": (1, "5s"), "status": (2, "5s"), "append": (10, "10s")}[args.what]
        source = stream_kafka(spark, args.kafka, topic, args.start, least, 10_000, delay)
    else:
        source = stream_message_dir(spark, f"{lake.root}/topics/topic={topic}", topic)
    checkpoint = lake.at("checkpoints", args.what)
    now = {"available_now": args.until_empty}
    if args.what == "append":
        query = streaming.start_append_stream(source, lake.raw_stream, checkpoint, **now)
    else:
        start, target = {
            "info": (streaming.start_info_stream, lake.info),
            "status": (streaming.start_status_stream, lake.status),
        }[args.what]
        now |= {"epoch_unit": args.epoch_unit, "log": lake.log, "ledger": lake.ledger}
        query = start(source, target, checkpoint, lake.dlq, **now)
    with watch.stop_signals() as stop:
        watch.wait(spark, query, quiet=args.until_quiet, stop=stop)
    streaming.stop_gracefully(query)
    watch.raise_failures(query)


def bench(spark: SparkSession, args, lake: Lake) -> None:
    source, files = args.csv, args.files
    if args.max_rows:
        source = benchmark.sample_csv(
            sound_lines(read_feed_csv(spark, args.csv, ()), "fail"), args.max_rows, f"{lake.root}/sample_{args.max_rows}"
        )
    name = f"bench-{args.mode}-{spark.sparkContext.applicationId}"
    result = benchmark.RUNNERS[args.mode](spark, source, lake.at("bench", name), files)
    benchmark.record(spark, result, lake.at("bench", "results"))
    print(result)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("stationlake").getOrCreate()
    lake = Lake(args.lake)
    if args.command == "run":
        everything = args.force_all
        outputs = run_pipeline(
            spark,
            Config(
                lake,
                args.csv,
                args.files,
                everything or args.force_bronze,
                everything or args.force_silver,
                everything or args.force_gold,
                args.stream,
                args.epoch_unit,
                args.multi_line,
            ),
        )
        print(*(f"{name}: {path}" for name, path in outputs.items()), sep="\n")
    elif args.command == "load":
        print(
            load_batch(
                spark,
                args.paths,
                lake,
                on_bad=args.on_bad,
                epoch_unit=args.epoch_unit,
                multi_line=args.multi_line,
            )
        )
        for row in loaded_by_file(spark, lake).toLocalIterator():
            print(*row)
    elif args.command == "warehouse":
        raw = since = None
        if args.quality:
            raw = layers.read_layer(spark, lake.stage, schemas.STAGE)
            since = last_load(spark, lake)
        paths = build_warehouse(spark, lake, raw, args.epoch_unit, since)
        print(*paths.values(), sep="\n")
    elif args.command == "update":
        print(update_warehouse(spark, lake, args.epoch_unit))
    elif args.command == "fold":
        for topic in (None, TOPIC_STATUS, TOPIC_INFO):
            print(topic, fold_dead_letters(spark, lake.dlq, topic))
    elif args.command == "produce":
        print(
            produce(
                spark,
                args.paths,
                f"{lake.root}/topics",
                args.files,
                args.max_rows,
                args.multi_line,
                args.kafka,
                lake.dlq,
            )
        )
    elif args.command == "consume":
        consume(spark, args, lake)
    elif args.command == "bench":
        bench(spark, args, lake)
    elif args.command == "report":
        print(benchmark.report(benchmark.read_results(spark, lake.at("bench", "results"))))


if __name__ == "__main__":
    main()
