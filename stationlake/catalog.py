"""Every operator as a query over the feed derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.operators import control, quality
from stationlake.operators.ingest import INFO, MALFORMED_LINE, STATUS, bronze_rows, dead_letters
from stationlake.plans import gold, gold_sql, incremental, silver, silver_sql
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
from stationlake.session import fresh_dir
from stationlake.sources import layers, messages
from stationlake.sources.csv_feed import peek, read_feed_csv, sample_first_m, write_feed_csv
from stationlake.sources.derived_feed import derived_feed
from stationlake.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]

_CSV: dict[tuple[str, str], str] = {}


def feed_csv(spark: SparkSession, sf_dir: str) -> str:
    """The derived feed as CSV files, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CSV:
        _CSV[key] = write_feed_csv(derived_feed(spark, sf_dir), fresh_dir(spark, "feed"))
    return _CSV[key]


# --- shared pieces ----------------------------------------------------------


def _parsed(spark, sf_dir):
    return silver.parse(derived_feed(spark, sf_dir))


def _bronze_status(spark, sf_dir):
    return bronze_rows(derived_feed(spark, sf_dir), STATUS)


def _bronze_info(spark, sf_dir):
    return bronze_rows(derived_feed(spark, sf_dir), INFO)


def _valid_info(spark, sf_dir):
    """Valid station information, stored: joins then see its size."""
    valid = quality.kept(silver_sql.check_info(_bronze_info(spark, sf_dir)))
    return layers.stored(valid, fresh_dir(spark, "info"))


def _checked_status(spark, sf_dir, info=None):
    info = _valid_info(spark, sf_dir) if info is None else info
    return silver_sql.check_status(_bronze_status(spark, sf_dir), info)


def _gold_inputs(spark, sf_dir):
    info = _valid_info(spark, sf_dir)
    return quality.kept(_checked_status(spark, sf_dir, info)), info


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


_STATUS_OUT = [*STATUS.columns, "source_mode", "event_date"]
_INFO_OUT = [*INFO.columns, "source_mode"]


def _status_out(table: DataFrame) -> DataFrame:
    return table.select(*_STATUS_OUT)


def _info_out(table: DataFrame) -> DataFrame:
    return _as_double(table.select(*_INFO_OUT), "lat", "lon")


def _as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("violations", F.concat_ws(",", "violations"))


# --- sources and sampling ---------------------------------------------------


def raw_feed_scan(spark, sf_dir):
    return read_feed_csv(spark, feed_csv(spark, sf_dir)).select(*schemas.RAW_COLUMNS)


def sample_first(spark, sf_dir):
    sample = sample_first_m(derived_feed(spark, sf_dir), 5000)
    return sample.select("arrival_pos", *schemas.RAW_COLUMNS)


def peek_bronze(spark, sf_dir):
    return peek(derived_feed(spark, sf_dir)).select("arrival_pos", *schemas.RAW_COLUMNS)


def bronze_union_sources(spark, sf_dir):
    from_files = read_feed_csv(spark, feed_csv(spark, sf_dir)).select(*schemas.RAW_COLUMNS)
    topics = _topics(spark, sf_dir)
    sent = messages.read_message_dir(spark, topics[messages.TOPIC_STATUS], messages.TOPIC_STATUS)
    return from_files.unionByName(messages.decode_messages(sent).select(*schemas.RAW_COLUMNS))


# --- bronze -----------------------------------------------------------------


def _loaded(spark, sf_dir, times: int = 1) -> Lake:
    lake = Lake(fresh_dir(spark, "lake"))
    for _ in range(times):
        load_batch(spark, feed_csv(spark, sf_dir), lake)
    return lake


def bronze_status_batch(spark, sf_dir):
    return _status_out(layers.read_layer(spark, _loaded(spark, sf_dir).status, STATUS.schema))


def bronze_info_batch(spark, sf_dir):
    return _info_out(layers.read_layer(spark, _loaded(spark, sf_dir).info, INFO.schema))


def bronze_status_idempotent(spark, sf_dir):
    return _status_out(layers.read_layer(spark, _loaded(spark, sf_dir, 2).status, STATUS.schema))


def bronze_info_idempotent(spark, sf_dir):
    return _info_out(layers.read_layer(spark, _loaded(spark, sf_dir, 2).info, INFO.schema))


def load_counts_by_file(spark, sf_dir):
    return control.load_counts(_bronze_status(spark, sf_dir))


def watermark_refresh(spark, sf_dir):
    tables = {STATUS.name: _bronze_status(spark, sf_dir), INFO.name: _bronze_info(spark, sf_dir)}
    fresh = control.refresh_watermark(control.seed_watermark(spark), tables)
    return fresh.select("source_name", "last_station_id", "last_reported_ts", "rows_loaded")


def _payload(field: str):
    return F.get_json_object("raw_payload", f"$.{field}").alias(field)


def bronze_dlq(spark, sf_dir):
    return dead_letters(derived_feed(spark, sf_dir)).select(
        "event_id",
        "source_topic",
        "error_message",
        _payload("station_id"),
        _payload("num_bikes_available"),
        _payload("missing_station_information"),
    )


def dlq_dedup(spark, sf_dir):
    """The one table of dead letters after the feed was loaded from files twice,
    and sent twice, consumed, and consumed once more from the start: a file
    letter comes once, a message letter once for each message."""
    lake = _loaded(spark, sf_dir, 2)
    topics = {}
    for _ in range(2):
        topics = _send(spark, sf_dir, f"{lake.root}/topics")
    for delivery in range(2):
        source = messages.stream_message_dir(
            spark, topics[messages.TOPIC_STATUS], messages.TOPIC_STATUS
        )
        query = streaming.start_status_stream(
            source,
            lake.at("bronze", "streamed"),
            f"{lake.root}/checkpoint-{delivery}",
            lake.dlq,
            available_now=True,
        )
        streaming.drain(query)
    letters = layers.read_layer(spark, lake.dlq, schemas.DEAD_LETTERS)
    return letters.groupBy("source_topic", "error_message", _payload("station_id")).agg(
        F.count(F.lit(1)).alias("letters"),
        F.count_distinct("event_id").alias("events"),
        F.count_distinct("partition_num", "kafka_offset", "event_id").alias("places"),
    )


def _broken_csv(spark, sf_dir) -> str:
    """The feed as CSV files in which some lines lack their last field and some
    have one too many."""
    fields = [F.coalesce(F.col(c), F.lit(r"\N")) for c in schemas.RAW_COLUMNS]
    line = (
        F.when(F.col("arrival_pos") % 89 == 1, F.concat_ws(",", *fields[:-1]))
        .when(F.col("arrival_pos") % 83 == 2, F.concat_ws(",", *fields, F.lit("extra")))
        .otherwise(F.concat_ws(",", *fields))
    )
    path = fresh_dir(spark, "broken")
    # One column named as the header, so that every file begins with it.
    (
        derived_feed(spark, sf_dir)
        .select(line.alias(",".join(schemas.RAW_COLUMNS)))
        .write.mode("overwrite")
        .option("header", True)
        .option("sep", "\x01")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def bronze_dlq_malformed(spark, sf_dir):
    """Lines that are no rows, as the dead letters have them after a load and a
    second load of the same files, which adds none."""
    lake, path = Lake(fresh_dir(spark, "lake")), _broken_csv(spark, sf_dir)
    for _ in range(2):
        load_batch(spark, path, lake)
    letters = layers.read_layer(spark, lake.dlq, schemas.DEAD_LETTERS)
    return letters.filter(F.col("error_message") == MALFORMED_LINE).select(
        "source_topic", "error_message", "raw_payload"
    )


def stream_bronze_dlq(spark, sf_dir):
    """Letters and landed rows of the status topic with the message that each
    came in: event id, topic, partition and offset."""
    root = fresh_dir(spark, "stream-letters")
    packed = messages.encode_messages(derived_feed(spark, sf_dir), position="arrival_pos")
    topics = messages.write_message_dir(packed, f"{root}/topics")
    source = messages.stream_message_dir(
        spark, topics[messages.TOPIC_STATUS], messages.TOPIC_STATUS
    )
    query = streaming.start_status_stream(
        source, f"{root}/table", f"{root}/checkpoint", f"{root}/dlq", available_now=True
    )
    streaming.drain(query)
    letters = layers.read_layer(spark, f"{root}/dlq", schemas.DEAD_LETTERS).select(
        "event_id",
        F.col("source_topic").alias("topic"),
        "partition_num",
        "kafka_offset",
        "error_message",
        _payload("station_id"),
        _payload("station_status_last_reported"),
    )
    landed = layers.read_layer(spark, f"{root}/table", STATUS.schema).select(
        "event_id",
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition_num"),
        "kafka_offset",
        F.lit(None).cast("string").alias("error_message"),
        "station_id",
        F.col("station_status_last_reported").cast("string"),
    )
    return letters.unionByName(landed)


def produce_counts(spark, sf_dir):
    """Rows that the producer says it sent and that lie in the topics, and (without
    a topic) the lines it refused, for CSV files some of whose lines are no rows."""
    root = fresh_dir(spark, "produced")
    sent = produce(spark, _broken_csv(spark, sf_dir), f"{root}/topics", dlq=f"{root}/dlq")
    letters = layers.read_layer(spark, f"{root}/dlq", schemas.DEAD_LETTERS)
    found = letters.agg(
        F.lit(None).cast("string").alias("topic"),
        F.lit(None).cast("bigint").alias("sent"),
        F.count(F.lit(1)).alias("stored"),
    )
    for key, topic in (("status", messages.TOPIC_STATUS), ("info", messages.TOPIC_INFO)):
        lying = messages.read_message_dir(spark, f"{root}/topics/topic={topic}", topic)
        rows = messages.decode_messages(lying).agg(F.count(F.lit(1)).alias("stored"))
        rows = rows.select(F.lit(topic).alias("topic"), F.lit(sent[key]).cast("bigint").alias("sent"), "stored")
        found = found.unionByName(rows)
    return found


def pipeline_log_states(spark, sf_dir):
    """What the run log says after a batch load and a warehouse build."""
    lake = _loaded(spark, sf_dir)
    build_warehouse(spark, lake)
    log = layers.read_layer(spark, lake.log, schemas.RUN_LOG)
    return control.runs(log).select("pipeline_name", "layer", "status", "rows_processed")


def pipeline_run_layers(spark, sf_dir):
    """The runner from CSV to gold, then again without force: what the log says of
    each layer, whose second run found it complete and kept its rows."""
    cfg = Config(Lake(fresh_dir(spark, "run")), csv=feed_csv(spark, sf_dir))
    for _ in range(2):
        run_pipeline(spark, cfg)
    log = layers.read_layer(spark, cfg.lake.log, schemas.RUN_LOG)
    return control.runs(log).groupBy("layer", "status", "rows_processed").agg(F.count(F.lit(1)).alias("runs"))


# --- silver -----------------------------------------------------------------


def silver_parsed(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "arrival_pos", *silver.FACT_COLUMNS, *schemas.DIMENSION_COLUMNS
    )


def silver_status_fact(spark, sf_dir):
    return silver.status_fact(_parsed(spark, sf_dir))


def silver_station_dimension(spark, sf_dir):
    return silver.station_dimension(_parsed(spark, sf_dir))


def silver_station_dimension_latest(spark, sf_dir):
    return silver.station_dimension(_parsed(spark, sf_dir), pick="latest")


def silver_info_validated(spark, sf_dir):
    checked = silver_sql.check_info(_bronze_info(spark, sf_dir))
    return _as_text(
        _as_double(checked.drop("bronze_ingested_at", "silver_loaded_at"), "lat", "lon").withColumns(
            {c: F.col(c).cast("int") for c in ("has_kiosk", "missing_station_information")}
        )
    )


def silver_status_validated(spark, sf_dir):
    checked = _checked_status(spark, sf_dir).drop("bronze_ingested_at", "silver_loaded_at")
    return quality.kept(checked).withColumns(
        {c: F.col(c).cast("int") for c in schemas.FLAG_COLUMNS}
    )


def silver_status_rejected(spark, sf_dir):
    checked = _checked_status(spark, sf_dir)
    return _as_text(
        quality.rejected(checked).select(
            "station_id", "station_status_last_reported", "violations"
        )
    )


def silver_status_fk_orphans(spark, sf_dir):
    return silver_sql.orphans(_checked_status(spark, sf_dir)).select(
        "station_id", "station_status_last_reported", "last_reported_ts"
    )


def silver_incremental(spark, sf_dir):
    """Rows above a mark one week before the newest report."""
    bronze = _bronze_status(spark, sf_dir)
    marks = control.refresh_watermark(control.seed_watermark(spark), {STATUS.name: bronze})
    newest = marks.filter(F.col("source_name") == STATUS.name).first()["last_reported_ts"]
    mark = newest - timedelta(days=7) if newest else None
    return control.above_mark(bronze, mark).select(*STATUS.columns)


# --- loads taken in one by one ------------------------------------------------


def _in_loads(spark, sf_dir) -> DataFrame:
    """The feed with the load that brings each row: 1 and 2 by time, 3 with late
    reports of the first five days. Every fifth station has no information in
    load 1."""
    feed = derived_feed(spark, sf_dir)
    event = F.call_function("div", "arrival_pos", F.lit(2))
    day = F.substring("source_file", 12, 2).cast("int")
    load = F.when((day <= 5) & (event % 10 == 7), 3).when(day > 20, 2).otherwise(1)
    unnamed = (F.trim("station_id").try_cast("bigint") % 5 == 0) & (F.col("load") == 1)
    return feed.withColumn("load", load).withColumn(
        "missing_station_information",
        F.when(unnamed, F.lit("true")).otherwise(F.col("missing_station_information")),
    )


_TAKEN: dict[tuple[str, str], Lake] = {}


def _taken_in(spark, sf_dir) -> Lake:
    """Load by load into the bronze tables, with an incremental build after each;
    done once per application. Below ``waited`` are the rows that wait after the
    first load, below ``resolved`` what they are after the second."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _TAKEN:
        return _TAKEN[key]
    lake = Lake(fresh_dir(spark, "lake"))
    feed = layers.stored(_in_loads(spark, sf_dir), fresh_dir(spark, "loads"))
    for number in (1, 2, 3):
        rows = feed.filter(F.col("load") == number).drop("load")
        load_batch(spark, write_feed_csv(rows, f"{lake.root}/load-{number}"), lake)
        incremental.update_warehouse(spark, lake)
        if number == 1:
            waiting = incremental.read_status(spark, lake, incremental.WAITING)
            waited = layers.stored(waiting.select(*incremental.KEYS), f"{lake.root}/waited")
        elif number == 2:
            now = incremental.read_states(spark, lake).select(*incremental.KEYS, "region_id", "state")
            layers.stored(waited.join(now, incremental.KEYS), f"{lake.root}/resolved")
    _TAKEN[key] = lake
    return lake


def silver_incremental_late(spark, sf_dir):
    """Valid status after three loads, the last of late reports, each of which
    rebuilt the dates it touched."""
    kept = incremental.read_status(spark, _taken_in(spark, sf_dir)).drop(
        "violations", "event_date", "bronze_ingested_at", "silver_loaded_at"
    )
    return kept.withColumns({c: F.col(c).cast("int") for c in schemas.FLAG_COLUMNS})


def silver_orphans_resolved(spark, sf_dir):
    """What became of the rows that waited for information after the first load:
    accepted or rejected after the second one, or still waiting."""
    return spark.read.parquet(f"{_taken_in(spark, sf_dir).root}/resolved")


def gold_station_summary_merged(spark, sf_dir):
    """The lifetime summary merged from stored partials after three loads."""
    lake = _taken_in(spark, sf_dir)
    summary = incremental.summary(
        incremental.read_lifetime(spark, lake), incremental.read_info(spark, lake)
    )
    return quality.kept(summary)


def load_counts_second_load(spark, sf_dir):
    """What each of two loads added per table, from the ledger: the second has
    all files of the first again."""
    lake = Lake(fresh_dir(spark, "lake"))
    feed = layers.stored(_in_loads(spark, sf_dir), fresh_dir(spark, "loads"))
    first = write_feed_csv(feed.filter(F.col("load") == 1).drop("load"), f"{lake.root}/load-1")
    later = write_feed_csv(feed.filter(F.col("load") > 1).drop("load"), f"{lake.root}/load-2")
    found = None
    for number, paths in enumerate(([first], [first, later]), 1):
        load_batch(spark, paths, lake)
        added = loaded_by_file(spark, lake).groupBy("table_name").agg(
            F.sum("rows_loaded").alias("rows_loaded")
        )
        added = layers.stored(added.withColumn("load", F.lit(number)), f"{lake.root}/added-{number}")
        found = added if found is None else found.unionByName(added)
    return found


# --- gold, DataFrame model --------------------------------------------------


def gold_daily_summary(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    return gold.daily_summary(silver.status_fact(parsed), silver.station_dimension(parsed))


def gold_hourly_patterns(spark, sf_dir):
    return gold.hourly_patterns(silver.status_fact(_parsed(spark, sf_dir)))


def gold_station_summary(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    return gold.station_summary(silver.status_fact(parsed), silver.station_dimension(parsed))


# --- gold, SQL model --------------------------------------------------------


def _availability(spark, sf_dir):
    return quality.kept(gold_sql.station_availability(*_gold_inputs(spark, sf_dir)))


def gold_station_availability(spark, sf_dir):
    return _as_double(_availability(spark, sf_dir), "lat", "lon").withColumns(
        {c: F.col(c).cast("int") for c in schemas.FLAG_COLUMNS}
    )


def gold_station_summary_sql(spark, sf_dir):
    return quality.kept(gold_sql.station_summary(*_gold_inputs(spark, sf_dir)))


def gold_region_summary(spark, sf_dir):
    return quality.kept(gold_sql.region_summary(_availability(spark, sf_dir)))


def gold_station_daily(spark, sf_dir):
    return quality.kept(gold_sql.station_daily(*_gold_inputs(spark, sf_dir)))


def gold_bounds_violations(spark, sf_dir):
    status, info = _gold_inputs(spark, sf_dir)
    status = layers.stored(status, fresh_dir(spark, "status"))
    availability = gold_sql.station_availability(status, info)
    tables = {
        "gold_station_availability": availability,
        "gold_station_summary": gold_sql.station_summary(status, info),
        "gold_region_summary": gold_sql.region_summary(quality.kept(availability)),
        "gold_station_daily": gold_sql.station_daily(status, info),
    }
    found = None
    for name, checked in tables.items():
        rows = quality.violation_rows(checked, name, gold_sql.KEYS[name])
        found = rows if found is None else found.unionByName(rows)
    return found


def gold_data_quality(spark, sf_dir):
    feed = derived_feed(spark, sf_dir)
    info_checked = silver_sql.check_info(_bronze_info(spark, sf_dir))
    return quality.quality_metrics(
        feed, [(STATUS, _checked_status(spark, sf_dir)), (INFO, info_checked)]
    )


def gold_data_quality_two_loads(spark, sf_dir):
    """Metrics of the second of two equal loads: all its rows are duplicates."""
    lake = _loaded(spark, sf_dir, 2)
    stage = layers.read_layer(spark, lake.stage, schemas.STAGE)
    paths = build_warehouse(spark, lake, stage, since=last_load(spark, lake))
    metrics = spark.read.parquet(paths["gold_data_quality"])
    return metrics.select("metric_name", "metric_value", "threshold", "unit", "dataset", "status")


# --- messages and streams ---------------------------------------------------


def _send(spark, sf_dir, path: str, feed=None) -> dict[str, str]:
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    feed = derived_feed(spark, sf_dir) if feed is None else feed
    packed = messages.encode_messages(feed, ordered_partitions=tasks)
    return messages.write_message_dir(packed, path)


def _topics(spark, sf_dir) -> dict[str, str]:
    return _send(spark, sf_dir, fresh_dir(spark, "topics"))


def route_topics(spark, sf_dir):
    routed = messages.route(derived_feed(spark, sf_dir))
    status, info = (
        rows.select(
            F.lit(topic).alias("topic"), "arrival_pos", "station_id", "missing_station_information"
        )
        for topic, rows in routed.items()
    )
    return status.unionByName(info)


def produce_status_messages(spark, sf_dir):
    """Both topics, decoded back."""
    decoded = None
    for topic, directory in _topics(spark, sf_dir).items():
        rows = messages.decode_messages(messages.read_message_dir(spark, directory, topic))
        rows = rows.select(F.col("kafka_topic").alias("topic"), *schemas.RAW_COLUMNS)
        decoded = rows if decoded is None else decoded.unionByName(rows)
    return decoded


def stream_bronze_status_ms(spark, sf_dir):
    """As ``stream_bronze_status``, with report times in milliseconds."""
    feed = derived_feed(spark, sf_dir).withColumn(
        "station_status_last_reported", F.concat("station_status_last_reported", F.lit("000"))
    )
    return _status_out(
        _streamed(spark, sf_dir, STATUS, messages.TOPIC_STATUS, feed=feed, epoch_unit="ms")
    )


def _streamed(
    spark, sf_dir, landing, topic, deliveries: int = 1, feed=None, epoch_unit: str = "s"
) -> DataFrame:
    """Land a topic through a stream; a second delivery replays the whole topic
    on a new checkpoint."""
    root = fresh_dir(spark, "stream")
    directory = _send(spark, sf_dir, f"{root}/topics", feed)[topic]
    for delivery in range(deliveries):
        source = messages.stream_message_dir(spark, directory, topic)
        query = streaming.start_ingest_stream(
            source,
            landing,
            f"{root}/table",
            f"{root}/checkpoint-{delivery}",
            f"{root}/dlq",
            available_now=True,
            epoch_unit=epoch_unit,
        )
        streaming.drain(query)
    return layers.read_layer(spark, f"{root}/table", landing.schema)


def stream_bronze_status(spark, sf_dir):
    return _status_out(_streamed(spark, sf_dir, STATUS, messages.TOPIC_STATUS))


def stream_bronze_info(spark, sf_dir):
    return _info_out(_streamed(spark, sf_dir, INFO, messages.TOPIC_INFO))


def stream_replay_idempotent(spark, sf_dir):
    return _status_out(_streamed(spark, sf_dir, STATUS, messages.TOPIC_STATUS, deliveries=2))


def stream_bronze_append(spark, sf_dir):
    root = fresh_dir(spark, "append")
    directory = _send(spark, sf_dir, f"{root}/topics")[messages.TOPIC_STATUS]
    source = messages.stream_message_dir(spark, directory, messages.TOPIC_STATUS)
    query = streaming.start_append_stream(
        source, f"{root}/raw", f"{root}/checkpoint", available_now=True
    )
    streaming.drain(query)
    raw = layers.read_layer(spark, f"{root}/raw", schemas.RAW_LAYER)
    return raw.select(*schemas.RAW_COLUMNS)


QUERIES: dict[str, Query] = {
    "raw_feed_scan": raw_feed_scan,
    "sample_first_m": sample_first,
    "peek_bronze": peek_bronze,
    "bronze_union_sources": bronze_union_sources,
    "bronze_status_batch": bronze_status_batch,
    "bronze_info_batch": bronze_info_batch,
    "bronze_status_idempotent": bronze_status_idempotent,
    "bronze_info_idempotent": bronze_info_idempotent,
    "load_counts_by_file": load_counts_by_file,
    "watermark_refresh": watermark_refresh,
    "bronze_dlq": bronze_dlq,
    "bronze_dlq_malformed": bronze_dlq_malformed,
    "dlq_dedup": dlq_dedup,
    "pipeline_log_states": pipeline_log_states,
    "pipeline_run_layers": pipeline_run_layers,
    "silver_parsed": silver_parsed,
    "silver_status_fact": silver_status_fact,
    "silver_station_dimension": silver_station_dimension,
    "silver_station_dimension_latest": silver_station_dimension_latest,
    "silver_info_validated": silver_info_validated,
    "silver_status_validated": silver_status_validated,
    "silver_status_rejected": silver_status_rejected,
    "silver_status_fk_orphans": silver_status_fk_orphans,
    "silver_incremental": silver_incremental,
    "silver_incremental_late": silver_incremental_late,
    "silver_orphans_resolved": silver_orphans_resolved,
    "gold_station_summary_merged": gold_station_summary_merged,
    "load_counts_second_load": load_counts_second_load,
    "gold_daily_summary": gold_daily_summary,
    "gold_hourly_patterns": gold_hourly_patterns,
    "gold_station_summary": gold_station_summary,
    "gold_station_availability": gold_station_availability,
    "gold_station_summary_sql": gold_station_summary_sql,
    "gold_station_daily": gold_station_daily,
    "gold_region_summary": gold_region_summary,
    "gold_data_quality": gold_data_quality,
    "gold_data_quality_two_loads": gold_data_quality_two_loads,
    "gold_bounds_violations": gold_bounds_violations,
    "route_topics": route_topics,
    "produce_status_messages": produce_status_messages,
    "produce_counts": produce_counts,
    "stream_bronze_dlq": stream_bronze_dlq,
    "stream_bronze_status": stream_bronze_status,
    "stream_bronze_status_ms": stream_bronze_status_ms,
    "stream_bronze_info": stream_bronze_info,
    "stream_bronze_append": stream_bronze_append,
    "stream_replay_idempotent": stream_replay_idempotent,
}
