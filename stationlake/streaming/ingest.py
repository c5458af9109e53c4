"""Streaming ingest into the bronze tables.

A micro-batch lands through the same code as a batch load. The checkpoint is
advanced after the batch is written, so a crash replays it, and keys that are
there already are skipped: rows land effectively once, however late they come.
No state is kept; the table itself is the record of what was seen.
"""

from __future__ import annotations

import time
import uuid
from contextlib import nullcontext

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationlake import schemas
from stationlake.operators import control
from stationlake.operators.ingest import (
    INFO,
    MALFORMED,
    STATUS,
    Landing,
    as_dead_letters,
    land_dead_letters,
    land_projected,
    project,
    sort_messages,
)
from stationlake.operators.ledger import LoadNote
from stationlake.functions.scalars import FEED_NULLS, normalize_nulls
from stationlake.sources.messages import decode_messages


def land_messages(
    messages: DataFrame,
    landing: Landing,
    target: str,
    dlq: str,
    on_bad: str = "quarantine",
    epoch_unit: str = "s",
    note: LoadNote | None = None,
) -> int:
    """Land one batch of messages in a bronze table and the dead letters.

    Rows are decoded and typed once and kept in memory or on the executors'
    disks for the time of the batch; lost blocks are decoded again from the
    source.
    """
    decoded = decode_messages(messages)
    if on_bad == "quarantine":
        ready = sort_messages(decoded, landing)
    else:
        # Only whole messages can be bad then; their rows have no key.
        ready = decoded.withColumns(
            {
                "error_message": F.when(F.col("malformed").isNotNull(), F.lit(MALFORMED)),
                "raw_payload": F.col("malformed"),
            }
        )
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good = ready.filter(F.col("error_message").isNull())
        if on_bad != "quarantine":
            good = project(good, landing, "stream", on_bad)
        landed = land_projected(
            good.drop("error_message", "raw_payload"), landing, target, "stream", epoch_unit, note
        )
        letters = ready.filter(F.col("error_message").isNotNull())
        if not letters.isEmpty():
            land_dead_letters(as_dead_letters(letters), dlq, landing.topic)
        return landed
    finally:
        ready.unpersist()


def start_ingest_stream(
    messages: DataFrame,
    landing: Landing,
    target: str,
    checkpoint: str,
    dlq: str,
    on_bad: str = "quarantine",
    available_now: bool = False,
    interval: str = "5 seconds",
    epoch_unit: str = "s",
    log: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Start landing a message stream. ``available_now`` drains what is there
    and stops; otherwise a micro-batch runs per ``interval``.

    One writer per table; all streams share the table of dead letters, where
    each has a folder of its own. With ``log`` every micro-batch is logged there;
    with ``ledger`` it is a load that an incremental build takes in.
    """

    def land_batch(batch: DataFrame, _batch_id: int) -> None:
        logged = (
            control.logged_run(batch.sparkSession, log, f"stream_{landing.name}", "BRONZE")
            if log
            else nullcontext({})
        )
        with logged as run:
            note = LoadNote(batch.sparkSession, ledger, uuid.uuid4().hex) if ledger else None
            run["rows"] = land_messages(batch, landing, target, dlq, on_bad, epoch_unit, note)

    writer = messages.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.queryName(f"ingest_{landing.name}").start()


def start_status_stream(messages: DataFrame, target: str, checkpoint: str, dlq: str, **options):
    return start_ingest_stream(messages, STATUS, target, checkpoint, dlq, **options)


def start_info_stream(messages: DataFrame, target: str, checkpoint: str, dlq: str, **options):
    return start_ingest_stream(messages, INFO, target, checkpoint, dlq, **options)


def start_append_stream(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Append every row of the status topic, all 18 raw columns as text, to a
    raw bronze table with arrival columns.

    The file sink records each micro-batch's files in its own log, so a retried
    batch leaves no duplicates and a flush costs its own rows only. Duplicate
    deliveries are kept, silver removes them. Malformed messages carry no rows;
    the ingest streams keep them as dead letters.
    """
    decoded = decode_messages(messages).filter(F.col("malformed").isNull())
    rows = normalize_nulls(decoded, FEED_NULLS, schemas.RAW_COLUMNS).select(
        *schemas.RAW_COLUMNS, F.col("kafka_topic").alias("source_file"), *schemas.ARRIVAL
    )
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.queryName("append_raw").start(target)


def drain(*queries: StreamingQuery) -> None:
    """Wait for queries started with ``available_now`` and raise their errors."""
    for query in queries:
        query.awaitTermination()


def stop_gracefully(*queries: StreamingQuery, patience: float = 600.0) -> None:
    """Let running micro-batches end, then stop; what arrives later waits for the
    next start. A batch that takes longer than ``patience`` seconds is cut off
    and replayed then."""
    until = time.monotonic() + patience
    for query in queries:
        while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
            time.sleep(0.05)
        query.stop()
