"""The one ingestion core, shared by batch loads and streaming micro-batches."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from operator import or_
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stationlake import schemas
from stationlake.functions.predicates import all_present, has_info_strict
from stationlake.functions.scalars import empty_to_null, epoch_to_date
from stationlake.operators.firsts import first_wins, last_wins
from stationlake.operators.insert import (
    Landed,
    insert_ignore,
    insert_new,
    partition_values,
    replace_by_key,
    touched_by,
)
from stationlake.sources import layers

MALFORMED = "message is not a JSON array of rows"
MALFORMED_LINE = "line is not a CSV row of the feed's columns"

MODES = ("batch", "stream")
ON_BAD = ("fail", "null", "quarantine")

# Provenance a source may lack; missing ones are filled with NULL.
_PROVENANCE = {
    "source_file": "string",
    "event_id": "string",
    "kafka_topic": "string",
    "kafka_partition": "int",
    "kafka_offset": "bigint",
}


@dataclass(frozen=True)
class Landing:
    """One bronze table: its columns, casts, key and row filter."""

    name: str
    schema: StructType
    columns: tuple[str, ...]
    casts: dict[str, str]
    keys: tuple[str, ...]
    topic: str = ""
    info_only: bool = False
    partition_by: str | None = None
    sort: tuple[str, ...] = field(default=())


class Note(Protocol):
    """Who wants to know what an insert touches and adds; see ``operators/ledger``."""

    def touched(self, landing: Landing, values: list | None) -> None: ...

    def landed(self, landing: Landing, target: str, landed: Landed) -> None: ...


STATUS = Landing(
    name="bronze_station_status",
    schema=schemas.BRONZE_STATUS,
    columns=tuple(schemas.RAW_COLUMNS[:10]),
    casts={**{c: "int" for c in schemas.COUNT_COLUMNS}, "station_status_last_reported": "bigint"},
    keys=("station_id", "station_status_last_reported"),
    topic=schemas.TOPIC_STATUS,
    partition_by="event_date",
    sort=("station_id", "station_status_last_reported"),
)
INFO = Landing(
    name="bronze_station_information",
    schema=schemas.BRONZE_INFO,
    columns=("station_id", *schemas.RAW_COLUMNS[10:]),
    casts={
        "lat": "decimal(11,7)",
        "lon": "decimal(11,7)",
        "capacity": "int",
        "station_information_last_updated": "bigint",
    },
    keys=("station_id",),
    topic=schemas.TOPIC_INFO,
    info_only=True,
)


def raw_payload() -> Column:
    """The raw row as JSON text, absent values left out."""
    return F.to_json(F.struct(*schemas.RAW_COLUMNS))


def _text(c: str, landing: Landing, mode: str) -> Column:
    """Raw text of a column. Messages carry empty texts for absent values;
    batch files do not get that leniency."""
    return empty_to_null(F.col(c)) if mode == "stream" and c in landing.casts else F.col(c)


def key_text(c: str, landing: Landing, mode: str = "batch") -> Column:
    """A key column's text, NULL where the route takes it for absent."""
    return _text(c, landing, mode)


def wanted(landing: Landing, mode: str = "batch") -> Column:
    """Does a raw row belong into the table at all?"""
    if landing.info_only:
        return F.col("station_id").isNotNull() & has_info_strict(
            F.col("missing_station_information")
        )
    return (
        F.col("station_id").isNotNull()
        & _text("station_status_last_reported", landing, mode).isNotNull()
    )


def _unfit(c: str, landing: Landing, mode: str) -> Column:
    """Does a column hold text that does not fit its type?"""
    text = _text(c, landing, mode)
    if c not in landing.casts:
        return F.coalesce(F.length(text) > schemas.TEXT_LENGTHS[c], F.lit(False))
    return text.isNotNull() & text.try_cast(landing.casts[c]).isNull()


def _checked_columns(landing: Landing) -> list[str]:
    return [c for c in landing.columns if c in landing.casts or c in schemas.TEXT_LENGTHS]


def any_unfit(landing: Landing, mode: str = "batch") -> Column:
    return reduce(or_, (_unfit(c, landing, mode) for c in _checked_columns(landing)))


def _complaint(c: str, landing: Landing, mode: str) -> Column:
    if c not in landing.casts:
        most = schemas.TEXT_LENGTHS[c]
        return F.concat(F.lit(f"{c} is longer than {most}: "), _text(c, landing, mode))
    return F.concat(F.lit(f"{c} is not {landing.casts[c]}: "), _text(c, landing, mode))


def cast_errors(landing: Landing, mode: str = "batch") -> Column:
    """All unfit values of a row as one text, empty when there are none."""
    return F.concat_ws(
        "; ",
        *(
            F.when(_unfit(c, landing, mode), _complaint(c, landing, mode))
            for c in _checked_columns(landing)
        ),
    )


def event_id() -> Column:
    """A hash of a message row's place in its topic: message, place in the array."""
    place = F.col("arrival_pos").cast("string")
    return F.sha2(
        F.concat_ws("|", "kafka_topic", "kafka_partition", "kafka_offset", place), 256
    )


def _with_provenance(rows: DataFrame) -> DataFrame:
    """Fill in the provenance a source lacks; rows of messages get their event."""
    missing = {c: F.lit(None).cast(t) for c, t in _PROVENANCE.items() if c not in rows.columns}
    if "event_id" in missing and "kafka_offset" in rows.columns:
        missing["event_id"] = event_id()
    return rows.withColumns(missing) if missing else rows


def project(
    rows: DataFrame,
    landing: Landing,
    mode: str = "batch",
    on_bad: str = "quarantine",
) -> DataFrame:
    """Select a table's rows and columns from raw rows and type them.

    Rows with a value that does not fit its column, and lines that are no rows,
    are left to the dead letters under ``quarantine``; ``fail`` raises on the
    first and ``null`` blanks the value. To raise before anything is written,
    see ``first_fault``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}, not {on_bad!r}")

    def typed(c: str) -> Column:
        if c not in _checked_columns(landing):
            return F.col(c)
        kind = landing.casts.get(c, "string")
        value = _text(c, landing, mode).try_cast(kind)
        if c not in landing.casts:
            value = F.when(~_unfit(c, landing, mode), value)
        if on_bad == "fail":
            complaint = F.raise_error(_complaint(c, landing, mode)).cast(kind)
            value = F.when(_unfit(c, landing, mode), complaint).otherwise(value)
        return value.alias(c)

    chosen = sound_lines(rows, on_bad).filter(wanted(landing, mode))
    if on_bad == "quarantine":
        chosen = chosen.filter(~any_unfit(landing, mode))
    carried = [c for c in _PROVENANCE if c in rows.columns]
    out = chosen.select(*(typed(c) for c in landing.columns), *carried, *schemas.ARRIVAL)
    if on_bad == "null":
        # A key that fails its cast is an absent key.
        out = out.filter(all_present(*landing.keys))
    return out


def sound_lines(rows: DataFrame, on_bad: str = "quarantine") -> DataFrame:
    """The rows without the lines that could not be read as rows; ``fail``
    raises on the first of those. Sources that have none lack the column."""
    if "malformed" not in rows.columns:
        return rows
    if on_bad == "fail":
        complaint = F.concat(F.lit(f"{MALFORMED_LINE}: "), F.col("malformed"))
        raised = F.raise_error(complaint).cast("string")
        rows = rows.withColumn("malformed", F.when(F.col("malformed").isNotNull(), raised))
    return rows.filter(F.col("malformed").isNull())


def first_fault(rows: DataFrame, mode: str = "batch") -> str | None:
    """Why some row would be refused, NULL if all would land."""
    found = dead_letters(rows, mode=mode).select("error_message", "raw_payload").first()
    return found and f"{found['error_message']} in {found['raw_payload']}"


def pick_rows(projected: DataFrame, landing: Landing, keep: str = "first") -> DataFrame:
    """One row per key, the first or the last to arrive."""
    pick = {"first": first_wins, "last": last_wins}[keep]
    return pick(projected, landing.keys)


def complete(
    picked: DataFrame, landing: Landing, mode: str = "batch", epoch_unit: str = "s"
) -> DataFrame:
    """Add what a row needs only once it is picked, so that none of it travels
    through the pick's shuffle: constants, event ids, the partition date."""
    added = {"ingested_at": F.current_timestamp(), "source_mode": F.lit(mode)}
    if landing.partition_by:
        added[landing.partition_by] = epoch_to_date(
            F.col("station_status_last_reported"), epoch_unit
        )
    return _with_provenance(picked).withColumns(added)


def bronze_rows(
    rows: DataFrame,
    landing: Landing,
    mode: str = "batch",
    on_bad: str = "quarantine",
    keep: str = "first",
    epoch_unit: str = "s",
) -> DataFrame:
    """What a bronze table holds after loading the given raw rows alone."""
    picked = pick_rows(project(rows, landing, mode, on_bad), landing, keep)
    return complete(picked, landing, mode, epoch_unit)


def dead_letters(
    rows: DataFrame,
    landings: Iterable[Landing] = (STATUS, INFO),
    mode: str = "batch",
) -> DataFrame:
    """Rows that fail a table's casts, with the reason and the whole raw row.

    One scan: a row that fails for both tables is exploded into two letters.
    """
    landings = list(landings)
    lines = "malformed" in rows.columns
    sound = F.col("malformed").isNull() if lines else F.lit(True)
    failing = [sound & wanted(t, mode) & any_unfit(t, mode) for t in landings]
    reasons = [
        F.when(test, F.concat(F.lit(f"{t.name}: "), cast_errors(t, mode)))
        for test, t in zip(failing, landings)
    ]
    payload = raw_payload()
    if lines:
        failing.append(~sound)
        reasons.append(F.when(~sound, F.lit(MALFORMED_LINE)))
        payload = F.when(sound, payload).otherwise(F.col("malformed"))
    bad = (
        rows.filter(reduce(or_, failing))
        .withColumn("error_message", F.explode(F.array_compact(F.array(*reasons))))
        .withColumn("raw_payload", payload)
    )
    return as_dead_letters(bad)


def sort_messages(decoded: DataFrame, landing: Landing) -> DataFrame:
    """Decoded messages as typed rows, each with why it cannot land, if so.

    ``error_message`` and ``raw_payload`` are filled for malformed messages and
    for rows that fail a cast, NULL otherwise. One pass decides it all, and what
    is kept is typed and narrow.
    """
    malformed = F.col("malformed").isNotNull()
    unfit = any_unfit(landing, "stream")
    complaint = F.concat(F.lit(f"{landing.name}: "), cast_errors(landing, "stream"))
    return decoded.filter(malformed | wanted(landing, "stream")).select(
        *(
            _text(c, landing, "stream").try_cast(landing.casts[c]).alias(c)
            if c in landing.casts
            else F.col(c)
            for c in landing.columns
        ),
        *(c for c in _PROVENANCE if c in decoded.columns),
        *schemas.ARRIVAL,
        F.when(malformed, F.lit(MALFORMED))
        .when(unfit, complaint)
        .alias("error_message"),
        F.when(malformed, F.col("malformed")).when(unfit, raw_payload()).alias("raw_payload"),
    )


def as_dead_letters(bad: DataFrame) -> DataFrame:
    """Give dead letters their key: the event where there is one, else content
    and place. A rerun of the same input then adds nothing."""
    place = F.concat_ws(
        "|",
        "arrival_source",
        F.col("arrival_pos").cast("string"),
        "error_message",
        F.coalesce("raw_payload", F.lit("")),
    )
    return _with_provenance(bad).select(
        F.sha2(F.coalesce(F.concat(F.lit("event|"), "event_id"), place), 256).alias("dlq_id"),
        "event_id",
        F.col("kafka_topic").alias("source_topic"),
        F.col("kafka_partition").alias("partition_num"),
        "kafka_offset",
        "error_message",
        F.current_timestamp().alias("error_ts"),
        "raw_payload",
    )


def land(
    rows: DataFrame,
    landing: Landing,
    target: str,
    mode: str = "batch",
    on_bad: str = "quarantine",
    epoch_unit: str = "s",
    note: Note | None = None,
) -> int:
    """Insert the new keys among raw rows into a bronze table; return how many."""
    projected = project(rows, landing, mode, on_bad)
    return land_projected(projected, landing, target, mode, epoch_unit, note)


def land_projected(
    projected: DataFrame,
    landing: Landing,
    target: str,
    mode: str,
    epoch_unit: str = "s",
    note: Note | None = None,
) -> int:
    """As ``land``, for rows typed already. They are read twice when the table
    has data (touched dates, then the rows), so pass stored or persisted ones.

    ``note`` is told of the touched partitions before the first row is written,
    and of the files afterwards.
    """
    values = ranges = None
    there = layers.exists(projected.sparkSession, target)
    if landing.partition_by and (note or there):
        dated = complete(projected, landing, mode, epoch_unit)
        if there:
            values, ranges = touched_by(dated, landing.partition_by, landing.sort[0])
        else:
            values = partition_values(dated, landing.partition_by)
    if note:
        note.touched(landing, values)
    landed = insert_new(
        complete(pick_rows(projected, landing), landing, mode, epoch_unit),
        target,
        landing.schema,
        landing.keys,
        landing.partition_by,
        landing.sort,
        values,
        list_files=note is not None,
        ranges=ranges,
    )
    if note:
        note.landed(landing, target, landed)
    return landed.rows


def land_latest(rows: DataFrame, landing: Landing, target: str, mode: str = "batch") -> str:
    """Like ``land``, but the last row per key wins over what is stored. For the
    information table: it is rewritten, one row per station."""
    picked = bronze_rows(rows, landing, mode, keep="last")
    return replace_by_key(picked, target, landing.schema, landing.keys)


_LETTERS = StructType([f for f in schemas.DEAD_LETTERS.fields if f.name != "source_topic"])
LETTERS_A_FILE = 1_000_000


def _letters_folder(target: str, topic: str | None) -> str:
    return layers.partition_path(target, "source_topic", topic)


def land_dead_letters(letters: DataFrame, target: str, topic: str | None = None) -> int:
    """Add new letters of one topic, or of files, to the table of all letters.

    Each topic has a folder that only its stream writes, so streams do not meet.
    Ids are spread evenly over the tasks that write, each of which leaves one
    file sorted by id; ``fold_dead_letters`` merges the files of many loads.
    """
    unique = first_wins(letters, ["dlq_id"], ["error_message"]).sortWithinPartitions("dlq_id")
    return insert_ignore(unique, _letters_folder(target, topic), _LETTERS, ["dlq_id"])


def fold_dead_letters(
    spark: SparkSession, target: str, topic: str | None = None, rows_a_file: int = LETTERS_A_FILE
) -> int:
    """Rewrite a topic's letters as few files in order of their ids, so that
    row groups hold narrow ranges of them; returns how many files there are.

    The new files are added before the old ones go. A crash in between leaves
    letters twice, never too few, and the next fold drops the copies, as it keeps
    one letter of an id. Run it while the topic's stream rests.
    """
    folder = _letters_folder(target, topic)
    if not layers.exists(spark, folder):
        return 0
    old = layers.partition_files(spark, folder, None)
    letters = spark.read.schema(_LETTERS).parquet(folder)
    unique = first_wins(letters, ["dlq_id"], ["error_ts", "error_message"])
    files = max(1, -(-letters.select("dlq_id").distinct().count() // rows_a_file))
    unique.repartitionByRange(files, "dlq_id").sortWithinPartitions("dlq_id").write.mode("append").parquet(folder)
    for path in old:
        layers.remove(spark, path)
    return len(layers.partition_files(spark, folder, None))
