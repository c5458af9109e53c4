"""First / latest row picks that stay deterministic after a shuffle.

``first()`` and ``dropDuplicates`` keep whichever row a shuffle delivers first,
so every pick here orders by the arrival columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.schemas import ARRIVAL


def first_wins(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = tuple(ARRIVAL)
) -> DataFrame:
    """Keep the first row per key.

    ``row_number() = 1`` is planned with a group limit on both sides of the
    exchange, so a key that fills a third of the input sends one row per map
    task, not all its copies.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def last_wins(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return first_wins(rows, keys, [F.col(c).desc() for c in ARRIVAL])


def latest_values(
    rows: DataFrame, keys: Sequence[str], columns: Sequence[str], at: str
) -> DataFrame:
    """Values of the row with the greatest ``at`` per key.

    For fixed-width columns and an ``at`` that is unique per key: the buffers
    then fit a hash aggregate, so nothing is sorted and each task ships one row
    per key.
    """
    return rows.groupBy(*keys).agg(
        *(F.max_by(c, at).alias(c) for c in columns), F.max(at).alias(at)
    )


def _where(pick, value: Column, order: Column) -> Column:
    """min_by / max_by over the rows where the value is present: a NULL order
    is skipped by both."""
    return pick(value, F.when(value.isNotNull(), order))


def first_non_null(
    rows: DataFrame, key: str, text_column: str, fixed_columns: Sequence[str]
) -> DataFrame:
    """First present value of every column, each column on its own.

    Two levels. The first groups by source, key and the one text column, so all
    its buffers are fixed width and the whole feed goes through a hash
    aggregate, one output row per (source, key, text). The second picks across
    sources over that small result, where string buffers force a sort.
    """
    position = F.col("arrival_pos")

    def place(c: str) -> Column:
        return F.min(F.when(F.col(c).isNotNull(), position)).alias(f"{c}_pos")

    per_source = rows.groupBy("arrival_source", key, text_column).agg(
        *(_where(F.min_by, F.col(c), position).alias(c) for c in fixed_columns),
        *(place(c) for c in fixed_columns),
        F.min(position).alias(f"{text_column}_pos"),
    )
    picks = []
    for c in [text_column, *fixed_columns]:
        order = F.struct("arrival_source", f"{c}_pos")
        picks.append(_where(F.min_by, F.col(c), order).alias(c))
    return per_source.groupBy(key).agg(*picks)


def latest_non_null(
    rows: DataFrame, key: str, text_column: str, fixed_columns: Sequence[str], at: str
) -> DataFrame:
    """Like ``first_non_null`` but by descending ``at``, then arrival.

    ``at`` is a timestamp; rows without one come last. Two levels again: by
    source, key and text the best time of each column is found with fixed-width
    buffers only, then its place, then sources meet.
    """
    age = F.coalesce(-F.unix_timestamp(F.col(at)), F.lit((1 << 63) - 1))
    order = F.struct(age.alias("age"), F.col("arrival_pos").alias("pos"))
    per_source = rows.groupBy("arrival_source", key, text_column).agg(
        *(_where(F.min_by, F.col(c), order).alias(c) for c in fixed_columns),
        *(F.min(F.when(F.col(c).isNotNull(), order)).alias(f"{c}_at") for c in fixed_columns),
        F.min(order).alias(f"{text_column}_at"),
    )
    picks = []
    for c in [text_column, *fixed_columns]:
        best = F.struct(f"{c}_at.age", "arrival_source", f"{c}_at.pos")
        picks.append(_where(F.min_by, F.col(c), best).alias(c))
    return per_source.groupBy(key).agg(*picks)


def unique_when_present(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Unique by ``key`` where it is present; rows without a key are all kept."""
    keyed = first_wins(rows.filter(F.col(key).isNotNull()), [key], order)
    return keyed.unionByName(rows.filter(F.col(key).isNull()))
