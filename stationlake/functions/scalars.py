"""Scalar expressions shared by the DataFrame and the SQL model.

Everything here is a built-in expression, so it stays inside whole-stage
codegen and needs no particular session time zone or ANSI setting.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The texts that mean "no value", per ingestion route.
FEED_NULLS = (r"\N", "", "null")
PRODUCER_NULLS = ("", r"\N")
BULK_NULLS = (r"\N",)

# Fixed value: epochs must lie strictly above this many seconds.
EPOCH_FLOOR = 1_000_000_000
# The last second whose microseconds still fit a BIGINT.
EPOCH_CEILING = 9_223_372_036_854

# Unicode White_Space. A character list keeps trimming off the regex engine;
# Spark's one-argument trim strips U+0020 only.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def normalize_nulls(
    df: DataFrame, tokens: Iterable[str], columns: Iterable[str] | None = None
) -> DataFrame:
    """Turn every null token into NULL in the given (default: all text) columns."""
    tokens = list(tokens)
    if columns is None:
        columns = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: F.when(~F.col(c).isin(tokens), F.col(c)) for c in columns})


def strip(c: Column) -> Column:
    """Strip all Unicode whitespace from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def to_long(c: Column) -> Column:
    """Lenient cast: text that is no integer becomes NULL."""
    return c.try_cast("bigint")


def to_double(c: Column) -> Column:
    """Lenient cast. Java's number suffixes (``40.7d``, ``1.5F``) are no part of
    a number in text."""
    return F.when(~F.lower(F.right(strip(c), F.lit(1))).isin("d", "f"), c).try_cast("double")


def to_bool(c: Column) -> Column:
    """``true`` in any case is true; any other text, and NULL, is false."""
    return F.coalesce(F.lower(c) == "true", F.lit(False))


def to_flag(c: Column) -> Column:
    """``0``/``1`` or ``true``/``false`` in any case, as SMALLINT; else NULL."""
    text = F.lower(c)
    return (
        F.when(text.isin("1", "true"), F.lit(1))
        .when(text.isin("0", "false"), F.lit(0))
        .cast("smallint")
    )


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _div(c: Column, by: int) -> Column:
    """Integer division, exact for every BIGINT."""
    return F.call_function("div", c, F.lit(by))


def whole_seconds(epoch: Column, unit: str = "s") -> Column:
    """A BIGINT epoch in seconds or milliseconds, as whole seconds."""
    if unit not in ("s", "ms"):
        raise ValueError(f"epoch unit must be 's' or 'ms', not {unit!r}")
    return epoch if unit == "s" else _div(epoch, 1000)


def epoch_to_ts(epoch: Column, unit: str = "s") -> Column:
    """Epoch to TIMESTAMP_NTZ; NULL unless strictly above the sanity floor."""
    seconds = whole_seconds(epoch, unit)
    plausible = (seconds > EPOCH_FLOOR) & (seconds <= EPOCH_CEILING)
    base = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return F.when(plausible, base + F.expr("INTERVAL '1' SECOND") * seconds)


def epoch_to_date(epoch: Column, unit: str = "s") -> Column:
    """Calendar date of an epoch, for partitioning.

    NULL (the default partition) outside 1970-2099, which bounds the number of
    partition directories to some 47,500 however bad the input is.
    """
    seconds = whole_seconds(epoch, unit)
    return F.when(
        seconds.between(0, 4_102_444_799),
        F.date_from_unix_date(_div(seconds, 86400).cast("int")),
    )


def partition_date(ts: Column) -> Column:
    """Calendar date of a timestamp for partitioning, bounded as above."""
    low, high = (F.lit(t).cast("timestamp_ntz") for t in ("1970-01-01", "2100-01-01"))
    return F.when((ts >= low) & (ts < high), F.to_date(ts))


def round2(c: Column) -> Column:
    """Round a double to two places, ties to even, on the binary value: the
    DataFrame model's means are rounded this way, not by their decimal text."""
    return F.rint(c * 100) / 100


def exact_ratio(
    numerator: Column, denominator: Column, digits: int, scale: int = 1
) -> Column:
    """``scale * numerator / denominator`` of whole numbers, rounded half up as
    NUMERIC is, as DOUBLE; NULL where the denominator is 0.

    Divides as decimals, so a tie is a tie and the result does not hang on the
    order of any sum.
    """
    top = numerator.cast("decimal(20,0)") * F.lit(scale)
    bottom = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(top / bottom, digits).cast("double")
