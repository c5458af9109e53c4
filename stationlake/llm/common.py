"""What the operators share: columns of documents, words, stored steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.session import fresh_dir
from stationlake.sources import layers

#: The characters of ``[\x20\x09-\x0D]``, as text and as bytes.
WHITESPACE = " \t\n\x0b\x0c\r"
WHITESPACE_BYTES = WHITESPACE.encode()
GAP = "[ \\t\\n\\x0B\\f\\r]+"

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column = "text") -> Column:
    """The text, empty where there is none."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(""))


def words_of(text: Column) -> Column:
    """``[^\\x20\\x09-\\x0D]+`` of a non-null text, in order."""
    bare = F.btrim(text, F.lit(WHITESPACE))
    return F.when(F.length(bare) > 0, F.split(bare, GAP)).otherwise(
        F.array().cast("array<string>")
    )


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def step(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: it is
    computed once, its size is known, and lost executors cost nothing."""
    path = fresh_dir(df.sparkSession, label)
    table = layers.stored(df, path)
    table._stored_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete intermediate tables that nothing will read again, once what was
    made from them is stored itself."""
    for stored in tables:
        layers.remove(stored.sparkSession, stored._stored_at)
