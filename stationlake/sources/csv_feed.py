"""The raw CSV feed: listing, all-text scan with arrival order, sampling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake import schemas
from stationlake.functions.scalars import FEED_NULLS, normalize_nulls
from stationlake.sources import layers


_WITH_MALFORMED = T.StructType([*schemas.RAW.fields, T.StructField("malformed", T.StringType())])


def file_limit(setting: str | int | None) -> int | None:
    """``0``, ``all`` or nothing means every file; else at least one file."""
    if setting is None or str(setting).strip().lower() in ("0", "all", ""):
        return None
    return max(1, int(setting))


def list_feed(
    spark: SparkSession, paths: str | Iterable[str], max_files: str | int | None = None
) -> list[str]:
    """CSV files among the given files and folders, folders sorted by name."""
    found: list[str] = []
    for path in [paths] if isinstance(paths, str) else paths:
        if path.endswith((".csv", ".csv.gz")):
            found.append(path)
        elif layers.exists(spark, path):
            found.extend(layers.list_files(spark, path, ".csv"))
    if not found:
        raise FileNotFoundError(f"no CSV files found in {paths}")
    return found[: file_limit(max_files)]


def read_feed_csv(
    spark: SparkSession,
    paths: str | Iterable[str],
    tokens: Iterable[str] = FEED_NULLS,
    max_files: str | int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All-text scan of the feed plus file name and arrival order.

    A line that is no row of 18 fields (too many, too few, a broken quote) has
    its text in ``malformed``, which is NULL for rows. Without ``multi_line`` a
    line break within quotes makes two such lines; with it files are not split.

    The position of a row is the start of its split plus its number in its task.
    A split that is not its file's last is as large as Spark allows and so comes
    first in its task; as every row takes at least one byte, its positions stay
    below the next split's start. File-then-row order holds for any split size.
    """
    files = list_feed(spark, paths, max_files)
    raw = (
        spark.read.schema(_WITH_MALFORMED)
        .option("columnNameOfCorruptRecord", "malformed")
        .option("columnPruning", False)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", r"\N")
        .option("emptyValue", "")
        .option("multiLine", multi_line)
        .csv(files)
    )
    # Within one folder the file name alone orders files; it is much shorter.
    one_folder = len({f.rsplit("/", 1)[0] for f in files}) == 1
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = raw.select(
        *schemas.RAW_COLUMNS,
        # Spark refuses to read this column alone, so it takes another along.
        F.when(
            F.col("malformed").isNotNull() | (F.length("station_id") < 0), F.col("malformed")
        ).alias("malformed"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col(f"_metadata.file_{'name' if one_folder else 'path'}").alias("arrival_source"),
        (F.col("_metadata.file_block_start") + row_in_task).alias("arrival_pos"),
    )
    return normalize_nulls(rows, tokens, schemas.RAW_COLUMNS)


def write_feed_csv(rows: DataFrame, path: str) -> str:
    """Write raw rows as feed files whose name order is the arrival order."""
    (
        rows.orderBy(*schemas.ARRIVAL)
        .select(*schemas.RAW_COLUMNS)
        .write.mode("overwrite")
        .option("header", True)
        .option("nullValue", r"\N")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def peek(rows: DataFrame, n: int = 5, by: Iterable[str] = tuple(schemas.ARRIVAL)) -> DataFrame:
    """The first ``n`` rows in the given order, for a look at a table."""
    return rows.orderBy(*by).limit(n)


# Positions are grouped into ranges of this many to find a sample's last row;
# it bounds the rows sorted in the final step.
_RANGE = 1 << 20


def sample_first_m(rows: DataFrame, m: int) -> DataFrame:
    """The first ``m`` rows in arrival order, without a global sort.

    Counts per source, then per position range of the source where the count
    crosses ``m``, find the last wanted row; a plain filter does the rest. Only
    three boundary rows ever reach the driver.
    """
    if m < 1:
        return rows.limit(0)
    boundary = _crossing(rows, "arrival_source", m)
    if boundary is None:
        return rows
    source, before = boundary
    inside = rows.filter(F.col("arrival_source") == source).select("arrival_pos")
    ranges = inside.withColumn("range", F.call_function("div", "arrival_pos", F.lit(_RANGE)))
    number, before_range = _crossing(ranges, "range", m - before)
    last = (
        ranges.filter(F.col("range") == number)
        .orderBy("arrival_pos")
        .limit(m - before - before_range)
        .agg(F.max("arrival_pos"))
        .first()[0]
    )
    return rows.filter(
        (F.col("arrival_source") < source)
        | ((F.col("arrival_source") == source) & (F.col("arrival_pos") <= last))
    )


def _crossing(rows: DataFrame, column: str, m: int):
    """First value of ``column`` where the running count reaches ``m``, and the
    count before it; None if all rows together fall short."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    running = counts.withColumn("upto", F.sum("n").over(Window.orderBy(column)))
    row = running.filter(F.col("upto") >= m).orderBy(column).first()
    return None if row is None else (row[column], row["upto"] - row["n"])
