from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stationlake.functions import scalars as S
from stationlake.functions.predicates import has_info_lenient, has_info_strict


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


@pytest.mark.parametrize(
    "tokens, kept",
    [
        (S.FEED_NULLS, [None, None, None, "NULL", "0"]),
        (S.PRODUCER_NULLS, [None, None, "null", "NULL", "0"]),
        (S.BULK_NULLS, [None, "", "null", "NULL", "0"]),
    ],
)
def test_null_tokens_differ_by_route(spark, tokens, kept):
    texts = [r"\N", "", "null", "NULL", "0"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, c string")
    assert [r.c for r in S.normalize_nulls(df, tokens).orderBy("i").collect()] == kept


def test_strip_takes_all_unicode_whitespace(spark):
    texts = ["\ta ", "  b c  ", " d ", "　 ", None, "e\n"]
    assert values(spark, texts, S.strip) == ["a", "b c", "d", "", None, "e"]
    by_regex = values(spark, texts, lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    assert values(spark, texts, S.strip) == by_regex


def test_lenient_casts(spark):
    assert values(spark, ["3", "-4", "3.0", "n/a", "", None], S.to_long) == [
        3, -4, None, None, None, None,
    ]
    assert values(spark, ["3.5", "x", None], S.to_double) == [3.5, None, None]


def test_epoch_guard_is_strict_and_overflow_safe(spark):
    epochs = [0, 1_000_000_000, 1_000_000_001, 1_700_000_000, 9_000_000_000_000_000_000, None]
    assert values(spark, epochs, S.epoch_to_ts, "bigint") == [
        None, None, datetime(2001, 9, 9, 1, 46, 41), datetime(2023, 11, 14, 22, 13, 20), None, None,
    ]


def test_epoch_far_future_is_kept(spark):
    # Milliseconds read as seconds give an odd year, not a lost row.
    as_text = values(
        spark, [1_700_000_000_000], lambda c: S.epoch_to_ts(c).cast("string"), "bigint"
    )
    assert as_text[0].startswith("+55840-")


def test_epoch_unit_divides_before_the_guard(spark):
    got = values(
        spark,
        [1_700_000_000_999, 1_000_000_000_999, 1_000_000_001_000],
        lambda c: S.epoch_to_ts(c, "ms"),
        "bigint",
    )
    assert got == [datetime(2023, 11, 14, 22, 13, 20), None, datetime(2001, 9, 9, 1, 46, 41)]
    with pytest.raises(ValueError):
        S.epoch_to_ts(F.col("c"), "us")


def test_epoch_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(spark, [1_700_000_000], S.epoch_to_ts, "bigint") == [
            datetime(2023, 11, 14, 22, 13, 20)
        ]
        assert values(spark, [1_700_000_000], S.epoch_to_date, "bigint") == [date(2023, 11, 14)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_epoch_date_is_bounded(spark):
    epochs = [-1, 0, 86_399, 86_400, 4_102_444_799, 4_102_444_800, None]
    assert values(spark, epochs, S.epoch_to_date, "bigint") == [
        None, date(1970, 1, 1), date(1970, 1, 1), date(1970, 1, 2), date(2099, 12, 31), None, None,
    ]


def test_booleans_and_flags(spark):
    texts = ["true", "True", "TRUE", "1", "false", "0", "yes", None]
    assert values(spark, texts, S.to_bool) == [True, True, True, False, False, False, False, False]
    assert values(spark, texts, S.to_flag) == [1, 1, 1, 1, 0, 0, None, None]


def test_has_info_tests_differ(spark):
    texts = ["false", "False", "true", None]
    assert values(spark, texts, has_info_strict) == [True, False, False, None]
    assert values(spark, texts, lambda c: has_info_lenient(S.to_bool(c))) == [
        True, True, False, True,
    ]


def test_round2_is_binary_half_even(spark):
    # 17.275 lies just below the tie as a double, 0.125 and 0.375 on it.
    assert values(spark, [0.125, 0.375, 17.275, -0.125], S.round2, "double") == [
        0.12, 0.38, 17.27, -0.12,
    ]


def test_exact_ratio_rounds_half_up_on_the_exact_value(spark):
    df = spark.createDataFrame([(1382, 80), (1, 160), (1, 3), (5, 0)], "n bigint, d bigint")
    two = [r[0] for r in df.select(S.exact_ratio(F.col("n"), F.col("d"), 2)).collect()]
    four = [r[0] for r in df.select(S.exact_ratio(F.col("n"), F.col("d"), 4)).collect()]
    assert two == [17.28, 0.01, 0.33, None]
    assert four == [17.275, 0.0063, 0.3333, None]


def test_partition_date_is_bounded(spark):
    epochs = [1_000_000_001, 4_102_444_799, 4_102_444_800, 1_700_000_000_000]
    got = values(spark, epochs, lambda c: S.partition_date(S.epoch_to_ts(c)), "bigint")
    assert got == [date(2001, 9, 9), date(2099, 12, 31), None, None]
