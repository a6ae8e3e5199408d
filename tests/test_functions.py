import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, got
from tradelane.functions import dates, num


@pytest.mark.parametrize(
    "value, digits, want",
    [(2.5, 0, 3.0), (-2.5, 0, -3.0), (0.25, 1, 0.3), (-0.01, 1, 0.0), (1234.56, 1, 1234.6)],
)
def test_det_round_is_half_away_from_zero(spark, value, digits, want):
    out = spark.range(1).select(num.det_round(F.lit(value), digits).alias("x")).first()[0]
    assert repr(out) == repr(want)


def test_ratio_of_zero_divisor_is_null(spark):
    row = spark.range(1).select(num.ratio(F.lit(1), F.lit(0)), num.change_pct(F.lit(3), F.lit(2)))
    assert tuple(row.first()) == (None, 50.0)


def test_whole_rounds_instead_of_truncating(spark):
    assert spark.range(1).select(num.whole(F.lit(2.5).cast("decimal(10,2)"))).first()[0] == 3


def test_hours_count_boundaries(spark):
    ts = [(dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 1, 1)),
          (dt.datetime(2024, 1, 1, 1, 0), dt.datetime(2024, 1, 1, 1, 59)),
          (dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 3, 0, 0)),
          (dt.datetime(2024, 1, 1, 3, 0), dt.datetime(2024, 1, 1, 1, 59))]
    df = spark.createDataFrame(ts, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in got(df.select(dates.hours_crossed(F.col("a"), F.col("b"))))] == [1, 0, 25, -2]


def test_quarters_count_boundaries(spark):
    df = spark.createDataFrame(
        [(day("2025-03-31"), day("2025-04-01")), (day("2025-01-01"), day("2025-03-31")),
         (day("2024-12-31"), day("2026-01-01"))], "a date, b date")
    assert [r[0] for r in got(df.select(dates.quarters_crossed(F.col("a"), F.col("b"))))] == [1, 0, 5]


def test_labels(spark):
    df = spark.createDataFrame([(day("2025-11-05"),)], "d date")
    assert got(df.select(dates.month_label(F.col("d")), dates.quarter_label(F.col("d")),
                         dates.quarter_start(F.col("d")))) == [("2025-11", "2025-Q4", day("2025-10-01"))]


def test_latest_is_the_newest_day_or_none(spark):
    df = spark.createDataFrame([(day("2025-01-01"),), (day("2025-02-01"),), (None,)], "d date")
    assert dates.latest(df, "d") == day("2025-02-01")
    assert dates.latest(df.where("false"), "d") is None
