"""Calendar arithmetic: boundary counts, labels and data-derived anchors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hour_index(ts: Column) -> Column:
    """Whole hours since the epoch, read off the wall clock (no time zone)."""
    return F.unix_date(F.to_date(ts)).cast("bigint") * 24 + F.hour(ts)


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour boundaries between two timestamps: 00:59 to 01:01 is 1."""
    return hour_index(end) - hour_index(start)


def quarter_index(day: Column) -> Column:
    return (F.year(day) * 4 + F.quarter(day)).cast("bigint")


def quarters_crossed(start: Column, end: Column) -> Column:
    """Quarter boundaries between two dates: 31 March to 1 April is 1."""
    return quarter_index(end) - quarter_index(start)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def latest(df: DataFrame, column: str) -> dt.date | None:
    """Newest value of a date column, as a driver-side scalar.

    One row crosses to the driver. As a literal it prunes partitions and is
    pushed to the scan, which a join with a one-row frame cannot do.
    """
    return df.agg(F.max(column)).first()[0]


def day(value: dt.date | str | None) -> Column:
    """A date literal; NULL for the anchor of an empty table."""
    return F.lit(value).cast("date")


def shift(value: dt.date | str | None, days: int) -> Column:
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return day(None if value is None else value + dt.timedelta(days=days))


def after(df: DataFrame, column: str, bound: dt.date | None) -> DataFrame:
    """Rows with ``column > bound``; skips whole months of a table laid out by month."""
    rows = df.where(F.col(column) > day(bound))
    if bound is not None and "month" in df.columns:
        rows = rows.where(F.col("month") >= bound.strftime("%Y-%m"))
    return rows


def days_before(value: dt.date | None, days: int) -> dt.date | None:
    return None if value is None else value - dt.timedelta(days=days)
