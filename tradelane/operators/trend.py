"""Current window against the same window a year earlier, and signal rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelane.functions.dates import after, days_before, shift

WINDOW_DAYS = 90
YEAR_DAYS = 365


def in_current(day: str, anchor: dt.date, window: int = WINDOW_DAYS) -> Column:
    """Half-open ``(anchor - window, anchor]``."""
    return F.col(day) > shift(anchor, -window)


def in_prior(day: str, anchor: dt.date, window: int = WINDOW_DAYS, lag: int = YEAR_DAYS) -> Column:
    return (F.col(day) > shift(anchor, -window - lag)) & (F.col(day) <= shift(anchor, -lag))


def period_over_period(
    df: DataFrame,
    by: str,
    day: str,
    anchor: dt.date,
    measures: dict[str, Column],
    window: int = WINDOW_DAYS,
    lag: int = YEAR_DAYS,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Per key: ``days_cur`` and, for each measure, its sum now and a year ago.

    A key with no row in a window gets NULL for that window, not zero. Only the
    two windows are read. Every key of ``keys`` appears; left out, these are all
    keys of ``df``, found by reading its key column alone.
    """
    cur, prev = in_current(day, anchor, window), in_prior(day, anchor, window, lag)
    aggs = [F.count(F.when(cur, 1)).alias("days_cur")]
    for name, measure in measures.items():
        aggs.append(F.sum(F.when(cur, measure)).cast("bigint").alias(f"{name}_cur"))
        aggs.append(F.sum(F.when(prev, measure)).cast("bigint").alias(f"{name}_prev"))
    since = days_before(anchor, window + lag)
    sums = after(df, day, since).where(cur | prev).groupBy(by).agg(*aggs)
    keys = df.select(by).distinct() if keys is None else keys.select(by)
    return keys.join(sums, by, "left").fillna(0, ["days_cur"])


def signal(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """First rule that holds gives the label; a NULL condition does not hold."""
    result = None
    for condition, label in rules:
        result = (
            F.when(condition, label) if result is None else result.when(condition, label)
        )
    return result.otherwise(default) if result is not None else F.lit(default)
