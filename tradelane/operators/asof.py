"""As-of join: for every left row, the latest right row at or before its time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelane.session import materialize


def _payload(right: DataFrame, by: Sequence[str], time: str) -> list[str]:
    return [c for c in right.columns if c not in by and c != time]


def calendar(right: DataFrame, by: Sequence[str], time: str, last_day: dt.date) -> DataFrame:
    """One row per key and day, holding the value in force on that day.

    Each row is valid until the day before the key's next row; the newest row
    of a key is valid up to ``last_day``, the newest day of the whole table.
    Of repeated rows for a key and day, the one with the largest values counts.
    """
    by = list(by)
    order = Window.partitionBy(*by).orderBy(time, *_payload(right, by, time))
    until = F.coalesce(F.date_sub(F.lead(time).over(order), 1), F.lit(last_day))
    return (
        right.withColumn("_until", until)
        .where(F.col("_until") >= F.col(time))  # a repeated day keeps one row
        .withColumn(time, F.explode(F.sequence(F.col(time), F.col("_until"))))
        .drop("_until")
    )


def join_daily(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    how: str = "inner",
) -> DataFrame:
    """As-of join on DATE columns, planned as a plain equi-join.

    The right side becomes a daily calendar, so every fact row meets exactly
    one candidate instead of all rows of its key. Fact days after the newest
    right day look up that newest day. The calendar is written first, so the
    planner chooses the join by its true bytes; on a shuffle by (key, day) AQE
    can split a hot day.
    """
    by = list(by)
    last_day = right.agg(F.max(right_time)).first()[0]
    payload = _payload(right, by, right_time)
    if last_day is None:
        empty = left
        for name in payload:
            empty = empty.withColumn(name, F.lit(None).cast(right.schema[name].dataType))
        return empty if how == "left" else empty.where(F.lit(False))
    days = calendar(right.select(*by, right_time, *payload), by, right_time, last_day)
    days = materialize(days.withColumnRenamed(right_time, "_asof_day"), "calendar")
    keyed = left.withColumn("_asof_day", F.least(F.col(left_time), F.lit(last_day)))
    # least() skips NULLs, a NULL fact day must not match
    keyed = keyed.withColumn("_asof_day", F.when(F.col(left_time).isNotNull(), F.col("_asof_day")))
    return keyed.join(days, [*by, "_asof_day"], how).select(*left.columns, *payload)


def join_sliced(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    how: str = "inner",
    slice_expr=None,
) -> DataFrame:
    """As-of join for any time type by merging both sides in time order.

    Only the distinct (key, time) pairs of the left side are ordered, so many
    facts at one instant cost one row. Each key is cut into time slices (minutes,
    or days where the times are dates) that are ordered apart from each other;
    the value in force when a slice opens is carried over from the slices before
    it, which needs one row per slice. Of repeated rows for a key and time, the
    one with the largest values counts.

    Both sides are first read for their keys, times and values alone; what the slices
    give is written, so the facts meet it in an equi-join, which AQE can split at an
    instant held by very many facts, and the final plan reads each side once.
    """
    by = list(by)
    dates = isinstance(right.schema[right_time].dataType, T.DateType)
    slice_of = slice_expr or (lambda c: c if dates else F.date_trunc("minute", c))
    payload = _payload(right, by, right_time)
    value = F.struct(*payload)

    asks = (
        left.where(F.col(left_time).isNotNull())
        .select(*by, F.col(left_time).alias("_t"))
        .distinct()
        .withColumn("_slice", slice_of(F.col("_t")))
    )
    marks = right.select(*by, F.col(right_time).alias("_t"), value.alias("_v")).withColumn(
        "_slice", slice_of(F.col("_t"))
    )

    both = asks.withColumn("_ask", F.lit(1)).unionByName(
        marks.withColumn("_ask", F.lit(0)), allowMissingColumns=True
    )
    order = Window.partitionBy(*by, "_slice").orderBy("_t", "_ask", "_v")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = both.withColumn("_v", F.last("_v", ignorenulls=True).over(so_far)).withColumn(
        "_last", F.lead(F.lit(True)).over(order).isNull()
    )
    merged = materialize(merged.where("_last OR _ask = 1"), "slices")
    # one row per key and slice: the value its last row leaves behind
    before = (
        Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    opening = merged.where("_last").select(
        *by, "_slice", F.last("_v", ignorenulls=True).over(before).alias("_open")
    )
    resolved = (
        merged.where(F.col("_ask") == 1)
        .join(opening, [*by, "_slice"], "left")
        .select(*by, F.col("_t").alias(left_time), F.coalesce("_v", "_open").alias("_v"))
    )
    if how == "inner":
        resolved = resolved.where(F.col("_v").isNotNull())
    joined = left.join(materialize(resolved, "in_force"), [*by, left_time], how)
    return joined.select(*left.columns, *[F.col("_v")[name].alias(name) for name in payload])


def usd(
    facts: DataFrame,
    fx: DataFrame,
    day: str,
    amount: str = "amount",
    how: str = "inner",
    out: str = "amount_usd",
    default: Column | None = None,
) -> DataFrame:
    """Convert ``amount`` to USD at the fixing in force on ``day``."""
    rates = fx.select("currency", "rate_date", "rate_to_usd")
    joined = join_daily(facts, rates, ["currency"], day, "rate_date", how)
    rate = F.col("rate_to_usd") if default is None else F.coalesce(F.col("rate_to_usd"), default)
    return joined.withColumn(out, F.col(amount) * rate).drop("rate_to_usd")
