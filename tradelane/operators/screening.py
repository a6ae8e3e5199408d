"""Neighbourhood counts in a symmetric date window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def windowed_clusters(
    df: DataFrame,
    by: str,
    day: str,
    amount: Column,
    reach_days: int,
    min_cluster: int,
) -> DataFrame:
    """Rows whose key has at least ``min_cluster`` rows within ``reach_days`` either side.

    Adds ``cluster_size`` and ``cluster_amount``. Rows of one key and day share
    their window, so the window runs over daily totals: a key has at most one
    row per calendar day there, however many rows it has. Only days that reach
    the threshold go back to the rows.
    """
    daily = df.groupBy(by, day).agg(F.count("*").alias("_n"), F.sum(amount).alias("_sum"))
    near = (
        Window.partitionBy(by)
        .orderBy(F.unix_date(day))
        .rangeBetween(-reach_days, reach_days)
    )
    hot_days = daily.select(
        by,
        day,
        F.sum("_n").over(near).alias("cluster_size"),
        F.sum("_sum").over(near).alias("cluster_amount"),
    ).where(F.col("cluster_size") >= min_cluster)
    return df.join(hot_days, [by, day])


def repeated(df: DataFrame, keys: list[str], out: str = "copies") -> DataFrame:
    """Rows whose ``keys`` occur more than once, with the number of occurrences."""
    counts = df.groupBy(*keys).agg(F.count("*").alias(out)).where(F.col(out) > 1)
    return df.join(counts, keys)
