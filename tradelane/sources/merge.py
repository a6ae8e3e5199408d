"""Bringing a feed into a table: keyed upsert and source override."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.session import materialize



def upsert(base: DataFrame, feed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Feed rows replace base rows with the same key, all others stay.

    Extra feed columns are left out. The feed's key must be unique
    (:func:`latest_per_key` makes it so).
    """
    key = list(key)
    kept = base.join(feed.select(*key), key, "left_anti")
    return kept.select(*base.columns).unionByName(feed.select(*base.columns))


def latest_per_key(df: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Last write wins: the row with the highest ``version`` per key."""
    rest = [c for c in df.columns if c not in key and c != version]
    if len(rest) == 1:  # a fixed-width value keeps the aggregation hash-based
        return df.groupBy(*key).agg(F.max_by(rest[0], version).alias(rest[0]))
    newest = df.groupBy(*key).agg(F.max_by(F.struct(*rest), version).alias("_r"))
    return newest.select(*key, "_r.*")


def override(
    base: DataFrame, feed: DataFrame, key: Sequence[str], group: str, day: str
) -> DataFrame:
    """A trusted feed takes over every group it covers, from its first day on.

    Base rows of those groups on or after the feed's overall first day go, even
    where the feed has no row for that day; then the feed is upserted.
    """
    start = feed.agg(F.min(day)).first()[0]
    if start is None:
        return base
    # one row per group, written so that the join sees how small it is: a plain
    # shuffle on a handful of groups would put most of the table into few tasks
    covered = materialize(feed.select(F.col(group)).distinct(), "covered").withColumn(
        "_covered", F.lit(True)
    )
    kept = (
        base.join(covered, group, "left")
        .where(F.col("_covered").isNull() | (F.col(day) < F.lit(start)))
        .select(*base.columns)
    )
    return upsert(kept, feed, key)


