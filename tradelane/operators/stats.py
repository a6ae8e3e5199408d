"""Group statistics built from value counts instead of whole-group windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelane.session import materialize

#: Buckets a quantile's range is cut into per round.
BUCKETS = 4096


def value_counts(df: DataFrame, by: Sequence[str], value: str, out: str = "n") -> DataFrame:
    """One row per group and distinct value. Small where the value is discrete."""
    return df.groupBy(*by, value).agg(F.count("*").alias(out))


def mean_and_spread(counts: DataFrame, by: Sequence[str], value: str, n: str = "n") -> DataFrame:
    """Per group ``lane_n, mean, std`` (sample) of an integer value.

    The sums are exact integers, so the result does not depend on the order of
    partial aggregates: std = sqrt((n*S2 - S1^2) / (n*(n-1))), NULL for n = 1.
    ``lane_n`` counts all rows, the moments leave NULL values out.
    """
    wide = F.col(value).cast("decimal(20,0)")
    sums = counts.groupBy(*by).agg(
        F.sum(n).alias("lane_n"),
        F.sum(F.when(F.col(value).isNotNull(), F.col(n))).alias("_n"),
        F.sum(F.col(value) * F.col(n)).alias("_s1"),
        F.sum((wide * wide * F.col(n)).cast("decimal(38,0)")).alias("_s2"),
    )
    count, s1, s2 = (F.col(c).cast("double") for c in ("_n", "_s1", "_s2"))
    variance = (count * s2 - s1 * s1) / F.nullif(count * (count - 1.0), F.lit(0.0))
    return sums.select(
        *by, "lane_n", (s1 / count).alias("mean"), F.sqrt(variance).alias("std")
    )


def median_and_mad(counts: DataFrame, by: Sequence[str], value: str, n: str = "n") -> DataFrame:
    """Per group the median and the median absolute deviation, both exact."""
    by = list(by)
    centre = counts.groupBy(*by).agg(
        F.percentile(value, F.lit(0.5), F.col(n)).alias("median"), F.sum(n).alias("lane_n")
    )
    off = counts.join(centre, by).withColumn("_off", F.abs(F.col(value) - F.col("median")))
    mad = off.groupBy(*by).agg(F.percentile("_off", F.lit(0.5), F.col(n)).alias("mad"))
    return centre.join(mad, by)


def _bucket(x: Column, lo: Column, hi: Column, buckets: int) -> Column:
    """Which of ``buckets`` equal parts of the range: never falls as ``x`` grows, 0 at ``lo``, the last at ``hi``."""
    width = hi - lo
    half = (x / 2 - lo / 2) / (hi / 2 - lo / 2)  # the width itself may be beyond a double
    share = F.when(width < F.lit(float("inf")), (x - lo) / width).otherwise(half)
    return F.least(F.floor(share * buckets), F.lit(buckets - 1))


def quantiles(
    df: DataFrame, by: Sequence[str], value: str, shares: Mapping[str, float], buckets: int = BUCKETS
) -> DataFrame:
    """Exact interpolated quantiles of a continuous value per group: ``by``, one column per share.

    ``shares`` names the columns, ``{"median": 0.5}``. A quantile lies between two rows of the
    group's order. Their range begins as the group's least and greatest value; in every round the
    rows inside are counted per bucket of the range, and the bucket that holds the row sought,
    from its own least to its own greatest value, is the next range, until that is one value. No
    row is shuffled or sorted: a round sends at most ``buckets`` counts per quantile and task,
    whatever the size of a group, and 10**6 unlike values take two or three rounds.

    NULL, NaN and infinite values do not count; a group with no other value has NULLs. NULL is a
    group like any other. ``df`` is read once a round: pass a table, not a long plan.
    """
    by = list(by)
    x = F.col(value).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = df.select(*by, F.when(finite, x).alias("_x"))
    spans = rows.groupBy(*by).agg(F.count("_x").alias("_n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    sought = []
    for i, share in enumerate(shares.values()):
        if not 0 <= share <= 1:
            raise ValueError("a share is between 0 and 1")
        at = F.lit(float(share)) * (F.col("_n") - 1)
        below = F.floor(at)
        for side in (0, 1):
            place = F.least(below + 1 + side, F.col("_n")).cast("bigint")
            part = (at - below) if side else (1 - (at - below))
            sought.append(
                F.struct(F.lit(i).alias("_i"), F.lit(side).alias("_side"), place.alias("_place"), part.alias("_part"))
            )
    state = materialize(
        spans.select(*by, "_n", "lo", "hi", F.lit(0).cast("bigint").alias("_before"), F.inline(F.array(*sought))), "quantiles"
    )
    marks = ["_i", "_side", "_place", "_part"]
    while not (wide := state.where("lo < hi")).isEmpty():
        named = wide.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], "_n", "lo", "hi", "_before", *marks)
        same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
        inside = rows.where("_x is not null").join(named, [*same, F.col("_x").between(F.col("lo"), F.col("hi"))])
        bucket = _bucket(F.col("_x"), F.col("lo"), F.col("hi"), buckets).alias("_bucket")
        counted = inside.groupBy(*by, "_n", "_before", *marks, bucket).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_x").alias("lo"), F.max("_x").alias("hi")
        )
        order = Window.partitionBy(*by, "_i", "_side").orderBy("_bucket")  # at most ``buckets`` rows
        through = F.col("_before") + F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0))
        found = (
            counted.withColumn("_through", through)
            .where("_through >= _place AND _through - _c < _place")
            .withColumn("_before", F.col("_through") - F.col("_c"))
        )
        rest = state.where("lo = hi OR lo IS NULL")
        state = materialize(found.select(*state.columns).unionByName(rest), "quantiles")

    def end(i: int, side: int, what: str) -> Column:
        return F.max(F.when((F.col("_i") == i) & (F.col("_side") == side), F.col(what)))

    columns = [
        (end(i, 0, "lo") + (end(i, 1, "lo") - end(i, 0, "lo")) * end(i, 1, "_part")).alias(name)
        for i, name in enumerate(shares)
    ]
    return state.groupBy(*by).agg(*columns)
