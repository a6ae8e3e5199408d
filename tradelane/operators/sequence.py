"""Previous-row lookups inside a sequence, safe for very long sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    take: dict[str, str],
    slice_of: Column,
) -> DataFrame:
    """``LAG(col) OVER (PARTITION BY by ORDER BY order)`` for each ``take[col] = out``.

    ``slice_of`` cuts a sequence into ordered pieces (for example days). Rows
    are sorted inside a piece only, so one sequence with a third of all rows is
    spread over many tasks. A piece's first row still lacks its predecessor,
    which is the last row of an earlier piece: the first and last rows of all
    pieces, at most two per piece, are ordered once more per sequence.
    ``order`` must be unique in a sequence.
    """
    by = list(by)
    row = F.struct(*[F.col(c) for c in take])
    inner = Window.partitionBy(*by, "_slice").orderBy(*order)
    sliced = (
        df.withColumn("_slice", slice_of)
        .withColumn("_prev", F.lag(row).over(inner))
        .withColumn("_last", F.lead(F.lit(True)).over(inner).isNull())
    )
    first = F.col("_prev").isNull()
    across = Window.partitionBy(*by).orderBy(*order)
    heads = (
        sliced.where(first | F.col("_last"))
        .withColumn("_before", F.lag(row).over(across))
        .where(first)
        .withColumn("_prev", F.col("_before"))
        .drop("_before")
    )
    return (
        sliced.where(~first)
        .unionByName(heads)
        .select(*df.columns, *[F.col("_prev")[c].alias(out) for c, out in take.items()])
    )
