"""Ranks, tiles and running shares over a whole table, without one big window.

An unpartitioned window moves every row to one task. Here rows are dealt out by range of
their order once and written with the number of the partition they fell into. Rows of a lower
number come before those of a higher one, so a total per partition, added up over the numbers,
is what lies before it, and the rest is a window inside each partition. Neither the plan nor
what reaches the driver grows with the rows: there are as many slices as the session has shuffle
partitions, fewer where AQE merges small ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelane.session import materialize


def _direction(value: str, descending: bool) -> Column:
    return F.col(value).desc() if descending else F.col(value).asc()


def _ranged(df: DataFrame, order: Sequence[Column], slices: int | None) -> DataFrame:
    """``df`` dealt out by range of ``order`` and written, with the partition number ``_part``.

    The number is on disk with the row: it stays what it was if tasks run again.
    """
    dealt = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    return materialize(dealt.withColumn("_part", F.spark_partition_id()), "ranged")


def cumulate(
    df: DataFrame,
    value: str,
    measure: Column,
    descending: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Per distinct ``value``: the measure's total before it and up to it.

    Returns ``value, before, through, grand_total``. Equal values share one
    total, like a RANGE frame. Rows are first added up per value, so a value
    held by very many rows is one row from there on. NULL is the smallest value.
    """
    order = _direction(value, descending)
    sliced = _ranged(df.groupBy(value).agg(F.sum(measure).alias("_m")), [order], slices)
    zero = F.lit(0).cast(sliced.schema["_m"].dataType)
    # one row per slice: one task and a broadcast are fine
    totals = sliced.groupBy("_part").agg(F.sum("_m").alias("_slice_total"))
    all_slices = Window.orderBy("_part")
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_slice_total").over(all_slices.rowsBetween(Window.unboundedPreceding, -1)), zero).alias("_offset"),
        F.sum("_slice_total")
        .over(all_slices.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("grand_total"),
    )
    within = Window.partitionBy("_part").orderBy(order)
    return (
        sliced.withColumn("_run", F.sum("_m").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .join(F.broadcast(offsets), "_part")
        .select(
            value,
            (F.col("_offset") + F.col("_run") - F.coalesce("_m", zero)).alias("before"),
            (F.col("_offset") + F.col("_run")).alias("through"),
            "grand_total",
        )
    )


def _joined(df: DataFrame, value: str, sums: DataFrame, out: Sequence[str]) -> DataFrame:
    """``df`` with the columns ``out`` of its value's row, NULL included; columns in order."""
    named = sums.withColumnRenamed(value, "_value")
    return df.join(named, F.col(value).eqNullSafe(F.col("_value")), "left").select(*df.columns, *out)


def running_total(
    df: DataFrame,
    value: str,
    measure: str,
    descending: bool,
    out: str,
    total_out: str,
    slices: int | None = None,
) -> DataFrame:
    """``SUM(measure) OVER (ORDER BY value)`` with peers sharing, plus the grand total.

    NULL sorts first, last when descending. ``df`` is read twice: pass a table, not a long plan.
    """
    sums = cumulate(df, value, F.col(measure), descending, slices).select(
        value, F.col("through").alias(out), F.col("grand_total").alias(total_out)
    )
    return _joined(df, value, sums, [out, total_out])


def rank(
    df: DataFrame, value: str, out: str, descending: bool = False, slices: int | None = None
) -> DataFrame:
    """``RANK() OVER (ORDER BY value)``: one more than the rows strictly before.

    NULL sorts first, last when descending. ``df`` is read twice: pass a table, not a long plan.
    """
    places = cumulate(df, value, F.lit(1).cast("bigint"), descending, slices).select(
        value, (F.col("before") + 1).alias(out)
    )
    return _joined(df, value, places, [out])


@dataclass(frozen=True)
class Tile:
    out: str
    value: str
    descending: bool = False


def _after(col: Column, key: Column, cut_value, cut_key, descending: bool) -> Column:
    if cut_value is None:
        same = col.isNull() & (key >= F.lit(cut_key))
        return same if descending else col.isNotNull() | same
    beyond = col < F.lit(cut_value) if descending else col > F.lit(cut_value)
    after = beyond | ((col == F.lit(cut_value)) & (key >= F.lit(cut_key)))
    return F.coalesce(after, F.lit(descending))


def _stacked(df: DataFrame, tiles: Sequence[Tile], key: str) -> tuple[DataFrame, list[Column]]:
    """One row per tile and row of ``df``, the tile's value in a column of its own, and their order."""
    kinds = [df.schema[t.value].dataType for t in tiles]

    def row(i: int) -> Column:
        own = [F.col(t.value) if j == i else F.lit(None).cast(k) for j, (t, k) in enumerate(zip(tiles, kinds, strict=True))]
        return F.struct(F.lit(i).alias("_tile"), *[v.alias(f"_v{j}") for j, v in enumerate(own)])

    rows = df.select(F.explode(F.array(*map(row, range(len(tiles))))).alias("_r"), F.col(key).alias("_key"))
    order = [F.col("_tile"), *[_direction(f"_v{j}", t.descending) for j, t in enumerate(tiles)], F.col("_key")]
    return rows.select("_r.*", "_key"), order


def _tile_starts(sliced: DataFrame, k: int) -> DataFrame:
    """``_tile, _part, number, _place``: where tiles 2 to ``k`` begin, as a place inside a slice."""
    counts = sliced.groupBy("_tile", "_part").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("_tile")  # as many rows as slices
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(
        "*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(own).alias("total")
    )
    j = F.col("number") - 1
    start = j * F.expr(f"total div {k}") + F.least(j, F.col("total") % k) + 1
    return (
        placed.select("*", F.explode(F.sequence(F.lit(2), F.lit(k))).alias("number"))
        .withColumn("_place", start - F.col("before"))
        .where("_place between 1 and n")
        .select("_tile", "_part", "number", "_place")
    )


def ntile(
    df: DataFrame,
    tiles: Sequence[Tile],
    key: str,
    k: int = 5,
    slices: int | None = None,
) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY value, key)`` for several columns at once.

    A tile is decided by the first row of each tile, so it is enough to find
    those k-1 rows and compare: only (value, key) pairs are dealt out by range, for all tiles
    in one exchange, and ``df`` itself is labelled in place. ``key`` must be unique (it breaks
    ties, so a value held by very many rows is spread like any other); NULL sorts first, last when
    descending. ``df`` is read twice: pass a table, not a long plan.
    """
    if k < 2:
        return df.select("*", *[F.lit(1).cast("bigint").alias(t.out) for t in tiles])
    rows, order = _stacked(df, tiles, key)
    sliced = _ranged(rows, order, slices)
    starts = _tile_starts(sliced, k).collect()  # at most tiles x (k - 1) rows
    firsts: dict[int, list] = {i: [] for i in range(len(tiles))}
    if starts:
        place = F.row_number().over(Window.partitionBy("_part", "_tile").orderBy(*order[1:]))
        spots = [F.struct(*[F.lit(r[c]).alias(c) for c in ("_part", "_tile", "_place")]) for r in starts]
        found = (
            sliced.where(F.col("_part").isin(sorted({r["_part"] for r in starts})))
            .withColumn("_place", place.cast("bigint"))
            .where(F.struct("_part", "_tile", "_place").isin(*spots))
        )
        for row in found.collect():
            firsts[row["_tile"]].append((row[f"_v{row['_tile']}"], row["_key"]))
    result = df
    for index, tile in enumerate(tiles):
        score = F.lit(1)
        for cut_value, cut_key in firsts[index]:
            score = score + F.when(
                _after(F.col(tile.value), F.col(key), cut_value, cut_key, tile.descending), 1
            ).otherwise(0)
        result = result.withColumn(tile.out, score.cast("bigint"))
    return result
