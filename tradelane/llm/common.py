"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelane.session import materialize, shuffles_dropped

__all__ = ["NO_ID", "arrow_map", "bitmap", "in_bitmap", "doc_key", "materialize", "read"]

#: Stands for a null document id inside the operators: below every real id.
NO_ID = -(2**63)
#: Size of the pre-filter bitmaps, whatever the data: 2**26 bits are 8 MB.
BITMAP_BITS = 26


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NO_ID))


def arrow_map(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | Iterator | None]], schema: str
) -> DataFrame:
    """``mapInArrow`` with state set up once per task: ``make()`` gives the batch function,
    which returns a batch, an iterator of batches, or nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            if batch.num_rows:
                step = step or make()
                out = step(batch)
                for part in out if isinstance(out, Iterator) else [out]:
                    if part is not None and part.num_rows:
                        yield part

    return df.mapInArrow(run, schema)


def by_bytes(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``limit`` bytes of a binary column (one row at least)."""
    size = np.array([len(x) if x else 0 for x in batch.column(column).to_pylist()])
    part = (np.cumsum(size) - size) // limit
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(size)]
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)


def spread(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser for the bitmap, the same as ``_spread`` in SQL terms: none is needed
    for hashes, ids are multiplied into the high bits."""
    return (values.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITMAP_BITS)


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A fixed-size bitmap of the keys' hashes, for dropping rows early.

    A pre-filter only: it never loses a key, and keys that share a bit are told apart by
    the exact join or grouping that follows. The driver gets at most 2**20 words (16 MB),
    whatever the number of keys.
    """

    def make():
        def step(batch):
            bit = np.unique(spread(batch.column(0).to_numpy(zero_copy_only=False)))
            word = (bit >> np.uint64(6)).astype(np.int64)
            value = np.uint64(1) << (bit & np.uint64(63))
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            return pa.RecordBatch.from_arrays(
                [pa.array(word[first]), pa.array(np.bitwise_or.reduceat(value, first).view(np.int64))],
                ["word", "bits"],
            )

        return step

    with shuffles_dropped(keys.sparkSession):
        words = (
            arrow_map(keys.select(column), make, "word bigint, bits bigint")
            .groupBy("word")
            .agg(F.bit_or("bits").alias("bits"))
            .toArrow()
        )
    out = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = spread(values)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
