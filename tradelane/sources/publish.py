"""Result tables on disk with a catalogue of what was written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelane.sources import manifest

CATALOGUE = "mart string, title string, path string, source string"


def publish(
    spark: SparkSession, marts: dict[str, tuple], out_dir: str
) -> DataFrame:
    """Write every mart whole and return ``mart, title, path, source``.

    ``marts`` maps a name to (title, builder) or (title, builder, source), the
    source saying where the rows come from. A run writes into a folder of its own; the catalogue
    that points there is switched when all marts are written, so readers who go by
    :func:`catalogue` or :func:`read` see one run, and a failing mart leaves the last run in place.
    Row counts are taken from the written files by :func:`with_counts`.
    """
    number = manifest.next_number(spark, out_dir)
    folder = f"{out_dir}/runs/{manifest.new_part(number)}"
    rows = []
    build: Callable[[], DataFrame]
    for name, (title, build, *source) in marts.items():
        path = f"{folder}/{name}"
        build().write.parquet(path)
        rows.append((name, title, path, source[0] if source else None))
    entries = spark.createDataFrame(rows, CATALOGUE)
    manifest.commit(spark, out_dir, entries, number)
    return entries


def catalogue(spark: SparkSession, out_dir: str) -> DataFrame:
    """What the newest whole run has published."""
    state = manifest.latest(spark, out_dir)
    return spark.createDataFrame([], CATALOGUE) if state is None else state


def read(spark: SparkSession, out_dir: str, mart: str) -> DataFrame:
    """A mart of the newest whole run."""
    found = catalogue(spark, out_dir).where(F.col("mart") == mart).first()
    if found is None:
        raise KeyError(f"{mart} is not published in {out_dir}")
    return spark.read.parquet(found["path"])


def with_counts(spark: SparkSession, catalogue: DataFrame) -> DataFrame:
    """Adds ``row_count`` per mart, counted over the files in one job."""
    entries = catalogue.collect()  # one row per published mart
    counted = None
    for entry in entries:
        part = spark.read.parquet(entry["path"]).agg(F.count("*").alias("row_count")).select(
            F.lit(entry["mart"]).alias("mart"), "row_count"
        )
        counted = part if counted is None else counted.unionByName(part)
    return catalogue.join(counted, "mart")
