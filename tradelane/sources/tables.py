"""Typed CSV and Parquet table folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelane.schemas import TABLES, lookup_tables
from tradelane.session import materialize
from tradelane.sources import manifest
from tradelane.sources.merge import upsert


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV into a declared schema; a malformed row fails the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_versioned_csv(
    spark: SparkSession, path: str, schema: T.StructType | str
) -> DataFrame:
    """:func:`read_csv` with ``version``, which grows with file name and line."""
    return read_csv(spark, path, schema).select(
        "*",
        F.struct(
            "_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id()
        ).alias("version"),
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("errorifexists").csv(path)


def ingest(
    spark: SparkSession,
    csv_dir: str,
    table_dir: str,
    names: Sequence[str] | None = None,
    partition_by: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Load ``<csv_dir>/<name>.csv`` for each name into Parquet tables.

    ``partition_by`` maps a table to a date column; the table is then laid out
    by month, so a date range reads only its months
    (see ``tradelane.functions.dates.after``).
    """
    loaded = {}
    for name in names or list(TABLES):
        source = read_csv(spark, f"{csv_dir}/{name}.csv", TABLES[name].schema)
        write_table(source, f"{table_dir}/{name}", (partition_by or {}).get(name))
        loaded[name] = read_table(spark, table_dir, name)
    return loaded


def write_table(df: DataFrame, path: str, by_month_of: str | None = None) -> None:
    """Replace the whole table: months that ``df`` no longer has are gone too."""
    if by_month_of is None:
        df.write.mode("overwrite").parquet(path)
        return
    # rebalance brings a month's rows together for fewer, fuller files, and lets
    # AQE split a month (or a day) that holds a large share of the rows
    (
        df.withColumn("month", F.date_format(by_month_of, "yyyy-MM"))
        .hint("rebalance", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("month")
        .parquet(path)
    )


def merge_table(
    spark: SparkSession, feed: DataFrame, table_dir: str, name: str, by_month_of: str
) -> DataFrame:
    """Upsert a feed, unique by key, into a stored table laid out by month.

    Older days that the feed no longer carries stay. Only months of the feed are
    read and written, rows inside a file in (date, code) order. They are written as a new
    version beside the stored one; a manifest that names each month's version is switched
    last (see ``manifest``). A merge that fails half-way leaves the table as it was, and the next
    one starts from there. A table that is not stored yet is made; one stored without a manifest
    is written anew as its first version.
    """
    spec = TABLES[name]
    path = f"{table_dir}/{name}"
    feed = materialize(
        feed.select(*spec.schema.names).withColumn("month", F.date_format(by_month_of, "yyyy-MM")),
        "feed",
    )
    months = {r.month for r in feed.select("month").distinct().collect()}  # some hundreds at most
    versions = _versions(spark, path)
    stored = stored_table(spark, table_dir, name)
    if versions is None:
        versions = {}
        months |= {r.month for r in stored.select("month").distinct().collect()}
    else:
        stored = _months(spark, path, {m: v for m, v in versions.items() if m in months}, stored.schema)
    number = manifest.next_number(spark, path)
    part = manifest.new_part(number)
    (
        upsert(stored, feed, spec.key).hint("rebalance", "month")
        .sortWithinPartitions("month", *spec.key)
        .write.partitionBy("month")
        .parquet(f"{path}/version={part}")
    )
    entries = sorted({**versions, **dict.fromkeys(months, part)}.items())
    manifest.commit(spark, path, spark.createDataFrame(entries, "month string, version string"), number)
    return stored_table(spark, table_dir, name)


def _versions(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Month -> version of a table with a manifest."""
    state = manifest.latest(spark, path)
    return None if state is None else {r.month: r.version for r in state.collect()}


def _months(spark: SparkSession, path: str, versions: dict[str, str], schema: T.StructType) -> DataFrame:
    if not versions:
        return spark.createDataFrame([], schema)
    paths = [f"{path}/version={v}/month={m}" for m, v in sorted(versions.items())]
    whole = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    return spark.read.schema(whole).option("basePath", path).parquet(*paths).drop("version")


def stored_table(spark: SparkSession, table_dir: str, name: str) -> DataFrame:
    """A table laid out by month as its manifest says, or no rows where none is stored."""
    schema = T.StructType([*TABLES[name].schema.fields, T.StructField("month", T.StringType())])
    path = f"{table_dir}/{name}"
    versions = _versions(spark, path)
    if versions is not None:
        return _months(spark, path, versions, schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, table_dir: str, name: str) -> DataFrame:
    """A stored table; one laid out by month keeps its ``month`` column for pruning."""
    if _versions(spark, f"{table_dir}/{name}") is not None:
        return stored_table(spark, table_dir, name)
    return spark.read.parquet(f"{table_dir}/{name}")


def open_tables(spark: SparkSession, table_dir: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Tables of a folder plus the literal lookup tables."""
    tables = lookup_tables(spark)
    tables.update({name: read_table(spark, table_dir, name) for name in names})
    return tables


#: Longest list of distinct values that a profile gives.
LIST_LIMIT = 10_000


def ordered_list(per_value: DataFrame, group: str, limit: int = LIST_LIMIT) -> DataFrame:
    """One row, ``values``: the distinct values of ``group`` in order, joined by commas.

    ``per_value`` has one row per value. Tasks hand on ``limit + 1`` values at most, whatever the
    number of rows, and a longer list raises instead of growing.
    """
    few = per_value.select(group).where(F.col(group).isNotNull()).orderBy(group).limit(limit + 1)
    values = F.array_sort(F.collect_list(group))
    said = F.lit(f"more than {limit} distinct values of {group}")
    return few.agg(values.alias("v")).select(
        F.when(F.size("v") > limit, F.raise_error(said).cast("string")).otherwise(F.array_join("v", ", ")).alias("values")
    )


def profile(df: DataFrame, day: str, group: str | None = None, limit: int = LIST_LIMIT) -> DataFrame:
    """Row count, date span and the ordered distinct values of ``group``, ``limit`` at most."""
    aggs = [
        F.count("*").alias("row_count"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
    ]
    if group is None:
        return df.agg(*aggs)
    # combine per value first: the list is built from one row per value
    per_value = materialize(df.groupBy(group).agg(*aggs), "per-value")
    spans = per_value.agg(
        F.sum("row_count").alias("row_count"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )
    # one row each: a join of the two on a constant
    listed = ordered_list(per_value, group, limit).withColumnRenamed("values", f"{group}_list")
    one = F.lit(1).alias("_one")
    return spans.select("*", one).join(listed.select("*", one), "_one").drop("_one")


def freshness(df: DataFrame, day: str) -> DataFrame:
    """Newest day of a feed, or a marker that the feed is empty."""
    newest = df.agg(F.max(day).alias("data_through"))
    return newest.select(
        "data_through",
        F.when(F.col("data_through").isNull(), "no cache")
        .otherwise(F.concat(F.lit("data through "), F.col("data_through").cast("string")))
        .alias("stamp"),
    )
