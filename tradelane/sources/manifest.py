"""Which files make up a folder's current state.

A folder's data lies in parts that are never written twice. A manifest names the parts that count;
manifests are numbered, and the newest one that was finished is the state. It is finished when
Spark's commit has put ``_SUCCESS`` beside its rows, so readers see the state before a change or the
state after it, never a mix, and a change that stops half-way leaves only parts that nobody names.
One writer at a time: of two that take the same number, the later one fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "_manifests"


def _matches(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return sorted(str(x.getPath()) for x in found or [])


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The finished manifests' numbers, ascending."""
    return [int(p.split("/")[-2]) for p in _matches(spark, f"{root}/{FOLDER}/*/_SUCCESS")]


def latest(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of the newest finished manifest."""
    known = numbers(spark, root)
    return spark.read.parquet(f"{root}/{FOLDER}/{known[-1]:06d}") if known else None


def next_number(spark: SparkSession, root: str) -> int:
    """One more than any manifest begun so far."""
    begun = [int(p.rsplit("/", 1)[1]) for p in _matches(spark, f"{root}/{FOLDER}/*")]
    return max(begun, default=0) + 1


def new_part(number: int) -> str:
    return f"{number:06d}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, root: str, entries: DataFrame, number: int) -> None:
    """Make ``entries`` the folder's state."""
    entries.coalesce(1).write.mode("errorifexists").parquet(f"{root}/{FOLDER}/{number:06d}")


def unnamed(spark: SparkSession, root: str, parts: str, column: str, keep: int = 2) -> list[str]:
    """Parts under the pattern ``parts`` that none of the newest ``keep`` manifests names in ``column``.

    For the cluster's clean-up: readers of an older state may still be at work.
    """
    named: set[str] = set()
    for n in numbers(spark, root)[-keep:]:
        named |= {r[0] for r in spark.read.parquet(f"{root}/{FOLDER}/{n:06d}").select(column).distinct().collect()}
    return [p for p in _matches(spark, f"{root}/{parts}") if not any(n in p for n in named)]
