"""Session defaults and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# For clusters: start from many small shuffle partitions and let AQE merge them
# to about 128 MB, so a partition fits in memory whatever the input size.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


# Work folder of single-machine sessions that name none (tests, bench).
LOCAL_WORK = "/tmp/checkpoints/tradelane"


def build(
    app: str = "tradelane",
    master: str | None = None,
    cluster: bool = False,
    work_dir: str | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the library's settings; ``cluster`` adds those for large inputs.

    ``work_dir`` is the shared folder for written intermediates.
    """
    builder = SparkSession.builder.appName(app)
    if work_dir:
        extra["spark.checkpoint.dir"] = work_dir
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(CLUSTER_SETTINGS if cluster else {}), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where it is unset, a single-machine session gets ``LOCAL_WORK``; on a cluster
    each executor would write to its own disk there, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir (or session.build(work_dir=...)) to a folder all executors share")
    spark.sparkContext.setCheckpointDir(LOCAL_WORK)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Actions inside delete their shuffle files as they end.

    For results that are written out or collected once: the files would otherwise lie on the
    executors' disks until the driver's next garbage collection.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Actions inside hand rows to Python in Arrow batches of about ``size`` bytes, one row at least.

    Spark counts rows otherwise (10,000), so a batch, which the executor's JVM and its worker both
    hold, would grow with the rows' length.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of replaying the
    upstream plan) and gives the planner real sizes, so a later join is
    broadcast only when the written table is small.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
