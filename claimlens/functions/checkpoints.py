"""Reliable materialisation of intermediate results."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# rows of a narrow lookup table (tens of MB at most) that may be broadcast
BROADCAST_ROWS = 100_000
# rows of a wide table that one task of a shuffle should take
TASK_ROWS = 250_000
# bytes of shuffled rows, as compressed, up to which adaptive execution may merge partitions: claim lines take about
# fifty times as much in the sorts and hash tables of a task
TASK_BYTES = 8 << 20
MERGE_UP_TO = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_folder(spark: SparkSession) -> str:
    """The shared folder for stored results: ``spark.checkpoint.dir``, else the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def widen(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df``, with as many shuffle partitions in its session as its rows ask for.

    The memory of a task then stays the same on larger tables. The number is only ever
    raised; adaptive execution merges partitions that turn out small, up to ``TASK_BYTES``
    unless the session names a size itself: up to the default of 64 MB it would undo the number.
    """
    spark = df.sparkSession
    if spark.conf.get(MERGE_UP_TO, None) is None:
        spark.conf.set(MERGE_UP_TO, str(TASK_BYTES))
    wanted = -(-df.count() // task_rows)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return df


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs of DataFrames made inside delete their shuffle files as soon as they end.

    For results that are stored or collected: nobody reads their shuffles again, yet the
    files would stay on disk until the driver happens to collect garbage.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write a small ``df`` once and cut its lineage.

    The files go to the shared work folder and outlive any executor. Rows are
    stored whole; tables that later readers prune belong into ``store_by``.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{work_folder(df.sparkSession)}/checkpoints")
    with dropped_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def store_by(df: DataFrame, *keys: str, arranged: bool = False) -> DataFrame:
    """Store ``df`` as a Parquet table bucketed and sorted by ``keys``.

    Joins and aggregates on the keys need no shuffle, scans read only the columns
    they use, and the write runs under adaptive execution like any other. With
    ``arranged`` the rows are known to be partitioned by the keys already.
    """
    spark = df.sparkSession
    name = f"layer_{uuid.uuid4().hex}"
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with dropped_shuffles(spark):
        (
            (df.select("*") if arranged else df.repartition(width, *keys))
            .write.format("parquet")
            .option("path", f"{work_folder(spark)}/layers/{name}")
            .bucketBy(width, *keys)
            .sortBy(*keys)
            .saveAsTable(name)
        )
    return spark.table(name)


def lookup_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Store a per-group table and measure it for a join.

    Up to ``max_rows`` rows it is broadcast, so the large side keeps its layout
    and a hot group needs no shuffle. A larger table joins by shuffle, where
    adaptive execution splits skewed partitions.
    """
    stored = materialize(df)
    return F.broadcast(stored) if stored.count() <= max_rows else stored
